"""One query for each operator, over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, filter_audit, fim, html_wrapper, langid, lm_scoring, mixing, pii, quality_fm, quality_rules, simhash, tokens, url_filter
from tidemark.llm.common import prepare, table, written
from tidemark.session import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query(
    "op1_mixing",
    r"""
    WITH sizes AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, coalesce(md5(doc_id::VARCHAR), '') AS place FROM documents),
    sources AS (SELECT source, sum(size)::BIGINT AS n, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind FROM sizes GROUP BY source),
    weighed AS (SELECT *, CASE kind WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, 3 * n AS cap FROM sources),
    levels AS (SELECT *, (sum(n) OVER () - coalesce(sum(cap) OVER filled, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER filled, 0)) AS level
        FROM weighed WINDOW filled AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    targets AS (SELECT *, least(cap::DOUBLE, w * max(level) OVER ()) AS target FROM levels),
    placed AS (SELECT s.doc_id, s.size, t.n, t.kind, t.target,
        coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.doc_id NULLS FIRST, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
        FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
    taken AS (SELECT *, (SELECT sum(greatest(least(floor(target)::BIGINT - start - n * i, size), 0)) FROM range(3) r(i))::BIGINT AS taken, start::DOUBLE / target AS share FROM placed),
    parts AS (SELECT *, CASE kind WHEN 0 THEN 5.0::DOUBLE * share WHEN 1 THEN 2.0::DOUBLE * share ELSE share END AS rest FROM taken)
    SELECT doc_id, size, n AS source_size, target, taken, CASE WHEN taken > 0 THEN round(
        CASE WHEN rest <= 0 THEN 0 WHEN kind = 0 THEN 2 * rest / (7.5 + sqrt(56.25 - 10 * rest)) WHEN kind = 1 THEN rest / 2
        WHEN rest <= 0.375 THEN 2 * rest / (0.5 + sqrt(0.25 + 2 * rest)) ELSE 0.5 + 2 * (rest - 0.375) / (1 + sqrt(1 + 2 * (rest - 0.375))) END, 9) END AS position
    FROM parts
    """,
)
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = written(docs.select("doc_id", "source", mixing.size_of(F.col("text")).alias("size")), "mix-sizes")
    assigned = mixing.assign(sizes).select("doc_id", "size", "_mix.source_size", "_mix.target", "_mix.taken", F.round(F.get("_mix.copies", F.lit(0))["position"], 9).alias("position"))
    return mixing.scheduled(assigned)


@query("op2_personal_data")
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(table(spark, sf_dir, "documents")))


@query("op3_quality_classifier")
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = quality_fm.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_fm.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", quality_fm.held_out().alias("held_out"), F.col("_fm_score").alias("score"), F.when(F.col("_fm_score") >= 0.7, 1).otherwise(0).alias("predicted"))


@query("op4_html_extraction")
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extract(table(spark, sf_dir, "pages"))


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score(table(spark, sf_dir, "documents"))


URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]

_FITS = " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, '{verdict}' AS verdict, '{rule.partition('/')[0]}' AS rule_host, '/{rule.partition('/')[2]}' AS rule_path" for verdict, rule in URL_RULES
)


@query(
    "op6_url_filter",
    f"""
    WITH rules AS ({_FITS}),
    after AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM after),
    split AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts)
    SELECT s.page_id, s.host, s.path,
        (SELECT arg_max(r.rule, length(r.rule)) FROM rules r WHERE (s.host = r.rule_host OR ends_with(s.host, '.' || r.rule_host)) AND starts_with(s.path, r.rule_path)) AS rule,
        coalesce((SELECT arg_max(r.verdict, length(r.rule)) FROM rules r WHERE (s.host = r.rule_host OR ends_with(s.host, '.' || r.rule_host)) AND starts_with(s.path, r.rule_path)), 'allow') AS verdict
    FROM split s
    """,
)
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query("op7_token_ids")
def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-ids")
    tokens.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return tokens.digests(tokens.spans(spark, path))


@query("op8_decontamination")
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("key").withColumnRenamed("id", "doc_id")


@query("op9_lm_scoring")
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


@query("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query(
    "op11_fill_in_middle",
    r"""
    WITH drawn AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines FROM documents),
    ranks AS (SELECT *, len(lines)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (len(lines) + 1) AS r1, ('0x' || h[9:16])::BIGINT % (len(lines) + 1) AS r2,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 100 THEN 'plain'
        WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
    cut AS (SELECT *, array_to_string(lines[1:least(r1, r2)], '') AS p, array_to_string(lines[least(r1, r2) + 1:greatest(r1, r2)], '') AS m, array_to_string(lines[greatest(r1, r2) + 1:], '') AS s FROM ranks)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
        sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END) AS output_sha256, sha256(text) AS restored_sha256
    FROM cut
    """,
)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(table(spark, sf_dir, "documents"))
    digest = [F.sha2(c.cast("binary"), 256).alias(name) for c, name in ((F.col("output"), "output_sha256"), (fim.restore(F.col("output"), F.col("form")), "restored_sha256"))]
    return made.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", *digest)


@query(
    "op12_filter_audit",
    r"""
    WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
    firsts AS (SELECT text, min(doc_id) AS least FROM texts GROUP BY text),
    flags AS (SELECT t.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic, [
        len(t.words) < 200, 100 * len(list_distinct(t.words)) < 50 * len(t.words), 100 * len(regexp_extract_all(t.text, '[A-Z]')) > 3 * length(t.text),
        regexp_matches(t.text, '[#$%&*|]'), coalesce(t.doc_id > f.least, false)] AS fails
        FROM texts t JOIN firsts f ON t.text = f.text LEFT JOIN marks m ON t.doc_id = m.doc_id),
    counted AS (SELECT part, fails, count(*) AS docs, sum(good) AS good, sum(toxic) AS toxic FROM flags GROUP BY 1, 2),
    letters AS (SELECT i, chr(64 + i::INT) AS l FROM range(1, 6) r(i)),
    orders AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS places FROM letters a, letters b, letters c, letters d, letters e
        WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
    stages AS (SELECT filter_order, s::INT AS step, places[s] AS this, places[1:s - 1] AS earlier FROM orders, range(1, 6) r(s)),
    met AS (SELECT part, filter_order, step, docs, good, toxic, fails[this] AS fails_here, len(list_filter(earlier, lambda k: fails[k])) > 0 AS gone, len(list_filter(fails, lambda x: x)) AS n_fails FROM counted, stages)
    SELECT part, filter_order, step, coalesce(sum(docs) FILTER (NOT gone AND NOT fails_here), 0)::BIGINT AS kept, coalesce(sum(docs) FILTER (NOT gone AND fails_here), 0)::BIGINT AS removed,
        coalesce(sum(docs) FILTER (gone AND fails_here), 0)::BIGINT AS redundant, coalesce(sum(docs) FILTER (fails_here AND n_fails = 1), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (NOT gone AND fails_here), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND fails_here), 0)::BIGINT AS toxic_lost,
        coalesce(sum(docs * 120 // nullif(n_fails, 0)) FILTER (fails_here), 0)::BIGINT AS shapley
    FROM met GROUP BY 1, 2, 3
    """,
)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.run(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_language_id")
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.predict(docs, langid.learn(docs))
