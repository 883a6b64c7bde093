"""Quality rules over the fact made from events, and over line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import model
from tidemark.functions import textfns
from tidemark.operators import marts, quality
from tidemark.operators.quality import Rule
from tidemark.session import scratch
from tidemark.workload.fixtures import CLEAN, DIRTY, FACT, MODED, clean_fact, dirty_fact, dst_sql, fact, moded, table
from tidemark.workload.registry import query

# The twin conditions say in SQL what each tag means; lists and limits are those of the model.
_LISTS = {"transit_mode": model.MODES, "payment_method": model.METHODS, "borough": model.BOROUGHS}
_KNOWN = " AND ".join(f"list_contains({values}, {c})" for c, values in _LISTS.items())
_INSIDE = " AND ".join(f"{c} BETWEEN {low} AND {high}" for c, (low, high) in (("latitude", model.CITY_BOX["lat"]), ("longitude", model.CITY_BOX["lon"])))
_POINT = r"regexp_extract(georeference, 'POINT \(([^ ]+) ([^ )]+)\)', {})"
RULE_SQL = {
    "missing_value": f"NOT ({' AND '.join(f'{c} IS NOT NULL' for c in model.SOURCE_COLUMNS)})",
    "invalid_category": f"NOT ({_KNOWN})",
    "nonpositive_ridership": "NOT ridership > 0",
    "negative_transfers": "sign(transfers) = -1",
    "transfers_exceed_ridership": "ridership - transfers < 0",
    "non_integer_count": "NOT (ridership % 1 = 0 AND transfers % 1 = 0)",
    "outside_nyc": f"NOT ({_INSIDE})",
    "not_on_hour": "epoch_us(transit_timestamp) % 3600000000 <> 0",
    "fare_class_payment_mismatch": "payment_method <> string_split(lower(fare_class_category), ' - ')[1]",
    "station_mode_mismatch": "NOT station_mode = transit_mode",
    "georeference_mismatch": f"NOT (TRY_CAST({_POINT.format(1)} AS DOUBLE) = longitude AND TRY_CAST({_POINT.format(2)} AS DOUBLE) = latitude)",
    "dst_transition_hour": dst_sql("transit_timestamp"),
}
_SEVERITY = {t: "warning" if t == "dst_transition_hour" else "error" for t in RULE_SQL}
_DIMENSION = {
    "missing_value": "Completeness",
    "fare_class_payment_mismatch": "Consistency",
    "station_mode_mismatch": "Consistency",
    "georeference_mismatch": "Consistency",
    "dst_transition_hour": "Accuracy",
}
_LONG = " UNION ALL ".join(f"SELECT '{t}' AS tag, count(*) FILTER ({c}) AS rows FROM {{src}}" for t, c in RULE_SQL.items())
_TAGS = "list_sort(list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{t}' END" for t, c in RULE_SQL.items()) + "], lambda x: x IS NOT NULL))"
BASE = f"WITH {DIRTY}, {MODED}"


@query("rule_counts_wide", "R01 R02 R03 R04 R05 R06 R07 R08 R09 R10 R11 R12 R21", f"{BASE} SELECT " + ", ".join(f"count(*) FILTER ({c}) AS {t}" for t, c in RULE_SQL.items()) + " FROM moded")
def _(spark, sf):
    return quality.counts_wide(moded(dirty_fact(spark, sf)), quality.fact_rules())


@query("rule_counts_long", "R20", f"{BASE} SELECT * FROM ({_LONG.format(src='moded')}) WHERE rows > 0")
def _(spark, sf):
    return quality.counts_long(moded(dirty_fact(spark, sf)), quality.fact_rules())


@query(
    "rule_counts_filtered",
    "R21",
    f"{BASE} SELECT " + ", ".join(f"count(*) FILTER ({c}) AS {t}" for t, c in RULE_SQL.items()) + " FROM moded WHERE payment_method = 'omny'",
)
def _(spark, sf):
    return quality.counts_wide(moded(dirty_fact(spark, sf)), quality.fact_rules(), where=F.col("payment_method") == "omny")


@query(
    "rule_counts_by_month",
    "R24",
    f"{BASE}, m AS (SELECT CAST(date_trunc('month', transit_timestamp) AS DATE) AS month, * FROM moded) "
    + " UNION ALL ".join(f"SELECT month, '{t}' AS tag, '{_SEVERITY[t]}' AS severity, count(*) FILTER ({c}) AS rows FROM m GROUP BY month" for t, c in RULE_SQL.items()),
)
def _(spark, sf):
    return quality.counts_by_month(moded(dirty_fact(spark, sf)), quality.fact_rules())


@query(
    "rule_diagnosis",
    "R25 J11",
    f"{BASE}, c AS ({_LONG.format(src='moded')}), r(tag, dimension, severity, blocking) AS (VALUES "
    + ", ".join(f"('{t}', '{_DIMENSION.get(t, 'Validity')}', '{_SEVERITY[t]}', {str(t not in ('negative_transfers', 'station_mode_mismatch', 'dst_transition_hour')).lower()})" for t in RULE_SQL)
    + ") SELECT r.*, coalesce(c.rows, 0) AS rows FROM r LEFT JOIN c USING (tag)",
)
def _(spark, sf):
    return quality.diagnosis(moded(dirty_fact(spark, sf)), quality.fact_rules())


@query(
    "error_tags",
    "R22 L01 F12",
    f"{BASE}, t AS (SELECT *, {_TAGS} AS tags FROM moded) SELECT transit_timestamp, station_complex_id, payment_method, fare_class_category, "
    "array_to_string(tags, ', ') AS tags, CAST(len(tags) AS INT) AS n_tags FROM t WHERE len(tags) > 0",
)
def _(spark, sf):
    rows = quality.flagged(moded(dirty_fact(spark, sf)), quality.fact_rules())
    return rows.select(*model.ROW_KEY, F.array_join("error_tags", ", ").alias("tags"), F.size("error_tags").alias("n_tags"))


@query(
    "tag_examples",
    "R29 W02",
    f"{BASE}, t AS (SELECT *, array_to_string({_TAGS}, ', ') AS tags FROM moded), "
    "x AS (SELECT *, row_number() OVER (PARTITION BY tags ORDER BY transit_timestamp, station_complex_id, payment_method, fare_class_category, ridership, transfers) AS rank FROM t WHERE tags <> '') "
    "SELECT tags, CAST(rank AS INT) AS rank, transit_timestamp, station_complex_id, ridership, transfers FROM x WHERE rank <= 2",
)
def _(spark, sf):
    rows = quality.flagged(moded(dirty_fact(spark, sf)), quality.fact_rules())
    order = [*model.ROW_KEY, "ridership", "transfers"]
    # NULL ids come last in the twin's order.
    keys = [F.col(c).asc_nulls_last() for c in order]
    return quality.examples(rows, keys, 2).select("tags", "rank", "transit_timestamp", "station_complex_id", "ridership", "transfers")


def _score(tags):
    return " OR ".join(f"coalesce({RULE_SQL[t]}, false)" for t in tags)


_BY_DIMENSION = {d: [t for t in RULE_SQL if _DIMENSION.get(t, "Validity") == d] for d in ("Completeness", "Validity", "Consistency")}
_BY_DIMENSION["All row-level rules"] = [t for t in RULE_SQL if _SEVERITY[t] == "error"]


@query(
    "dimension_scores",
    "R26 A19",
    f"{BASE}, f AS ("
    + " UNION ALL ".join(f"SELECT '{d}' AS dimension, count(*) FILTER ({_score(ts)}) AS failing_rows FROM moded" for d, ts in _BY_DIMENSION.items())
    + " UNION ALL SELECT 'Uniqueness', CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM moded GROUP BY transit_timestamp, station_complex_id, payment_method, fare_class_category)) "
    "SELECT dimension, failing_rows, round(100 * (1 - failing_rows / (SELECT count(*) FROM moded)), 6) AS score_pct FROM f",
)
def _(spark, sf):
    scores = quality.dimension_scores(moded(dirty_fact(spark, sf)), quality.fact_rules(), model.ROW_KEY)
    return scores.withColumn("score_pct", F.round("score_pct", 6))


@query(
    "clean_rows",
    "P01 J01 N01 R10 R12",
    f"WITH {CLEAN} SELECT * FROM clean",
)
def _(spark, sf):
    return clean_fact(spark, sf)


@query(
    "clean_features",
    "P02 P03 D02 D03",
    f"WITH {CLEAN} SELECT transit_timestamp, CAST(transit_timestamp AS DATE) AS date, CAST(hour(transit_timestamp) AS INT) AS hour_of_day, "
    "CAST(isodow(transit_timestamp) AS INT) AS day_of_week, isodow(transit_timestamp) >= 6 AS is_weekend, * EXCLUDE (transit_timestamp, georeference) FROM clean",
)
def _(spark, sf):
    return quality.clean_features(moded(fact(spark, sf)))


_AFTER = {t: c.replace("station_mode", "transit_mode") if t == "station_mode_mismatch" else c for t, c in RULE_SQL.items()}


@query(
    "before_after_rules",
    "R27 J04",
    f"WITH {CLEAN}, b AS ({_LONG.format(src='moded')}), a AS ("
    + " UNION ALL ".join(f"SELECT '{t}' AS tag, count(*) FILTER ({c}) AS rows FROM clean" for t, c in _AFTER.items())
    + ") SELECT tag, b.rows AS before, a.rows AS after FROM b FULL JOIN a USING (tag)",
)
def _(spark, sf):
    before = moded(fact(spark, sf))
    after = quality.clean(before).withColumn("station_mode", F.col("transit_mode"))
    return quality.before_after_counts(before, after, quality.fact_rules())


@query(
    "before_after_totals",
    "R28 A01",
    f"WITH {CLEAN}, b AS (SELECT count(*) AS n, sum(ridership) AS r, sum(transfers) AS t, -sum(transfers) FILTER (transfers < 0) AS z FROM fact), "
    "a AS (SELECT count(*) AS n, CAST(sum(ridership) AS DOUBLE) AS r, CAST(sum(transfers) AS DOUBLE) AS t FROM clean) "
    "SELECT b.n AS rows_before, a.n AS rows_after, a.r - b.r AS ridership_change, a.t - b.t AS transfers_change, b.z AS zeroed_transfers, a.t - b.t = b.z AS only_negatives_changed FROM a, b",
)
def _(spark, sf):
    return quality.before_after_totals(fact(spark, sf), clean_fact(spark, sf))


@query(
    "post_checks",
    "R30 A23 A24 H02",
    f"""WITH {CLEAN}, d AS (SELECT CAST(transit_timestamp AS DATE) AS day, station_complex_id, sum(ridership) AS ridership FROM clean GROUP BY ALL),
    h AS (SELECT transit_timestamp, payment_method, sum(ridership) AS ridership FROM clean GROUP BY ALL)
    SELECT 'row count kept' AS "check", (SELECT count(*) FROM fact) = (SELECT count(*) FROM clean) AS passed
    UNION ALL SELECT 'no missing values', (SELECT count(*) FROM clean WHERE transit_timestamp IS NULL OR station_complex_id IS NULL OR payment_method IS NULL OR ridership IS NULL OR transfers IS NULL) = 0
    UNION ALL SELECT 'counts are integers', (SELECT bool_and(typeof(ridership) = 'INTEGER' AND typeof(transfers) = 'INTEGER') FROM clean)
    UNION ALL SELECT 'no negative transfers', (SELECT count(*) FROM clean WHERE transfers < 0) = 0
    UNION ALL SELECT 'one mode per station', (SELECT max(n) FROM (SELECT count(DISTINCT transit_mode) AS n FROM clean GROUP BY station_complex_id)) = 1
    UNION ALL SELECT 'ridership total kept', (SELECT sum(ridership) FROM clean) = (SELECT sum(ridership) FROM fact)
    UNION ALL SELECT 'hourly total equals clean', (SELECT sum(ridership) FROM h) = (SELECT sum(ridership) FROM clean)
    UNION ALL SELECT 'daily station total equals clean', (SELECT sum(ridership) FROM d) = (SELECT sum(ridership) FROM clean)
    UNION ALL SELECT 'aggregate keys unique', (SELECT count(*) - count(DISTINCT (day, station_complex_id)) FROM d) = 0
    UNION ALL SELECT 'no duplicate keys', (SELECT count(*) - count(DISTINCT (transit_timestamp, station_complex_id, payment_method, fare_class_category)) FROM clean) = 0""",
)
def _(spark, sf):
    cleaned = clean_fact(spark, sf)
    return quality.post_checks(fact(spark, sf), cleaned, marts.hourly_by_method(cleaned), marts.daily_by_station(cleaned))


@query(
    "violations_by_station",
    "A59",
    f"""WITH {FACT} SELECT station_complex_id, count(*) AS rows, min(transfers) AS least, sum(transfers) AS total, CAST(min(transit_timestamp) AS DATE) AS first_day,
    CAST(max(transit_timestamp) AS DATE) AS last_day, string_agg(DISTINCT payment_method, ', ' ORDER BY payment_method) AS labels FROM fact WHERE transfers < 0 GROUP BY 1""",
)
def _(spark, sf):
    rule = next(r for r in quality.fact_rules() if r.tag == "negative_transfers")
    return quality.violations_by(fact(spark, sf), rule, "station_complex_id", "transfers", "transit_timestamp", "payment_method")


@query(
    "point_text_differs",
    "R13 F11",
    f"WITH {DIRTY} SELECT count(*) FILTER (georeference <> printf('POINT (%s %s)', longitude::VARCHAR, latitude::VARCHAR)) AS differs FROM fact",
)
def _(spark, sf):
    return dirty_fact(spark, sf).agg(F.count_if(quality.point_text_differs()).alias("differs"))


@query(
    "parsed_points",
    "F02 R11",
    f"WITH {DIRTY} SELECT TRY_CAST({_POINT.format(1)} AS DOUBLE) AS lon, TRY_CAST({_POINT.format(2)} AS DOUBLE) AS lat, count(*) AS rows FROM fact GROUP BY ALL",
)
def _(spark, sf):
    return dirty_fact(spark, sf).groupBy(textfns.point_lon("georeference").alias("lon"), textfns.point_lat("georeference").alias("lat")).agg(F.count("*").alias("rows"))


def gated(spark, sf):
    """One scan counts every rule and writes the repaired rows; they count once no blocking rule has hits."""
    path = f"{scratch(spark, 'gated')}/clean"
    quality.write_gated(moded(fact(spark, sf)), quality.fact_rules(), path)
    return marts.daily_by_station(spark.read.parquet(path))


@query(
    "gated_daily_station",
    "S04 A08 J01 R20 R23 P01 A04",
    f"""WITH {CLEAN} SELECT CAST(transit_timestamp AS DATE) AS day, station_complex_id, CAST(sum(ridership) AS BIGINT) AS ridership, CAST(sum(transfers) AS BIGINT) AS transfers,
    CAST(coalesce(sum(ridership) FILTER (payment_method = 'omny'), 0) AS BIGINT) AS omny_ridership FROM clean GROUP BY 1, 2""",
)
def _(spark, sf):
    return gated(spark, sf)


@query(
    "gated_rule_counts",
    "R20 R23 I10",
    f"WITH {FACT}, {MODED}, n AS (SELECT count(*) AS rows FROM moded) SELECT * FROM ({_LONG.format(src='moded')}) UNION ALL SELECT 'extracted rows', rows FROM n UNION ALL SELECT 'published rows', rows FROM n",
)
def _(spark, sf):
    """What the gate saw, from the pass that wrote the rows, beside the rows that were published."""
    path = f"{scratch(spark, 'gated')}/clean"
    counted = quality.write_gated(moded(fact(spark, sf)), quality.fact_rules(), path)
    rows = [*counted.counts[""].items(), ("extracted rows", counted.value("rows"))]
    published = spark.read.parquet(path).agg(F.lit("published rows").alias("tag"), F.count("*").alias("rows"))
    return spark.createDataFrame(rows, "tag string, rows bigint").unionByName(published)


# --- the same engine over line items, with brand dominance per supplier ------


def lineitem_rules():
    c = F.col
    return [
        Rule("nonpositive_quantity", "Validity", "error", c("l_quantity") <= 0),
        Rule("discount_exceeds_tax", "Validity", "error", c("l_discount") > c("l_tax")),
        Rule("non_integer_price", "Validity", "error", c("l_extendedprice") != F.floor("l_extendedprice")),
        Rule("non_integer_quantity", "Validity", "error", c("l_quantity") != F.floor("l_quantity")),
        Rule("shipped_before_order", "Consistency", "error", c("l_shipdate") < c("o_orderdate")),
        Rule("brand_not_dominant", "Consistency", "error", c("p_brand") != c("station_mode")),
        Rule("invalid_flag", "Validity", "error", ~c("l_returnflag").isin("A", "N")),
        Rule("price_out_of_range", "Validity", "error", ~c("l_extendedprice").between(1000, 50000)),
    ]


@query(
    "lineitem_rule_counts",
    "R20 R21 A08 J01",
    """WITH j AS (SELECT l.*, o.o_orderdate, p.p_brand FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey),
    d AS (SELECT l_suppkey, p_brand AS station_mode FROM (SELECT l_suppkey, p_brand, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, p_brand DESC) AS rn FROM j GROUP BY 1, 2) WHERE rn = 1),
    m AS (SELECT j.*, station_mode FROM j JOIN d USING (l_suppkey))
    SELECT 'nonpositive_quantity' AS tag, count(*) FILTER (l_quantity <= 0) AS rows FROM m
    UNION ALL SELECT 'discount_exceeds_tax', count(*) FILTER (l_discount > l_tax) FROM m
    UNION ALL SELECT 'non_integer_price', count(*) FILTER (l_extendedprice <> floor(l_extendedprice)) FROM m
    UNION ALL SELECT 'non_integer_quantity', count(*) FILTER (l_quantity <> floor(l_quantity)) FROM m
    UNION ALL SELECT 'shipped_before_order', count(*) FILTER (l_shipdate < o_orderdate) FROM m
    UNION ALL SELECT 'brand_not_dominant', count(*) FILTER (p_brand <> station_mode) FROM m
    UNION ALL SELECT 'invalid_flag', count(*) FILTER (l_returnflag NOT IN ('A', 'N')) FROM m
    UNION ALL SELECT 'price_out_of_range', count(*) FILTER (l_extendedprice NOT BETWEEN 1000 AND 50000) FROM m""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    joined = lines.join(orders, "l_orderkey").join(parts, "l_partkey")
    brand = quality.dominant_value(lines.select("l_partkey", "l_suppkey", "l_orderkey").join(orders.select("l_orderkey"), "l_orderkey").join(parts, "l_partkey"), "l_suppkey", "p_brand", "station_mode")
    return quality.counts_long(joined.join(brand, "l_suppkey"), lineitem_rules(), keep_zero=True)
