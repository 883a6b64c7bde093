"""Documents to token files: quality, near duplicates, decontamination, mixing, token ids.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept. All but the last
return the columns of the documents, whatever they are; a row is told from others by its id and a hash of
its text, so equal ids with different texts stay apart, and rows repeated as a whole count as copies.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, mixing, quality_fm, simhash, tokens
from tidemark.llm.common import prepare, table, written
from tidemark.session import scratch

#: Documents below this score are rejected.
MIN_QUALITY = 0.7


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns named by number, and the number's name of each column: what a stage adds meets no column of theirs."""
    names = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; all of them if it had no label to learn from."""
    prepare(spark)
    model = quality_fm.train(docs, table(spark, sf_dir, "labels"))
    if not model.learnt:
        return docs
    numbered, names = _apart(docs)
    scored = quality_fm.score(numbered, model, text_col=names["text"], meta_col=names["n_chars"])
    return scored.where(F.col("_fm_score") >= MIN_QUALITY).select(*names.values()).toDF(*names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    prepare(spark)
    return simhash.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of benchmark items."""
    prepare(spark)
    found = written(decontamination.matches(docs, table(spark, sf_dir, "benchmark")).select("id", "key").distinct(), "contaminated")
    numbered, names = _apart(docs)
    own, key = F.col(names["doc_id"]), F.xxhash64(F.col(names["text"]).cast("string"))
    left = numbered.join(found, (key == F.col("key")) & own.eqNullSafe(F.col("id")), "left_anti")
    return left.toDF(*names)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as the mix takes them.

    A document that the mix takes in part is whole here if at least half of it is taken, and left out if not.
    """
    prepare(spark)
    numbered, names = _apart(docs)
    sized = numbered.withColumn("size", mixing.size_of(F.col(names["text"])))
    copies = mixing.assign(sized, id_col=names["doc_id"], source_col=names["source"]).withColumn("copy", F.explode("_mix.copies"))
    whole = copies.where(F.col("copy.words") * 2 >= F.col("size")).withColumn("position", F.col("copy.position"))
    return mixing.scheduled(whole, "position", id_col=names["doc_id"]).select(*names.values()).toDF(*names)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' documents: ``doc_id, start, n_tokens, ids_crc32``."""
    prepare(spark)
    path = scratch(spark, "pipeline-token-ids")
    tokens.write(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return tokens.digests(tokens.spans(spark, path))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token_ids", token_ids),
]

#: No SQL twin: fitting, alignment and tokenizing have none. The tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
