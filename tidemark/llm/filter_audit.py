"""Filter interaction audit on a sparse document-term matrix.

``encode`` makes the matrix in two column blocks. A first pass finds the frequent words: every task hands on words that make up one in
``HEAD`` or more of its own words, and those with that share of all words form the head of the dictionary, at most ``HEAD`` of at most
``HEAD_BYTES`` bytes each, so its size is bounded and it goes to all tasks. A word that is twice as frequent is never
missed. A second pass encodes the texts into CSR shards (``indptr, indices, data``, one shard a batch of documents) over the head's columns
and beside them over the tail's. The remaining words, none of which is frequent, have a 62-bit hash for their global id, the same in
every shard, so no word has to travel; each shard holds the slice of the dictionary that it uses. Should two words of a document share an id, they stay
two entries, so sums and counts are exact. ``row_stats`` adds up row sums (words) and nonzero counts (distinct words) of both blocks.

``audit`` decides the five filters of a document (A and B by the matrix, C, D and E by flags that the second pass wrote), reduces the
documents to counts by part and combination of failures and only then opens the 120 orders. Copies of a text are first
counted by text and id, so a text that a third of all rows share is never in one task.

Words are maximal runs without ASCII white space, told apart by their bytes. A null text is an empty one; a null language
is the empty string. Rows of one id are separate documents. A null id is never larger than another id, so it isn't a copy and makes none,
and has no label. An id counts as good or toxic if any of its labels says so. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import byte_strings, split_words, written

#: Words in the dictionary's head at most, and bytes of each at most.
HEAD, HEAD_BYTES = 2_000_000, 16
#: Different words that a task counts before it hands them on, words counted at once, documents of a shard at most.
COUNTED, AT_ONCE, SHARD_ROWS = 500_000, 1_000_000, 1 << 16
FILTERS = "ABCDE"

#: Bytes of A to Z, and those that continue a code point.
_UPPER, _CONTINUED, _MARKS = bytes(range(0x41, 0x5B)), bytes(range(0x80, 0xC0)), b"#$%&*|"
_SHARD = "shard long, indptr array<int>, indices array<int>, data array<int>"
_DOCS = "docs array<struct<row long, doc_id {id}, part string, digest binary, c boolean, d boolean>>"
_TAIL = "words array<binary>, ids array<long>, tail_indptr array<int>, tail_indices array<long>, tail_data array<int>"


@dataclass(frozen=True)
class Matrix:
    """Shards of both column blocks with the documents' flags, and the head's words in order of their ids."""

    shards: DataFrame
    words: list[bytes]

    @property
    def head(self) -> DataFrame:
        return self.shards.select("shard", "indptr", "indices", "data", "docs")

    @property
    def tail(self) -> DataFrame:
        return self.shards.select("shard", F.col("docs.row").alias("rows"), *[F.col(f"tail_{c}").alias(c) for c in ("indptr", "indices", "data")])

    @property
    def tail_dictionary(self) -> DataFrame:
        """``word, id`` of the words outside the head."""
        return self.shards.select(F.explode(F.arrays_zip("words", "ids")).alias("x")).select(F.col("x.words").alias("word"), F.col("x.ids").alias("id")).distinct()


def _texts(docs: DataFrame, text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("text")


def _one(arrow: pa.Array | np.ndarray) -> pa.ListArray:
    """A list column of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(arrow)], pa.int32()), arrow if isinstance(arrow, pa.Array) else pa.array(arrow))


def frequent_words(docs: DataFrame, *, text_col: str = "text", head_words: int = HEAD) -> list[bytes]:
    """The head of the dictionary, most frequent words first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(seen: dict[bytes, int]) -> pa.RecordBatch:
            total = sum(seen.values())
            least = math.ceil(total / head_words)
            some = [(w, n) for w, n in seen.items() if n >= least and len(w) <= HEAD_BYTES]
            # Without a word: how many there were.
            some.append((None, total))
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.binary()), pa.array([n for _, n in some], pa.int64())], names=["word", "n"])

        seen: dict[bytes, int] = {}
        held: list[pa.Array] = []

        def take() -> None:
            some = pa.concat_arrays(held).value_counts()
            held.clear()
            words, n = byte_strings(some.field(0)), some.field(1).to_numpy()
            before = np.fromiter(map(seen.get, words, repeat(0)), np.int64, len(words))
            seen.update(zip(words, (before + n).tolist(), strict=True))

        for b in batches:
            held.append(split_words(b["text"])[0])
            if sum(map(len, held)) >= AT_ONCE:
                take()
                if len(seen) >= COUNTED:
                    yield flush(seen)
                    seen.clear()
        if held:
            take()
        yield flush(seen)

    counts = docs.select(_texts(docs, text_col)).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = written(counts, "audit-words", "zstd")
    total = counted.where("word IS NULL").agg(F.sum("n")).first()[0] or 0
    common = counted.where(F.col("word").isNotNull() & (F.col("n") >= math.ceil(total / head_words)))
    return common.orderBy(F.desc("n"), "word").select("word").toArrow()["word"].to_pylist()


def _flags(text: bytes) -> tuple[bytes, bool, bool]:
    """Digest of a text, and whether it fails C and D."""
    points, upper = len(text.translate(None, _CONTINUED)), len(text) - len(text.translate(None, _UPPER))
    return hashlib.sha256(text).digest(), 100 * upper > 3 * points, any(m in text for m in _MARKS)


def _csr(place: np.ndarray, column: np.ndarray, n: np.ndarray, rows: int) -> list[np.ndarray]:
    """``indptr, indices, data`` of entries that are in order of their rows and columns."""
    return [np.searchsorted(place, np.arange(rows + 1)).astype(np.int32), column, n]


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", head_words: int = HEAD) -> Matrix:
    """The matrix of all documents, written to the shared folder."""
    spark = docs.sparkSession
    words = frequent_words(docs, text_col=text_col, head_words=head_words)
    known = spark.sparkContext.broadcast({word: k for k, word in enumerate(words)})

    doc_id = F.col(f"`{id_col}`")
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("part"), _texts(docs, text_col))
    kind = rows.schema["doc_id"].dataType

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, partition, k = known.value.get, TaskContext.get().partitionId(), 0
        for whole in batches:
            for at in range(0, whole.num_rows, SHARD_ROWS):
                b = whole.slice(at, SHARD_ROWS)
                shard = partition << 24 | k
                k += 1
                found, sizes = split_words(b["text"])
                codes = found.dictionary_encode()
                own = byte_strings(codes.dictionary)
                ids = np.fromiter(map(get, own, repeat(-1)), np.int64, len(own))
                rare = np.flatnonzero(ids < 0)
                rare_ids = tail_ids([own[w] for w in rare], len(words))
                ids[rare] = rare_ids
                # Local numbers in the order of the ids, so entries come in order of the documents, then of the columns.
                by_id = np.argsort(ids, kind="stable")
                rank = np.empty(len(own), np.int64)
                rank[by_id] = np.arange(len(own))
                ids = ids[by_id]
                entries, n = np.unique(np.repeat(np.arange(b.num_rows), sizes) * max(1, len(own)) + rank[codes.indices.to_numpy()], return_counts=True)
                place, column = np.divmod(entries, max(1, len(own)))
                column, n = ids[column], n.astype(np.int32)
                inside = column < len(words)
                outside = ~inside
                head = _csr(place[inside], column[inside].astype(np.int32), n[inside], b.num_rows)
                tail = _csr(place[outside], column[outside], n[outside], b.num_rows)
                digest, c, d = zip(*map(_flags, byte_strings(b["text"])), strict=True)
                structs = pa.StructArray.from_arrays(
                    [pa.array(shard * SHARD_ROWS + np.arange(b.num_rows)), b["doc_id"], b["part"], pa.array(digest, pa.binary()), pa.array(c), pa.array(d)], ["row", "doc_id", "part", "digest", "c", "d"]
                )
                parts = [*head, structs, codes.dictionary.take(pa.array(rare)), rare_ids, *tail]
                names = ["shard", "indptr", "indices", "data", "docs", "words", "ids", "tail_indptr", "tail_indices", "tail_data"]
                yield pa.RecordBatch.from_arrays([pa.array([shard]), *map(_one, parts)], names=names)

    made = written(rows.mapInArrow(shards, f"{_SHARD}, {_DOCS.format(id=kind.simpleString())}, {_TAIL}"), "audit-shards", "zstd")
    return Matrix(made, words)


def tail_ids(words: list[bytes], first_id: int) -> np.ndarray:
    """Ids of words outside the head, ``first_id`` or more; the same in every task."""
    some = np.empty(len(words), object)
    some[:] = words
    return (pd.util.hash_array(some, categorize=False) >> np.uint64(2)).astype(np.int64) + first_id


def _sums(indptr: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row sums and nonzero counts of a CSR block."""
    total = np.concatenate([[0], np.cumsum(data, dtype=np.int64)])
    return total[indptr[1:]] - total[indptr[:-1]], np.diff(indptr).astype(np.int64)


def row_stats(matrix: Matrix) -> DataFrame:
    """Each document's flags with ``words`` (row sum) and ``distinct`` (nonzero count)."""
    docs_type = matrix.shards.schema["docs"].dataType.simpleString()

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                blocks = [_sums(b[f"{c}indptr"][k].values.to_numpy(), b[f"{c}data"][k].values.to_numpy()) for c in ("", "tail_")]
                words, distinct = (sum(x) for x in zip(*blocks, strict=True))
                yield pa.RecordBatch.from_arrays([b["docs"].slice(k, 1), _one(words), _one(distinct)], names=["docs", "words", "distinct"])

    added = matrix.shards.select("docs", "indptr", "data", "tail_indptr", "tail_data").mapInArrow(stats, f"docs {docs_type}, words array<long>, distinct array<long>")
    return added.select(F.explode(F.arrays_zip("docs", "words", "distinct")).alias("x")).select("x.docs.*", "x.words", "x.distinct")


def failures(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, docs, good, toxic``: documents by part and set of failed filters (bit k: the k-th of ``FILTERS``)."""
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    # Rows without an id meet no label; their row number keeps them from gathering in one task.
    spread = F.when(F.col("doc_id").isNull(), F.col("row")).otherwise(F.lit(-1))
    marked = stats.withColumn("spread", spread).join(marks.withColumn("spread", F.lit(-1).cast("long")), ["doc_id", "spread"], "left")
    bits = [F.col("words") < 200, 100 * F.col("distinct") < 50 * F.col("words"), F.col("c"), F.col("d")]
    mask = sum((F.when(b, 1 << k).otherwise(0) for k, b in enumerate(bits)), F.lit(0))
    keys = ["digest", "part", "mask", "good", "toxic"]
    rows = marked.select("doc_id", "digest", "part", mask.alias("mask"), *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    # By text and id, then by text: the least id of each text and how many rows have it.
    by_id = rows.groupBy("doc_id", *keys).agg(F.count("*").alias("docs"))
    found = F.col("doc_id").isNotNull()
    by_text = by_id.groupBy(*keys).agg(
        F.sum("docs").alias("docs"),
        F.coalesce(F.sum(F.when(~found, F.col("docs"))), F.lit(0)).alias("unnamed"),
        F.min("doc_id").alias("least"),
        F.coalesce(F.min_by(F.when(found, F.col("docs")), F.when(found, F.col("doc_id"))), F.lit(0)).alias("at_least"),
    )
    # A text has a row for each part and label now, so its rows are few.
    overall = F.min("least").over(Window.partitionBy("digest"))
    first = F.col("unnamed") + F.when(F.col("least") == F.col("overall"), F.col("at_least")).otherwise(0)
    split = by_text.withColumn("overall", overall).withColumn("first", first)
    both = F.explode(F.array(F.struct(F.col("mask").alias("mask"), F.col("first").alias("docs")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("docs") - F.col("first")).alias("docs"))))
    opened = split.select("part", "good", "toxic", both.alias("x")).select("part", "good", "toxic", "x.*").where(F.col("docs") > 0)
    return opened.groupBy("part", "mask").agg(
        F.sum("docs").alias("docs"),
        F.sum(F.when(F.col("good"), F.col("docs")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("docs")).otherwise(0)).alias("toxic"),
    )


def steps() -> list[tuple]:
    """What each order does at each step with each of the 32 sets of failed filters (a fixed 19 200 rows)."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            for mask in range(1 << len(FILTERS)):
                fails, gone = bool(mask & bit), bool(mask & before)
                # Of all orders, a document with k failures meets each of them first in one k-th.
                shapley = math.factorial(len(FILTERS)) // mask.bit_count() if fails else 0
                out.append(("".join(order), step, mask, not gone and not fails, fails and not gone, fails and gone, mask == bit, shapley))
            before |= bit
    return out


def audit(counts: DataFrame) -> DataFrame:
    """Every part, order and step with its counts, from ``failures``."""
    table = counts.sparkSession.createDataFrame(steps(), "filter_order string, step int, mask int, is_kept boolean, is_removed boolean, is_redundant boolean, is_unique boolean, share long")
    met = counts.join(F.broadcast(table), "mask")

    def total(flag: str, amount: str = "docs") -> Column:
        return F.sum(F.when(F.col(flag), F.col(amount)).otherwise(0))

    return met.groupBy("part", "filter_order", "step").agg(
        total("is_kept").alias("kept"),
        total("is_removed").alias("removed"),
        total("is_redundant").alias("redundant"),
        total("is_unique").alias("unique_fails"),
        total("is_removed", "good").alias("good_lost"),
        total("is_removed", "toxic").alias("toxic_lost"),
        F.sum(F.col("docs") * F.col("share")).alias("shapley"),
    )


def run(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of ``docs`` with ``labels`` (``doc_id, quality, toxic``)."""
    return audit(failures(row_stats(encode(docs)), labels))
