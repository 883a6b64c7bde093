"""Passages of benchmark items in training documents, edited copies included.

The word n-grams of the items are looked up in all documents. An item's seeds are those of its n-grams that
are rare by the documents that hold them: rarity is relative to the median of the item's n-grams that occur at
all, so an item that is copied into very many documents keeps its seeds, and so do the n-grams that
survive in edited copies; only phrases of everyday language go. Around the seeds a document shares with an item, a
Smith-Waterman alignment of words scores the best local match, and pairs whose score is at least
``MIN_SCORE`` of the score of a whole copy are returned.

Pairs that share n-grams but not enough by seeds (an edited copy in so many documents that what it kept is frequent)
are aligned around all their shared n-grams, unless too few of the item's words stand there to reach
``MIN_SCORE``. The windows hold every alignment of that score through a shared n-gram, so rarity loses no pair.

Words are runs of letters, digits and underscores in lower case. Items with fewer than ``N`` words, null
items among them, are too short to show a copy and match nothing; null and empty texts match nothing.
Items enter in blocks of at most ``BLOCK_GRAMS`` n-grams, each held against all documents, so what is
sent to the tasks is bounded for any benchmark. Repeated rows of either table give repeated pairs; an
empty table gives an empty result. Only the ids and texts are read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, texts, written

N, MIN_SCORE = 3, 0.4
#: An item's n-gram is no seed if more documents hold it than both of these allow: so many, and so many times the item's median.
SEED_FLOOR, SEED_FACTOR = 10, 8
BLOCK_GRAMS = 200_000
#: Scores of equal words, different words and gaps.
MATCH, MISMATCH, GAP = 2, -1, -1
_WORD = re.compile(r"\w+")

Gram = tuple[str, ...]


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams_of(words: list[str]) -> list[Gram]:
    return list(zip(*(words[k:] for k in range(N)), strict=False))


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """The best local alignment's score and the place in the passage after its last word."""
    before = np.zeros(len(passage) + 1, np.int32)
    steps = np.arange(len(passage) + 1, dtype=np.int32) * -GAP
    best, end = 0, 0
    for word in item:
        now = np.zeros_like(before)
        now[1:] = np.maximum(before[:-1] + np.where(passage == word, MATCH, MISMATCH), before[1:] + GAP)
        np.maximum(now, 0, out=now)
        # A gap in the item: the best of all places to the left, less their distance.
        now = np.maximum.accumulate(now + steps) - steps
        top = int(now.argmax())
        if now[top] > best:
            best, end = int(now[top]), top
        before = now
    return best, end


class Items:
    """A block of benchmark items and their n-grams."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.items = items
        self.grams: dict[Gram, int] = {}
        #: By n-gram: the items that hold it and where.
        self.at: list[list[tuple[int, int]]] = []
        self.reach: list[int] = []
        for k, (_, words) in enumerate(items):
            for i, g in enumerate(grams_of(words)):
                n = self.grams.setdefault(g, len(self.grams))
                if n == len(self.at):
                    self.at.append([])
                    self.reach.append(0)
                self.at[n].append((k, i))
                # The item itself and as many inserted words as the matches can pay for.
                self.reach[n] = max(self.reach[n], 3 * len(words))
        self.known = frozenset(self.grams)

    def seeds(self, frequency: dict[int, int]) -> list[set[int]]:
        """The rare n-grams of each item; at least half of those that occur."""
        out = []
        for _, words in self.items:
            own = {n: frequency[n] for g in grams_of(words) if (n := self.grams[g]) in frequency}
            most = max(SEED_FLOOR, SEED_FACTOR * float(np.median(list(own.values())))) if own else 0
            out.append({n for n, d in own.items() if d <= most})
        return out


def _hits(docs: DataFrame, block: Items) -> DataFrame:
    """For each document with an n-gram of the block: places and numbers of its n-grams, and the words around them."""
    sent = docs.sparkSession.sparkContext.broadcast(block)
    kind = dict(docs.dtypes)["id"]

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        items, rows = sent.value, []
        for k, text in enumerate(texts(b["text"])):
            words = words_of(text)
            grams = grams_of(words)
            found = items.known.intersection(grams)
            if not found:
                continue
            at = [(i, items.grams[g]) for i, g in enumerate(grams) if g in found]
            begins: list[int] = []
            ends: list[int] = []
            for i, n in at:
                a, e = max(0, i - items.reach[n]), min(len(words), i + N + items.reach[n])
                # A later n-gram may reach further back than an earlier one.
                while ends and a <= ends[-1]:
                    a, e = min(a, begins.pop()), max(e, ends.pop())
                begins.append(a)
                ends.append(e)
            rows.append((k, [i for i, _ in at], [n for _, n in at], begins, [" ".join(words[a:e]) for a, e in zip(begins, ends, strict=True)]))
        k, places, grams, begins, passages = zip(*rows, strict=True) if rows else ((),) * 5
        take = pa.array(k, pa.int64())
        ints = pa.list_(pa.int32())
        return pa.RecordBatch.from_arrays(
            [b["id"].take(take), b["key"].take(take), pa.array(places, ints), pa.array(grams, ints), pa.array(begins, ints), pa.array(passages, pa.list_(pa.string()))],
            names=["id", "key", "places", "grams", "begins", "passages"],
        )

    return map_rows(docs, run, f"id {kind}, key long, places array<int>, grams array<int>, begins array<int>, passages array<string>")


def _aligned(hits: DataFrame, block: Items, seeds: list[set[int]], min_score: float, item_kind: str) -> DataFrame:
    sent = hits.sparkSession.sparkContext.broadcast((block, seeds))
    kind = dict(hits.dtypes)["id"]

    def best(passages: list[list[str]], item: list[str], places: list[tuple[int, int]], begins: np.ndarray, margin: int) -> tuple[float, int, int]:
        """Score of the best region, and its first and last word."""
        ids: dict[str, int] = {}
        wanted = np.array([ids.setdefault(w, len(ids)) for w in item], np.int32)
        whole = np.bincount(wanted)
        # N-grams whose distance along the document fits one copy are aligned together.
        starts = sorted(i - at for i, at in places)
        regions: list[list[int]] = []
        for s in starts:
            if regions and s - regions[-1][1] <= len(item):
                regions[-1][1] = s
            else:
                regions.append([s, s])
        out = (0.0, 0, 0)
        for a, e in regions:
            a, e = a - margin, e + len(item) + margin
            # The passage that holds the region.
            k = max(int(np.searchsorted(begins, max(a, 0), side="right")) - 1, 0)
            words = passages[k]
            a, e = max(a - begins[k], 0), min(e - begins[k], len(words))
            passage = np.array([ids.get(w, -1) for w in words[a:e]], np.int32)
            # No alignment matches a word more often than both sides hold it.
            most = int(np.minimum(whole, np.bincount(passage[passage >= 0], minlength=len(whole))).sum())
            if most < min_score * len(item):
                continue
            score, end = align(wanted, passage)
            if score / (MATCH * len(item)) > out[0]:
                out = score / (MATCH * len(item)), int(begins[k] + a), int(begins[k] + a + end)
        return out

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        items, own = sent.value
        rows = []
        for row in b.to_pylist():
            by_item: dict[int, list[tuple[int, int, bool]]] = defaultdict(list)
            for i, n in zip(row["places"], row["grams"], strict=True):
                for k, at in items.at[n]:
                    by_item[k].append((i, at, n in own[k]))
            begins = np.array(row["begins"])
            passages = [p.split(" ") for p in row["passages"]]
            for k, shared in by_item.items():
                item_id, words = items.items[k]
                rare = [(i, at) for i, at, seed in shared if seed]
                every = [(i, at) for i, at, _ in shared]
                # By all n-grams, far enough for the words that can be inserted at that score.
                for places, margin in ((rare, len(words) // 2), (every, int(2 * (1 - min_score) * len(words)) + 1)):
                    score, a, e = best(passages, words, places, begins, margin) if places else (0.0, 0, 0)
                    if score >= min_score:
                        rows.append((row["id"], row["key"], item_id, score, len({at for _, at in places}), a, e))
                        break
        columns = list(zip(*rows, strict=True)) if rows else [()] * 7
        kinds = [b.schema.field("id").type, pa.int64(), pa.int64() if item_kind == "bigint" else pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["id", "key", "item_id", "score", "n_seeds", "first_word", "end_word"])

    return map_rows(hits, run, f"id {kind}, key long, item_id {item_kind}, score double, n_seeds long, first_word long, end_word long")


def _blocks(benchmark: DataFrame, block_grams: int) -> Iterator[Items]:
    """The items in blocks; one row is with the driver at a time."""
    held, grams = [], 0
    for r in benchmark.toLocalIterator():
        words = words_of(r["text"] or "")
        if len(words) >= N:
            held.append((r["item_id"], words))
            grams += len(words) - N + 1
        if grams >= block_grams:
            yield Items(held)
            held, grams = [], 0
    if held:
        yield Items(held)


def matches(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", min_score: float = MIN_SCORE, block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """``id, key, item_id, score, n_seeds, first_word, end_word`` of the pairs found; ``key`` is the xxhash64 of the text."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    item_kind = "bigint" if dict(benchmark.dtypes)[item_col] in ("bigint", "int", "smallint", "tinyint") else "string"
    items = benchmark.select(F.col(item_col).cast(item_kind).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    found = None
    for block in _blocks(items, block_grams):
        hits = written(_hits(rows, block), "benchmark-hits")
        # One row an n-gram of the block.
        frequency = {r["n"]: r["d"] for r in hits.select(F.explode(F.array_distinct("grams")).alias("n")).groupBy("n").agg(F.count("*").alias("d")).collect()}
        pairs = _aligned(hits, block, block.seeds(frequency), min_score, item_kind)
        found = pairs if found is None else found.unionByName(pairs)
    if found is None:
        found = rows.where("false").select("id", "key", F.lit(None).cast(item_kind).alias("item_id"), F.lit(0.0).alias("score"), *[F.lit(0).cast("long").alias(c) for c in ("n_seeds", "first_word", "end_word")])
    return found
