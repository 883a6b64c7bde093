"""Language identification by cross-parsing entropy.

``learn`` takes a bounded sample of labelled text of each language. Every Python worker builds the suffix automaton of
each sample and completes it: a missing transition goes on from the root and starts a phrase. Reading
a text through that automaton is the cross-parsing: each phrase is the longest match with the sample, and a byte that no
sample has is a phrase of its own. ``phrases * log2(sample bytes + 256) / text bytes`` estimates
the cross entropy, and the language with the least wins. All languages and all texts of a block advance together, one byte
a step; texts that are left when few remain are read one by one through the same tables, with equal results.

Texts are read whole: in lower case, as UTF-8 bytes, ASCII other than letters as one space.

Bounds of the sample, all parameters: the ``LANGUAGES`` labels with the most documents, of each at most ``DOCUMENTS``
different texts, those with the least hashes, of each a window of at most ``WINDOW`` characters at a place drawn
from the hash, and ``SAMPLE_BYTES`` over all languages, shared equally. A sample depends on the rows alone, not on
how files are split.

A null text and one without a letter are ``und`` with score 0; so are all if nothing was learnt. Ties go to
the language whose code points come first. ``score`` is the runner-up's share of the two best entropies: one half if
they are equal, 1 for a single language. A null id is neither learnt nor held out. Repeated rows give equal rows,
an empty table none. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_hash

LANGUAGES, DOCUMENTS, WINDOW, SAMPLE_BYTES = 64, 160, 400, 256 << 10
#: Parts of a language whose least hashes are found apart.
SLICES = 97
UNKNOWN = "und"
#: Text and rows that advance together, and lanes below which texts are read one by one.
BLOCK_BYTES, BLOCK_ROWS, FEW = 6 << 20, 4000, 96

_LETTER = re.compile(r"[^\W\d_]")
_SPACES = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(id_hash(doc_id) % 4 == 2, F.lit(False))


def normalised(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_SPACES).split())


@dataclass(frozen=True)
class Model:
    """Languages in ascending order with the normalised text of each."""

    languages: tuple[str, ...]
    samples: tuple[bytes, ...]


def suffix_automaton(data: bytes) -> list[dict[int, int]]:
    """Transitions of the least automaton of all substrings of ``data``; state 0 is the root."""
    step, link, length, last = [{}], [-1], [0], 0
    for c in data:
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] != length[p] + 1:
                copy = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = copy
                q = copy
            link[new] = q
        last = new
    return step


class Parser:
    """The completed automata of all languages in one table.

    An entry is twice the row offset of the next state, plus one if the byte starts a phrase.
    """

    def __init__(self, samples: tuple[bytes, ...]):
        seen = sorted(set(b"".join(samples)))
        self.width = len(seen) + 1
        # UTF-8 never uses all byte values, so one is left for the unseen.
        self.code = np.full(256, len(seen), np.uint8)
        self.code[seen] = np.arange(len(seen))
        tables, roots, base = [], [], 0
        for sample in samples:
            step = suffix_automaton(sample)
            root = np.full(self.width, base, np.int64)
            for c, to in step[0].items():
                root[self.code[c]] = base + to
            whole = np.repeat((root * self.width * 2 + 1)[None, :], len(step), axis=0)
            known = np.array([(s, c, to) for s, row in enumerate(step) if s for c, to in row.items()], np.int64).reshape(-1, 3)
            whole[known[:, 0], self.code[known[:, 1]]] = (base + known[:, 2]) * self.width * 2
            tables.append(whole.astype(np.int32))
            roots.append(base * self.width * 2)
            base += len(step)
        self.table = np.concatenate(tables).ravel()
        self.roots = np.array(roots, np.int32)
        self.cells = memoryview(self.table)

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Number of phrases of each text (rows) by each language (columns)."""
        sizes = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        data = self.code[np.frombuffer(b"".join(texts[i] for i in order), np.uint8)]
        state = np.repeat(self.roots[:, None], len(texts), axis=1)
        count = np.zeros(state.shape, np.int64)
        at = 0
        for end in np.unique(sizes):
            active = int(np.searchsorted(-sizes, -end, side="right"))
            if active * len(self.roots) < FEW:
                break
            v, n, place = state[:, :active], np.zeros((len(self.roots), active), np.int32), starts[:active]
            for t in range(at, end):
                v = self.table.take((v >> 1) + data[place + t].astype(np.int64))
                n += v & 1
            state[:, :active] = v
            count[:, :active] += n
            at = end
        for i in range(int(np.searchsorted(-sizes, -at, side="left"))):
            rest = data[starts[i] + at : starts[i] + sizes[i]].tobytes()
            for k in range(len(self.roots)):
                count[k, i] += self._one(rest, int(state[k, i]))
        out = np.empty((len(texts), len(self.roots)), np.int64)
        out[order] = count.T
        return out

    def _one(self, codes: bytes, v: int) -> int:
        cells, n = self.cells, 0
        for c in codes:
            v = cells[(v >> 1) + c]
            n += v & 1
        return n


@lru_cache(maxsize=1)
def parser(samples: tuple[bytes, ...]) -> Parser:
    """One parser for each Python worker."""
    return Parser(samples)


def learn(
    docs: DataFrame, *, languages: int = LANGUAGES, documents: int = DOCUMENTS, window: int = WINDOW, sample_bytes: int = SAMPLE_BYTES,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> Model:
    """A model of the documents that are not held out and have a language."""
    doc_id = F.col(f"`{id_col}`")
    labelled = docs.where(doc_id.isNotNull() & ~held_out(doc_id)).select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    labelled = labelled.where(F.col("lang").isNotNull() & (F.length("text") > 0))
    used = [r["lang"] for r in labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()]
    if not used:
        return Model((), ())
    hashed = labelled.where(F.col("lang").isin(used)).withColumn("hash", F.xxhash64("text"))
    spare = F.greatest(F.length("text") - window, F.lit(0)) + 1
    cut = hashed.select("lang", "hash", F.substring("text", F.pmod("hash", spare).cast("int") + 1, F.lit(window)).alias("piece"))

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Only what can be among the least of all rows leaves the task.
        kept: dict[str, dict[int, str]] = {}
        for b in batches:
            for lang, h, piece in zip(*(b[k].to_pylist() for k in range(3)), strict=True):
                kept.setdefault(lang, {})[h] = piece
            kept = {lang: {h: rows[h] for h in sorted(rows)[:documents]} for lang, rows in kept.items()}
        rows = [(lang, h, piece) for lang, pieces in kept.items() for h, piece in pieces.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.string()))], names=["lang", "hash", "piece"])

    rows = cut.mapInArrow(least, "lang string, hash long, piece string").groupBy("lang", "hash").agg(F.min("piece").alias("piece"))
    # The least of every slice of a language first, so that no task orders what all tasks have kept.
    for keys in (["lang", F.pmod("hash", F.lit(SLICES))], ["lang"]):
        rows = rows.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("hash"))).where(F.col("place") <= documents)
    rows = rows.orderBy("lang", "place").collect()
    pieces: dict[str, list[bytes]] = {}
    for r in rows:
        pieces.setdefault(r["lang"], []).append(normalised(r["piece"]))
    # Pieces are apart by a byte that no normalised text has.
    share = sample_bytes // len(pieces)
    samples = {lang: b"\n".join(p)[:share] for lang, p in sorted(pieces.items())}
    return Model(tuple(samples), tuple(samples.values()))


def identify(texts: list[str], model: Model) -> list[tuple[str, float]]:
    """Language and score of each text."""
    out = [(UNKNOWN, 0.0)] * len(texts)
    rows = [i for i, t in enumerate(texts) if model.languages and _LETTER.search(t)]
    if not rows:
        return out
    weights = np.log2(np.array([len(s) for s in model.samples]) + 256.0)
    bits = parser(model.samples).phrases([normalised(texts[i]) for i in rows]) * weights
    best = np.argmin(bits, axis=1)
    least = np.take_along_axis(bits, best[:, None], axis=1)[:, 0]
    np.put_along_axis(bits, best[:, None], np.inf, axis=1)
    second = bits.min(axis=1)
    score = np.where(np.isinf(second), 1.0, second / np.where(np.isinf(second), 1.0, second + least))
    for i, k, s in zip(rows, best.tolist(), score.tolist(), strict=True):
        out[i] = (model.languages[k], s)
    return out


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    doc_id = F.col(f"`{id_col}`")
    rows = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(block: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            some = [t or "" for b in block for t in b["text"].to_pylist()]
            found = identify(some, model)
            for b in block:
                here, found = found[: b.num_rows], found[b.num_rows :]
                columns = [pa.array([x for x, _ in here], pa.string()), pa.array([s for _, s in here], pa.float64())]
                yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], *columns], names=["doc_id", "held_out", "lang_pred", "score"])

        block, size, n = [], 0, 0
        for b in batches:
            block.append(b)
            size += b["text"].nbytes
            n += b.num_rows
            if size >= BLOCK_BYTES or n >= BLOCK_ROWS:
                yield from flush(block)
                block, size, n = [], 0, 0
        if block:
            yield from flush(block)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(parse, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
