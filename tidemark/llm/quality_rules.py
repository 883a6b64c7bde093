"""Quality rules: word and line counts, and Jensen-Shannon distance from language references.

The references are made from all documents: for every language, the shares of character classes and of
the ``COMMON`` most frequent words, all other words being one more share. A document is held against each
language and judged by the one it is nearest to, whatever language it claims. It is kept if neither distance
is over its limit. Histograms of fewer than ``MIN_CHARS`` characters or ``MIN_WORDS`` words are too short
to judge and never reject. Documents that fail the base rules are not kept in any case.

Null and empty texts have no words and fail the base rules. Null languages give no reference, and languages
with under ``MIN_REFERENCE`` documents neither; documents that claim a language without a reference are left to the
base rules, their distances being from other languages; without any reference only the base rules judge. Rows are
judged one by one, so repeated rows give repeated rows; an empty table gives an empty result. Only the id,
the text and the language are read.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, texts, written

COMMON, MIN_CHARS, MIN_WORDS, MIN_REFERENCE = 100, 200, 50, 20
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.08, 0.24
#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 200_000

CLASSES = ["white", "newline", "symbol", "digit", "lower", "upper", "lower_other", "upper_other", "mark", "other"]
_SYMBOLS, _WHITE = "#*$%&|<>", " \t\x0b\x0c\r"
_TABLE_SIZE = 0x3000


def _class(c: str) -> str:
    if c == "\n":
        return "newline"
    if c in _WHITE:
        return "white"
    if c in _SYMBOLS:
        return "symbol"
    kind = unicodedata.category(c)
    if kind == "Nd":
        return "digit"
    if kind in ("Ll", "Lu"):
        return ("lower" if kind == "Ll" else "upper") + ("" if c.isascii() else "_other")
    return "mark" if kind[0] == "P" else "other"


_TABLE = np.array([CLASSES.index(_class(chr(i))) for i in range(_TABLE_SIZE)] + [CLASSES.index("other")], np.uint8)


def classes(text: str) -> np.ndarray:
    """Characters of each class."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.bincount(_TABLE[np.minimum(points, _TABLE_SIZE)], minlength=len(CLASSES))


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three words that is found twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts, covered, end = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance squared (base 2, from 0 to 1) of the histogram ``p`` from each row of ``q``."""
    m = (p + q) / 2

    def part(x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / m), 0.0).sum(axis=-1)

    return (part(np.broadcast_to(p, q.shape)) + part(q)) / 2


def references(docs: DataFrame) -> list[tuple[str, list[int], dict[str, int]]]:
    """Language, characters of each class and common words with their counts (all words under the key "").

    Only a row a language and ``COMMON`` words of it come to the driver.
    """
    known = docs.where("lang IS NOT NULL")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = defaultdict(Counter)
        chars: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(CLASSES) + 2, np.int64))

        def out(rows: list[tuple]) -> pa.RecordBatch:
            lang, word, n, hist = zip(*rows, strict=True) if rows else ((), (), (), ())
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(word, pa.string()), pa.array(n, pa.int64()), pa.array(hist, pa.list_(pa.int64()))], names=["lang", "word", "n", "hist"])

        def flush() -> Iterator[pa.RecordBatch]:
            rows = [(lang, w.decode(), n, None) for lang, c in words.items() for w, n in c.items()]
            words.clear()
            for at in range(0, len(rows), 20_000):
                yield out(rows[at : at + 20_000])

        for b in batches:
            for lang, text in zip(b["lang"].to_pylist(), texts(b["text"]), strict=True):
                tokens = text.lower().encode().split()
                words[lang].update(tokens)
                chars[lang] += np.array([*classes(text), len(tokens), 1])
            if sum(map(len, words.values())) > HELD_WORDS:
                yield from flush()
        yield from flush()
        if chars:
            yield out([(lang, None, 0, h.tolist()) for lang, h in chars.items()])

    counted = written(known.mapInArrow(count, "lang string, word string, n long, hist array<long>"), "quality-counts")
    hists = counted.where("word IS NULL").groupBy("lang").agg(*[F.sum(F.col("hist")[i]).alias(f"h{i}") for i in range(len(CLASSES) + 2)])
    found = {r["lang"]: [r[f"h{i}"] for i in range(len(CLASSES) + 2)] for r in hists.where(f"h{len(CLASSES) + 1} >= {MIN_REFERENCE}").collect()}
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    sums = counted.where("word IS NOT NULL").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    top: dict[str, dict[str, int]] = defaultdict(dict)
    for r in sums.withColumn("k", F.row_number().over(order)).where(f"k <= {COMMON}").collect():
        if r["lang"] in found:
            top[r["lang"]][r["word"]] = r["n"]
    return [(lang, h[: len(CLASSES)], {"": h[len(CLASSES)], **top[lang]}) for lang, h in sorted(found.items()) if sum(h[: len(CLASSES)])]


class Judge:
    """Distances of texts from the references."""

    def __init__(self, refs: list[tuple[str, list[int], dict[str, int]]]):
        self.langs = [lang for lang, _, _ in refs]
        self.chars = np.array([np.array(h) / sum(h) for _, h, _ in refs]).reshape(-1, len(CLASSES))
        self.words = [{w.encode(): i for i, w in enumerate(x for x in top if x)} for _, _, top in refs]
        self.shares = []
        for _, _, top in refs:
            own = np.array([n for w, n in top.items() if w], float)
            self.shares.append(np.append(own, max(top[""] - own.sum(), 0)) / max(top[""], 1))

    def __call__(self, chars: np.ndarray, lowered: list[bytes]) -> tuple[str | None, float | None, float | None]:
        if not self.langs:
            return None, None, None
        by_chars = distance(chars / chars.sum(), self.chars) if chars.sum() >= MIN_CHARS else None
        by_words = None
        if len(lowered) >= MIN_WORDS:
            counts, by_words = Counter(lowered), []
            for own, share in zip(self.words, self.shares, strict=True):
                hist = np.zeros(len(share))
                for w in counts.keys() & own.keys():
                    hist[own[w]] = counts[w]
                hist[-1] = len(lowered) - hist.sum()
                by_words.append(float(distance(hist / len(lowered), share[None])[0]))
        both = (by_chars if by_chars is not None else 0) + (np.array(by_words) if by_words else 0)
        i = int(np.argmin(both)) if np.ndim(both) else 0
        return self.langs[i], None if by_chars is None else float(by_chars[i]), None if by_words is None else by_words[i]


def score(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Counts, distances, ``base_failed`` and ``kept`` for every document."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    judge = docs.sparkSession.sparkContext.broadcast(Judge(references(rows)))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, claimed in zip(texts(b["text"]), b["lang"].to_pylist(), strict=True):
            raw = text.encode()
            words, chars = raw.split(), classes(text)
            white = int(chars[0] + chars[1])
            repeated = repeated_words(words)
            failed = len(words) < 50 or 100 * repeated > 50 * len(words)
            lang, by_chars, by_words = judge.value(chars, text.lower().encode().split())
            judged = claimed is None or claimed in judge.value.langs
            far = judged and ((by_chars or 0) > MAX_CHAR_DISTANCE or (by_words or 0) > MAX_WORD_DISTANCE)
            out.append((len(words), len(text) - white, int(chars[2]), duplicate_lines(raw), repeated, failed, not failed and not far, lang, by_chars, by_words))
        columns = list(zip(*out, strict=True)) if out else [()] * 10
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()] + [pa.float64()] * 2
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "nearest_lang", "char_distance", "word_distance"]
        return pa.RecordBatch.from_arrays([b["id"], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["id", *names])

    schema = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, nearest_lang string, char_distance double, word_distance double"
    kind = dict(rows.dtypes)["id"]
    return map_rows(rows, run, f"id {kind}, {schema}").withColumnRenamed("id", id_col)
