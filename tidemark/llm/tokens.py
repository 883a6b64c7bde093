"""Token ids in ORC files: run-length encoded integers, row indexes and Bloom filters on document ids.

``write`` orders the documents by id over many files, encodes every whole text and stores
``doc_id, file_start, n_tokens, ids`` (``file_start``: ids of the part before the document). ``read``
opens the files: a filter on ``doc_id`` skips stripes and row groups by their indexes and Bloom filters,
and stripes are read in parallel. ``spans`` adds the start of every document in the whole token stream.

Null and empty texts are one end id. Null ids come first; rows with the same id stand beside each other,
equal texts with equal results; an empty table gives empty files. Ids are whole numbers: what can't be read as one is
a null id. Only the id and the text are read, so other columns may have any name.

Texts are cut at ASCII white space before encoding. The tokenizer drops white space and never joins
across it, so the ids are those of the whole text; words met before come from a bounded cache.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import byte_strings, gathered, map_rows, split_words, written

END_ID = 1
#: Words that are no letters with marks behind, and pieces of the others, that one Python worker remembers; beyond it only short ones stay.
CACHED_WORDS, CACHED_PIECES = 1_200_000, 1_200_000
#: Bytes of the batches that are encoded at once, at least.
BATCH_BYTES = 6 << 20
#: Documents of one row index entry, bytes of one stripe.
INDEX_STRIDE, STRIPE_BYTES = 1000, 16 << 20
#: Special token of the vocabulary put between words that are encoded together.
SEPARATOR = "<|startoftext|>"
#: ASCII marks but the apostrophe, which the tokenizer joins with letters.
_MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'")
#: Kinds of bytes: ASCII letters, parts of other characters, those marks, all others.
_HIGH, _MARK, _OTHER = 1, 2, 3
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[c for c in range(0x80) if chr(c).isalpha()]] = 0
_KIND[0x80:] = _HIGH
_KIND[list(_MARKS)] = _MARK


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Binary values that lie end to end."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


class WordEncoder:
    """Ids of texts as little-endian 32-bit integers."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.separator = self.tokenizer.token_to_id(SEPARATOR)
        # Only a tokenizer with word ends that drops white space can be fed word by word.
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        self.by_word = bool(suffix) and self.separator is not None
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        #: Characters that stay letters when they are normalised, and all others; as many as the texts have.
        self.letters: set[str] = set()
        self.others: set[str] = set()
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[bytes, bytes] = {b"": b""}

    def _encode(self, some: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]

    def _apart(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word; the separator is encoded between them."""
        # A word that holds special tokens is encoded alone.
        plain = [w for w in words if b"<|" not in w]
        alone = [w for w in words if b"<|" in w]
        out = {w: ids.tobytes() for w, ids in zip(alone, self._encode([w.decode() for w in alone]), strict=True)}
        if plain:
            ids = self._encode([f" {SEPARATOR} ".join(w.decode() for w in plain)])[0]
            cuts = np.flatnonzero(ids == self.separator)
            starts, ends = [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]
            out |= {w: ids[a:b].tobytes() for w, a, b in zip(plain, starts, ends, strict=True)}
        return [out[w] for w in words]

    def _letters(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of letters; each should be one run up to a token with the word end."""
        ids = self._encode([b" ".join(words).decode()])[0]
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words):
            return self._apart(words)
        raw, at = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

    def _letters_only(self, cores: list[bytes]) -> list[bool]:
        """Which words are letters alone once they are normalised; one that gains a mark belongs together with what follows.

        Letters are looked at one by one, as they only join with each other to other letters.
        """
        texts = b" ".join(cores).decode().split(" ")
        normalizer = self.tokenizer.normalizer
        for c in set().union(*texts) - self.letters - self.others:
            plain = c.isalpha() and (normalizer.normalize_str(c) if normalizer else c).isalpha()
            (self.letters if plain else self.others).add(c)
        return [bool(t) and plain for t, plain in zip(texts, map(self.others.isdisjoint, texts), strict=True)]

    @staticmethod
    def _from(pool: dict[bytes, bytes], words: list[bytes], learn: Callable[[list[bytes]], list[bytes]]) -> list[bytes]:
        """Ids of different words; what the pool doesn't know is learnt."""
        found = list(map(pool.get, words))
        if None in found:
            new = [w for w, ids in zip(words, found, strict=True) if ids is None]
            for at in range(0, len(new), 2000):
                pool.update(zip(new[at : at + 2000], learn(new[at : at + 2000]), strict=True))
            found = list(map(pool.__getitem__, words))
        return found

    def _parts(self, words: pa.Array) -> tuple[list[bytes], np.ndarray]:
        """Ids of the parts of different words, and the places of each word's two parts among them; the first is empty.

        The tokenizer splits a word between letters and marks, so both are looked up for themselves. Other words are one part.
        """
        offsets = np.frombuffer(words.buffers()[1], np.int32)[: len(words) + 1].astype(np.int64)
        starts, sizes = offsets[:-1], np.diff(offsets)
        data = np.frombuffer(words.buffers()[2], np.uint8)[: offsets[-1]]
        kind = _KIND[data]
        ends = np.maximum(np.maximum.reduceat(np.where(kind == _MARK, 0, np.arange(1, len(data) + 1)), starts), starts)

        def in_core(wanted: np.ndarray) -> np.ndarray:
            before = np.concatenate([[0], np.cumsum(wanted)])
            return before[ends] - before[starts]

        plain = (ends > starts) & (in_core(kind >= _MARK) == 0)
        # Lower case is for ASCII alone here; other letters keep theirs.
        lower = data + ((data >= 0x41) & (data <= 0x5A) & np.repeat(plain & (in_core(kind == _HIGH) == 0), sizes)) * np.uint8(32)
        inside = np.arange(len(data)) < np.repeat(np.where(plain, ends, starts), sizes)
        cores = _binary(lower[inside], (ends - starts)[plain]).dictionary_encode()
        tails = _binary(data[~inside & np.repeat(plain, sizes)], (offsets[1:] - ends)[plain]).dictionary_encode()
        some = byte_strings(cores.dictionary)
        letters = np.fromiter(map(bytes.isalpha, some), bool, len(some))
        other = np.flatnonzero(~letters)
        letters[other] = self._letters_only([some[k] for k in other])
        parts = [b"", *self._from(self.pieces, list(compress(some, letters)), self._letters)]
        # The places of the cores that are letters, then of the marks behind them, then of all other words.
        at = np.cumsum(letters)[cores.indices.to_numpy()]
        is_plain, places = letters[cores.indices.to_numpy()], np.zeros((len(words), 2), np.int64)
        where = np.flatnonzero(plain)
        plain[where[~is_plain]] = False
        places[where[is_plain], 0] = at[is_plain]
        places[where[is_plain], 1] = len(parts) + tails.indices.to_numpy()[is_plain]
        parts += self._from(self.pieces, byte_strings(tails.dictionary), self._apart)
        odd = np.flatnonzero(~plain)
        places[odd, 0] = len(parts) + np.arange(len(odd))
        parts += self._from(self.known, byte_strings(words.take(pa.array(odd))), self._apart)
        return parts, places

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a binary column without nulls, end to end, and how many each text has."""
        if not self.by_word:
            ids = self._encode([t.decode() for t in texts.to_pylist()])
            return np.concatenate([np.zeros(0, "<u4"), *ids]), np.array([len(x) for x in ids], np.int64)
        # Short words come again most.
        if len(self.known) > CACHED_WORDS:
            self.known = {w: ids for w, ids in self.known.items() if len(w) < 8}
        if len(self.pieces) > CACHED_PIECES:
            self.pieces = {w: ids for w, ids in self.pieces.items() if len(w) < 8}
        if len(self.known) > CACHED_WORDS or len(self.pieces) > CACHED_PIECES:
            self.known, self.pieces = {}, {b"": b""}
        words, sizes = split_words(texts)
        if not len(words):
            return np.zeros(0, "<u4"), np.zeros(len(texts), np.int64)
        codes = words.dictionary_encode()
        parts, places = self._parts(codes.dictionary)
        # Each part's ids stand once in ``flat``; the texts take them from there.
        flat, n = np.frombuffer(b"".join(parts), "<u4"), np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        at = places[codes.indices.to_numpy()].reshape(-1)
        lengths = n[at]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        values = flat[np.repeat((np.cumsum(n) - n)[at] - ends[:-1], lengths) + np.arange(ends[-1])]
        return values, np.diff(ends[2 * np.concatenate([[0], np.cumsum(sizes)])])

    def __call__(self, batch: list[str] | list[bytes]) -> list[bytes]:
        """Ids of each text, given as such or as UTF-8."""
        values, n = self.column(pa.array([t.encode() if isinstance(t, str) else t for t in batch], pa.binary()))
        raw, ends = values.tobytes(), 4 * np.cumsum(n)
        return [raw[a:b] for a, b in zip((ends - 4 * n).tolist(), ends.tolist(), strict=True)]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker."""
    return WordEncoder(path)


def write(docs: DataFrame, path: str, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> None:
    """Encode ``docs`` and write the ORC files below ``path`` in ascending order of ids."""
    rows = docs.select(F.col(f"`{id_col}`").try_cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # Equal ids are ordered by a hash of the text, never by the text itself.
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = 0
        for b in gathered(batches, BATCH_BYTES):
            values, n = encoder(tokenizer_path).column(b["text"].cast(pa.binary()).fill_null(b""))
            # Each text's end id goes behind its own.
            values = np.insert(values, np.cumsum(n), end_id).astype(np.int32)
            n = n + 1
            ends = np.cumsum(n)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values))
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(start + ends - n), pa.array(n), lists], names=["doc_id", "file_start", "n_tokens", "ids"])
            start += int(n.sum())

    encoded = ordered.mapInArrow(encode, "doc_id long, file_start long, n_tokens long, ids array<int>")
    (
        encoded.write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", str(INDEX_STRIDE))
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .option("compression", "zstd")
        .orc(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, file_start, n_tokens, ids`` of the files."""
    return spark.read.schema("doc_id long, file_start long, n_tokens long, ids array<int>").orc(path)


def spans(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with ``start``, the ids of all documents before; each file's own rows hold the rest.

    Parts are ordered by the numbers in their names; one row a part is summed up.
    """
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    rows = read(spark, path).withColumn("part", number)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Written first, so that the planner knows its size before it chooses the join.
    base = written(parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "token-parts")
    return rows.join(base, "part").withColumn("start", F.col("base") + F.col("file_start"))


def digests(rows: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of ``spans``."""

    def crc(b: pa.RecordBatch) -> pa.RecordBatch:
        lists = b["ids"]
        values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        at = lists.offsets.to_numpy()
        sums = [zlib.crc32(values[x:y].tobytes()) for x, y in zip(at[:-1], at[1:], strict=True)]
        return pa.RecordBatch.from_arrays([b["doc_id"], b["start"], b["n_tokens"], pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_rows(rows.select("doc_id", "start", "n_tokens", "ids"), crc, "doc_id long, start long, n_tokens long, ids_crc32 long")
