"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Every pair of features interacts through vectors of ``RANK`` numbers, and the identity
``sum of pairs = (square of the sum - sum of squares) / 2`` makes the score linear in the features.
It is fitted on at most ``SAMPLE`` labelled documents, chosen by a hash of their ids; all documents
are scored, whole.

Null and empty texts have structure features only and get a score like any other. Documents with several
labels take their mean; labels that are null, or whose id is, teach nothing. Without labels every score
is 0.5. Null metadata are a value of their own. Repeated rows get equal scores; an empty table gives an
empty result. Columns that the operator adds start with ``_fm_``.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_rows, texts

SAMPLE, RANK, BUCKETS, EPOCHS = 8000, 8, 2048, 12
STRUCTURE = [
    "length", "word_length", "upper", "digit", "mark", "symbol", "bars", "exclamation", "non_ascii", "lines", "line_length",
    "distinct", "neighbours", "top_word", "symbol_ends", "upper_words", "lone_marks", "bias",
]
#: Logarithms of the length in characters, in steps; the last one is for null.
METADATA = 26
SIZE = BUCKETS + len(STRUCTURE) + METADATA
_UPPER, _DIGIT, _MARK, _SYMBOL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:!?'\"-", b"#*$%&|<>"


def _share(raw: bytes, characters: bytes) -> float:
    return (len(raw) - len(raw.translate(None, characters))) / max(len(raw), 1)


def features(text: str, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and values of a document's features that are not zero."""
    raw = text.encode()
    words = raw.split()
    n = max(len(words), 1)
    counts = Counter(words)
    lines = raw.count(b"\n") + 1
    stats = [
        np.log1p(len(raw)) / 15, min(len(raw) / n / 20, 2.0), _share(raw, _UPPER), _share(raw, _DIGIT), 4 * _share(raw, _MARK), 4 * _share(raw, _SYMBOL),
        4 * _share(raw, b"|"), 4 * _share(raw, b"!"), 1 - len(text) / max(len(raw), 1), min(10 * lines / n, 1.0), min(len(raw) / lines / 2000, 1.0),
        len(counts) / n, sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, max(counts.values(), default=0) / n,
        sum(c for w, c in counts.items() if w[-1] in _SYMBOL) / n, sum(c for w, c in counts.items() if len(w) > 1 and w.isupper()) / n,
        sum(c for w, c in counts.items() if not w.translate(None, _MARK + _SYMBOL)) / n, 1.0,
    ]
    buckets = np.bincount([zlib.crc32(w.lower()) % BUCKETS for w in counts], weights=list(counts.values()), minlength=BUCKETS) if counts else np.zeros(BUCKETS)
    at = np.flatnonzero(buckets)
    hashed = np.sqrt(buckets[at] / n)
    meta = METADATA - 1 if n_chars is None else min(int(np.log2(max(n_chars, 0) + 1)), METADATA - 2)
    index = np.concatenate([at, BUCKETS + np.arange(len(STRUCTURE)), [BUCKETS + len(STRUCTURE) + meta]])
    return index.astype(np.int32), np.concatenate([hashed, stats, [0.3]]).astype(np.float32)


class FactorisationMachine:
    """``bias + w x + pairwise interactions``, fitted by Adam on the logistic loss."""

    def __init__(self, size: int = SIZE, rank: int = RANK, seed: int = 1):
        self.rng = np.random.default_rng(seed)
        self.learnt = False
        self.params = {"b": np.zeros(1, np.float32), "w": np.zeros(size, np.float32), "v": self.rng.normal(0, 0.05, (size, rank)).astype(np.float32)}

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = 128, rate: float = 0.02, decay: float = 2e-4) -> FactorisationMachine:
        moments = {k: (np.zeros_like(p), np.zeros_like(p)) for k, p in self.params.items()}
        step, self.learnt = 0, True
        for _ in range(epochs):
            order = self.rng.permutation(len(y))
            for at in range(0, len(y), batch):
                some = order[at : at + batch]
                xs, v = x[some], self.params["v"]
                sums = xs @ v
                error = (self._logistic(self._raw(xs, sums)) - y[some]) / len(some)
                weighed = xs * error[:, None]
                slopes = {
                    "b": error.sum(keepdims=True),
                    "w": weighed.sum(axis=0) + decay * self.params["w"],
                    "v": weighed.T @ sums - v * (weighed * xs).sum(axis=0)[:, None] + decay * v,
                }
                step += 1
                for k, g in slopes.items():
                    m, s = moments[k]
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    self.params[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def empty(self) -> FactorisationMachine:
        """The machine that gives 0.5 to everything."""
        self.params["v"][:] = 0
        return self

    @staticmethod
    def _logistic(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def _raw(self, xs: np.ndarray, sums: np.ndarray) -> np.ndarray:
        squares = (xs * xs) @ (self.params["v"] ** 2)
        return self.params["b"][0] + xs @ self.params["w"] + 0.5 * (sums * sums - squares).sum(axis=1)

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        """Probability of label 1 from the features that are not zero."""
        v = self.params["v"][index]
        sums = value @ v
        pairs = 0.5 * float((sums * sums - (value * value) @ (v * v)).sum())
        return float(self._logistic(np.float64(self.params["b"][0] + value @ self.params["w"][index] + pairs)))


def held_out(doc_id: str = "doc_id"):
    """Documents that teach nothing: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", meta_col: str = "n_chars", label_col: str = "quality", sample: int = SAMPLE) -> FactorisationMachine:
    """Fit on at most ``sample`` labelled documents that aren't held out."""
    taught = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")).dropna().groupBy("id").agg(F.avg("y").alias("y"))
    ids = docs.select(F.col(id_col).alias("id")).where(~held_out("id")).join(taught, "id").distinct()
    # At most ``sample`` rows of two numbers, so they can be sent to every task.
    chosen = F.broadcast(ids.orderBy(F.xxhash64("id"), "id").limit(sample))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(meta_col).cast("long").alias("meta")).join(chosen, "id")

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [features(t, m) for t, m in zip(texts(b["text"]), b["meta"].to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays([b["id"], b["y"], pa.array([i.tobytes() for i, _ in found], pa.binary()), pa.array([v.tobytes() for _, v in found], pa.binary())], names=["id", "y", "i", "v"])

    kind = dict(rows.dtypes)["id"]
    # Repeated ids could bring more rows than ids.
    got = map_rows(rows, run, f"id {kind}, y double, i binary, v binary").orderBy(F.xxhash64("id"), F.xxhash64("i", "v")).limit(sample).collect()
    if not got:
        return FactorisationMachine().empty()
    x, y = np.zeros((len(got), SIZE), np.float32), np.array([r["y"] for r in got], np.float32)
    for k, r in enumerate(got):
        x[k, np.frombuffer(r["i"], np.int32)] = np.frombuffer(r["v"], np.float32)
    return FactorisationMachine().fit(x, y)


def score(docs: DataFrame, model: FactorisationMachine, *, keep: list[str] | None = None, text_col: str = "text", meta_col: str = "n_chars") -> DataFrame:
    """Columns ``keep`` (all by default) and ``_fm_score`` for every row."""
    keep = docs.columns if keep is None else keep
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*[docs[f"`{c}`"] for c in keep], F.col(text_col).cast("string").alias("_fm_text"), F.col(meta_col).cast("long").alias("_fm_meta"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        scores = [sent.value.score(*features(t, m)) for t, m in zip(texts(b["_fm_text"]), b["_fm_meta"].to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays([*(b[c] for c in keep), pa.array(scores, pa.float64())], names=[*keep, "_fm_score"])

    return map_rows(rows, run, T.StructType([*(rows.schema[c] for c in keep), T.StructField("_fm_score", T.DoubleType())]))
