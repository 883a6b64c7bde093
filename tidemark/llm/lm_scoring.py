"""Log-probabilities of whole documents under a unigram and a gated recurrent language model.

Tokens are the words of a text with A-Z in lower case, then one end. Counts are taken over all training
documents. The documents are put into blocks of about ``BLOCK_TOKENS`` tokens, each with its own word
list; only these lists are shuffled by word to get the counts and back by block, so a frequent word
moves once a block and not once a document.

The network knows the ``WORDS`` most frequent tokens; every other one is a step to the group of rare
tokens and then a draw from their counts, so probabilities sum to one over all words. Its output biases
start from the counts of all training documents. A first fit on about ``FIT_TOKENS`` tokens of randomly
chosen whole training documents gives the weights from which it then learns from every training token: the
blocks are dealt into ``ROUNDS``; in each, the tasks go on from the same weights through the blocks of their
partition, and the mean of their weights, by tokens, begins the next. A document's state is carried from
its first token to its end.

Null and empty texts are one end. Null ids are never held out. Repeated rows get equal scores; an empty
table gives an empty result; without training documents every token is unseen. Only id and text are read.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import byte_strings, split_words, written
from tidemark.llm.gru import Gru

BLOCK_TOKENS, WORDS, FIT_TOKENS = 800_000, 1023, 500_000
#: The pass over all training tokens: rounds, streams side by side and step size. Weights are added up in pieces.
ROUNDS, STREAMS, RATE, PIECE = 3, 256, 0.004, 4096
#: No word holds a space.
END = " "
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def tokens(text: str) -> list[bytes]:
    return [*text.encode().translate(_LOWER).split(), END.encode()]


def held_out(doc_id: str = "doc_id"):
    """Documents that teach nothing: crc32 of the id as text leaves 1 when divided by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 1, F.lit(False))


def blocks(docs: DataFrame) -> DataFrame:
    """One row a block of ``id, held_out, text``: ids, places in the word list of all tokens, words and training counts."""
    kind = dict(docs.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, total = TaskContext.get().partitionId(), 0, 0
        ids: list[pa.Array] = []
        held: list[bool] = []
        sizes: list[int] = []
        places: list[np.ndarray] = []
        words: dict[bytes, int] = {}

        def close() -> pa.RecordBatch:
            flat = np.concatenate(places)
            learnt = np.repeat(~np.array(held), sizes)
            counts = np.bincount(flat[learnt], minlength=len(words)).astype("<i8")
            row = {
                "block": pa.array([(part << 24) + n], pa.int64()),
                "ids": pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), pa.concat_arrays(ids)),
                "held": pa.array([held], pa.list_(pa.bool_())),
                "sizes": pa.array([np.array(sizes, "<i8").tobytes()], pa.binary()),
                "places": pa.array([flat.astype("<i4").tobytes()], pa.binary()),
                "words": pa.array([[w.decode() for w in words]], pa.list_(pa.string())),
                "counts": pa.array([counts.tolist()], pa.list_(pa.int64())),
            }
            return pa.RecordBatch.from_arrays(list(row.values()), names=list(row))

        def take(found: pa.Array, counts: np.ndarray) -> None:
            codes = found.dictionary_encode()
            numbers = np.fromiter((words.setdefault(w, len(words)) for w in byte_strings(codes.dictionary)), np.int32, len(codes.dictionary))
            # Each text's end goes behind its words.
            places.append(np.insert(numbers[codes.indices.to_numpy()], np.cumsum(counts), words.setdefault(END.encode(), len(words))).astype(np.int32))
            sizes.extend((counts + 1).tolist())

        for b in batches:
            found, counts = split_words(pc.ascii_lower(b["text"].fill_null("")))
            at, outs, begun = np.concatenate([[0], np.cumsum(counts)]), b["held_out"].to_pylist(), 0
            while begun < len(b):
                # A block ends with the document that fills it.
                ends = total + np.cumsum(counts[begun:] + 1)
                upto = min(begun + int(np.searchsorted(ends, BLOCK_TOKENS)) + 1, len(b))
                take(found.slice(at[begun], at[upto] - at[begun]), counts[begun:upto])
                ids.append(b["id"].slice(begun, upto - begun))
                held.extend(outs[begun:upto])
                total, begun = int(ends[upto - begun - 1]), upto
                if total >= BLOCK_TOKENS:
                    yield close()
                    n, total = n + 1, 0
                    ids, held, sizes, places, words = [], [], [], [], {}
        if held:
            yield close()

    return docs.select("id", "held_out", "text").mapInArrow(run, f"block long, ids array<{kind}>, held array<boolean>, sizes binary, places binary, words array<string>, counts array<long>")


def fit(docs: DataFrame, vocabulary: dict[str, int], counts: np.ndarray, total: int, fit_tokens: int = FIT_TOKENS) -> Gru:
    """The network's first weights, fitted on the driver on about ``fit_tokens`` tokens."""
    model = Gru(counts)
    if total:
        share = min(1.0, fit_tokens / total)
        some = docs.where(~F.col("held_out")).where(F.rand(11) < share).select("text").collect()
        rare, end = len(counts) - 1, vocabulary.get(END, len(counts) - 1)
        stream = [end]
        for r in some:
            stream += [vocabulary.get(w.decode(), rare) for w in tokens(r["text"] or "")]
        model.fit(np.array(stream, np.int64))
    return model


def learnt(made: DataFrame, model: Gru, vocabulary: dict[str, int], rounds: int = ROUNDS) -> Gru:
    """The network after it has learnt from the training tokens of all blocks, each once."""
    rare, end = model.size - 1, vocabulary.get(END, model.size - 1)
    for r in range(rounds):
        sent = made.sparkSession.sparkContext.broadcast((model, vocabulary))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            begun, ids_of = sent.value
            net = copy.copy(begun)
            net.p = {k: v.copy() for k, v in begun.p.items()}
            rest, n = np.array([end], np.int64), 0
            for b in batches:
                for k in range(len(b)):
                    ranks = np.array([ids_of.get(w, rare) for w in byte_strings(b["words"][k].values)], np.int64)
                    places, sizes = np.frombuffer(b["places"][k].as_py(), "<i4"), np.frombuffer(b["sizes"][k].as_py(), "<i8")
                    own = ranks[places[np.repeat(~np.array(b["held"][k].as_py(), bool), sizes)]]
                    flow = np.concatenate([rest, own])
                    n += len(own)
                    net.fit(flow, streams=STREAMS, epochs=1, rate=RATE)
                    # What doesn't fill all streams goes on to the next block.
                    rest = flow[(len(flow) - 1) // STREAMS * STREAMS :]
            if n:
                net.fit(rest, streams=1, epochs=1, rate=RATE)
                flat = np.concatenate([v.reshape(-1) for v in net.p.values()]).astype("<f4")
                pieces = [flat[at : at + PIECE].tobytes() for at in range(0, len(flat), PIECE)]
                columns = [pa.array(range(len(pieces)), pa.int32()), pa.array([n] * len(pieces), pa.int64()), pa.array(pieces, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["piece", "n", "weights"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, tuple[int, np.ndarray]] = {}
            for b in batches:
                for k, n, w in zip(*(b[c].to_pylist() for c in ("piece", "n", "weights")), strict=True):
                    before = sums.get(k, (0, 0.0))
                    sums[k] = before[0] + n, before[1] + n * np.frombuffer(w, "<f4").astype(float)
            rows = [(k, n, (w / n).astype("<f4").tobytes()) for k, (n, w) in sums.items()]
            if rows:
                k, n, w = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(n, pa.int64()), pa.array(w, pa.binary())], names=["piece", "n", "weights"])

        kinds = "piece int, n long, weights binary"
        taken = made.where(F.pmod(F.xxhash64("block"), F.lit(rounds)) == r).select("held", "sizes", "places", "words").mapInArrow(run, kinds)
        # As many rows as the weights have pieces, however many tasks there were.
        got = {x["piece"]: x["weights"] for x in taken.repartition("piece").mapInArrow(add, kinds).collect()}
        if got:
            flat, at, model = np.frombuffer(b"".join(got[k] for k in sorted(got)), "<f4"), 0, copy.copy(model)
            means = {}
            for key, v in model.p.items():
                means[key] = flat[at : at + v.size].reshape(v.shape).astype(np.float32)
                at += v.size
            model.p = means
    return model


def score(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every document."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("held_out", held_out("id"))
    made = written(blocks(rows), "lm-blocks", "zstd")
    listed = made.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w")).select("block", "place", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    same = Window.partitionBy("word")
    # Every block lists a word once, so one row of each word is in its smallest block.
    counted = listed.select("block", "place", "word", F.sum("n").over(same).alias("c"), (F.min("block").over(same) == F.col("block")).alias("first"))
    known = written(counted.select("block", "place", "c", F.when(F.col("first"), F.col("word")).alias("word")), "lm-counts", "zstd")
    once = known.where("word IS NOT NULL AND c > 0")
    sums = once.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, distinct = int(sums["n"]), int(sums["v"])
    # At most WORDS rows.
    top = [(r["word"], int(r["c"])) for r in once.orderBy(F.desc("c"), "word").limit(WORDS).select("word", "c").collect()]
    vocabulary = {w: i for i, (w, _) in enumerate(top)}
    rare_total, rare_distinct = total - sum(c for _, c in top), distinct - len(top)
    model = fit(rows, vocabulary, np.array([*(c for _, c in top), rare_total], float), total)
    model = learnt(made, model, vocabulary)
    sent = spark.sparkContext.broadcast((model, vocabulary, total, distinct, rare_total, rare_distinct))
    counts = known.select("block", "place", "c")
    kind = dict(rows.dtypes)["id"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        net, ids_of, n, v, rare_n, rare_v = sent.value
        out = []
        for k, row in enumerate(left.drop_columns(["words"]).to_pylist()):
            words = byte_strings(left["words"][k].values)
            c = np.zeros(len(words))
            c[right["place"].to_numpy()] = right["c"].to_numpy()
            ranks_ = np.array([ids_of.get(w, net.size - 1) for w in words], np.int64)
            places, sizes = np.frombuffer(row["places"], "<i4"), np.frombuffer(row["sizes"], "<i8")
            base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
            rare = np.where(ranks_ == net.size - 1, np.log10((c + 0.5) / (rare_n + 0.5 * (rare_v + 1))), 0.0)
            logs = net.sequences(ranks_[places], sizes, ids_of.get(END, net.size - 1)) / np.log(10) + rare[places]
            begins = np.cumsum(sizes) - sizes
            sums_ = [np.add.reduceat(x, begins) for x in (base[places], logs, (c > 0)[places].astype(np.int64))]
            out.append((row["ids"], row["held"], sizes, *sums_))
        ids, held, sizes, base, logs, seen = ([x for o in out for x in o[k]] for k in range(6))
        return pa.table({
            "id": pa.array(ids, left.schema.field("ids").type.value_type), "held_out": pa.array(held, pa.bool_()), "n_tokens": pa.array(sizes, pa.int64()), "n_known": pa.array(seen, pa.int64()),
            "train_tokens": pa.array([n] * len(ids), pa.int64()), "base_score": pa.array(base, pa.float64()), "score": pa.array(logs, pa.float64()),
        })

    scored = made.drop("counts").groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(
        run, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return scored.withColumnRenamed("id", id_col)
