"""SimHash near-duplicates with covering locality-sensitive hashing.

A fingerprint has a bit for each of 64 positions, set where over half of the hashes of a document's
word shingles have it set. Fingerprints within ``radius`` differing bits are linked, and ``component_id``
is the smallest document id that can be reached over links.

The tables cover the radius: every bit position gets a vector of ``radius + 1`` bits, and the mask of a
table ``v`` keeps the positions whose vector has an odd product with ``v``. Whatever ``radius`` positions
differ, some ``v`` is orthogonal to all their vectors, so that table's mask hides every difference and
the pair meets in one bucket. A bucket with over ``BUCKET`` fingerprints is dealt out again by masks of
another draw, inside the bucket; no pair is lost, and every level fixes further bits. Inside a bucket
only links that join two parts are written, so their number is below that of the fingerprints.

Equal fingerprints are merged before all that. Null and empty texts have the fingerprint zero and link
like any other. Null ids never name a component unless it has no other id. Repeated rows give repeated
rows, an empty table an empty result; columns other than id and text are not read, and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_rows, texts, written

SHINGLE, RADIUS = 3, 3
#: Fingerprints of one bucket that a task compares; fuller buckets are dealt out again.
BUCKET = 2048
#: A fingerprint that at least one in so many rows has is joined by broadcast.
HOT = 1000
#: Deals at most. Each fixes about half of the bits left, so the last ones hold a few fingerprints.
LEVELS = 5
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    grams = zip(*(words[k:] for k in range(shingle)), strict=False)
    total = np.zeros(64, np.int64)
    n = len(words) - shingle + 1
    hashes = np.fromiter((digest(join(g), 42) for g in grams), dtype="<u8", count=n)
    for at in range(0, n, 50_000):
        bits = np.unpackbits(hashes[at : at + 50_000].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > n, bitorder="little").view("<u8")[0])


def masks(radius: int, level: int = 0) -> np.ndarray:
    """``2 ** (radius + 1) - 1`` masks of 64 bits that cover the radius."""
    vectors = np.random.default_rng(1000 + level).integers(1, 2 ** (radius + 1), 64)
    out = []
    for v in range(1, 2 ** (radius + 1)):
        keep = [bin(int(m) & v).count("1") % 2 for m in vectors]
        out.append(sum(1 << i for i, bit in enumerate(keep) if bit))
    return np.array(out, np.uint64)


def fingerprints(docs: DataFrame, *, text_col: str = "text", shingle: int = SHINGLE, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and ``_sh_fp``, the fingerprint as a signed integer."""
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).cast("string").alias("_sh_text"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, shingle) for t in texts(b["_sh_text"])], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*(b[c] for c in keep), pa.array(fps)], names=[*keep, "_sh_fp"])

    return map_rows(rows, run, T.StructType([*(rows.schema[c] for c in keep), T.StructField("_sh_fp", T.LongType())]))


def joined(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join the fingerprints of a bucket as all links within the radius would."""
    left, links = fps.astype(np.int64).view(np.uint64), []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            grown = []
            for f in front:
                near = np.bitwise_count(left ^ f) <= radius
                if near.any():
                    links.extend((int(np.int64(f.view(np.int64))), int(x)) for x in left[near].view(np.int64))
                    grown.append(left[near])
                    left = left[~near]
                if not len(left):
                    break
            front = np.concatenate(grown) if grown else front[:0]
    return links


def _dealt(rows: DataFrame, level: int, radius: int) -> DataFrame:
    """``path, key, fp``: every fingerprint in each bucket it falls into; ``path`` names tables and bits so far."""
    cover = masks(radius, level).view(np.int64).tolist()
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("v"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(cover)]))
    cells = rows.select("path", "fp", pairs.alias("cell"))
    return cells.select(F.xxhash64("path", "cell.v", "cell.key").alias("path"), "fp")


def links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: links between the distinct fingerprints in ``fp`` that give the components of all links."""
    rows = fps.select(F.lit(0).cast("long").alias("path"), "fp")
    found: list[DataFrame] = []
    for level in range(LEVELS):
        last = level == LEVELS - 1

        def run(batches: Iterator[pa.RecordBatch], last: bool = last) -> Iterator[pa.RecordBatch]:
            at, held, over = None, [], False

            def out(path: int, a: list[int], b: list[int | None]) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array([path] * len(a), pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["path", "a", "b"])

            def close() -> Iterator[pa.RecordBatch]:
                if over and held:
                    yield out(at, held, [None] * len(held))
                elif len(held) > 1:
                    pairs = joined(np.array(held, np.int64), radius)
                    if pairs:
                        yield out(at, [x for x, _ in pairs], [y for _, y in pairs])

            for b in batches:
                for path, fp in zip(b["path"].to_pylist(), b["fp"].to_pylist(), strict=True):
                    if path != at:
                        yield from close()
                        at, held, over = path, [], False
                    held.append(fp)
                    if len(held) > bucket and not last:
                        over = True
                        yield out(at, held, [None] * len(held))
                        held = []
                if over and held:
                    yield out(at, held, [None] * len(held))
                    held = []
            yield from close()

        buckets = _dealt(rows, level, radius).repartition("path").sortWithinPartitions("path", "fp")
        result = written(buckets.mapInArrow(run, "path long, a long, b long"), "simhash-links")
        found.append(result.where("b IS NOT NULL").select("a", "b"))
        deep = result.where("b IS NULL").select("path", F.col("a").alias("fp"))
        if last or deep.isEmpty():
            break
        rows = deep
    everything = found[0]
    for more in found[1:]:
        everything = everything.unionByName(more)
    return everything.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``fp, root``: the smallest fingerprint of the component of every linked fingerprint.

    Large-star and small-star rounds: every round joins the neighbours of a node to the smallest of them,
    until nothing changes. A round is written to the shared folder.
    """

    def stars(e: DataFrame, small: bool) -> DataFrame:
        both = e if small else e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # a: the node, b: its neighbour; in a small star only smaller neighbours count.
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined_ = both.join(least, "a")
        if small:
            moved = joined_.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        else:
            moved = joined_.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.where("a != b").distinct()

    # An edge leads from the larger to the smaller node.
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "components")
    mark = F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"))
    seen = now.agg(mark.alias("m")).first()["m"]
    while seen["n"]:
        now = written(stars(stars(now, small=False), small=True), "components")
        new = now.agg(mark.alias("m")).first()["m"]
        if new == seen:
            break
        seen = new
    return now.select(F.col("a").alias("fp"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("fp"), F.col("b").alias("root")).distinct())


def classes(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``_sh_fp, _sh_root`` for every distinct fingerprint of ``marked``; equal roots are one group."""
    distinct = written(marked.select(F.col("_sh_fp").alias("fp")).distinct(), "simhash-distinct")
    roots = components(links(distinct, radius))
    return distinct.join(roots, "fp", "left").select(F.col("fp").alias("_sh_fp"), F.coalesce("root", "fp").alias("_sh_root"))


def by_fingerprint(rows: DataFrame, values: DataFrame, counts: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``values`` (one row a fingerprint), joined on ``_sh_fp``.

    Fingerprints of one in ``HOT`` rows or more are at most ``HOT``: they are broadcast, and only the rows of rarer ones are shuffled.
    """
    total = counts.agg(F.sum("rows")).first()[0] or 0
    hot = written(counts.where(F.col("rows") * HOT >= total).select("_sh_fp"), "simhash-hot")
    common = rows.join(F.broadcast(values.join(F.broadcast(hot), "_sh_fp")), "_sh_fp")
    rare = rows.join(F.broadcast(hot), "_sh_fp", "left_anti").join(values, "_sh_fp")
    return common.unionByName(rare)


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``id, fingerprint (16 hex digits), component_id`` for every document."""
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    marked = written(fingerprints(narrow, shingle=shingle, keep=["id"]), "simhash")
    first = marked.groupBy("_sh_fp").agg(F.min("id").alias("first"), F.count("*").alias("rows")).join(classes(marked, radius), "_sh_fp")
    named = written(first, "simhash-groups")
    smallest = named.groupBy("_sh_root").agg(F.min("first").alias("component_id"))
    values = written(named.select("_sh_fp", "_sh_root").join(smallest, "_sh_root").select("_sh_fp", "component_id"), "simhash-components")
    found = by_fingerprint(marked, values, named)
    return found.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("_sh_fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that have the smallest id of their group, one a group, nulls last. Columns may have any name."""
    names = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    own, text = names[id_col], names[text_col]
    numbered = docs.toDF(*names.values()).withColumn("_sh_row", F.monotonically_increasing_id())
    # Written once: the numbers and fingerprints stay with their rows whatever is run again.
    marked = written(fingerprints(numbered, text_col=text, shingle=shingle, keep=numbered.columns), "simhash-rows")
    least = F.min(F.struct(F.col(own).isNull().alias("none"), F.col(own).alias("id"), F.col("_sh_row").alias("row")))
    # The least row of a fingerprint first, which combines before the shuffle: a hot one is a single row from there on.
    firsts = marked.groupBy("_sh_fp").agg(least.alias("least"))
    groups = firsts.join(classes(marked, radius), "_sh_fp").groupBy("_sh_root").agg(F.min("least").alias("least"))
    kept = groups.select(F.col("least.row").alias("_sh_row"))
    return marked.join(kept, "_sh_row", "left_semi").select(*names.values()).toDF(*names)
