"""Fill-in-middle transformation with an indexable skip list over the lines of a text.

A text is cut into units (lines that keep their line feed). Lane 0 of the skip list has one node a unit, a
node stays on the next lane with probability 1/4, and every node knows how many units, code points and bytes
lie between it and the next node of its lane. A descent from the top lane adds up those widths and reaches any rank
exactly, so both cuts come out as code points (reported) and as bytes (used to cut) without counting
from the start of the text. Where nodes stand depends on their number alone, so reruns agree.

``transform`` draws from a hash of seed and id: where to cut, whether to transform at all and in which order. The
parts are put together as prefix, suffix, middle (``psm``) or suffix, prefix, middle (``spm``); ``restore``
takes an output apart again. A text that holds a marker, and an empty one, stays ``plain``.

A null text is an empty one. A null id draws as the empty string. Repeated rows give equal results, rows of one id
draw alike. An empty table gives no rows. Only id and text are read, so other columns may have any name and are
not returned. Texts are handled as UTF-8 bytes, one at a time, at whole length.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: One node in this many stays on the next lane.
EXPRESS = 4
SCHEMA = "id long, n long, form string, prefix_chars long, middle_chars long, output binary"


@lru_cache(maxsize=4)
def _heights(size: int) -> np.ndarray:
    """Number of express lanes above each node; node 0 is the head and stands on all of them."""
    z = np.arange(size, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    out, every = np.zeros(size, np.int8), np.uint64(EXPRESS)
    while size and (z % every == 0).any() and every < 1 << 40:
        out += z % every == 0
        every *= np.uint64(EXPRESS)
    out[:1] = 127
    return out


class SkipList:
    """Units in order; ``reach`` finds what lies before a rank."""

    def __init__(self, *widths: np.ndarray):
        """``widths``: any number of arrays with one width for each unit, such as code points and bytes."""
        n = len(widths[0])
        # The next power of two, so that texts of similar length share one array of heights.
        heights = _heights(1 << max(n - 1, 0).bit_length())[:n]
        lane = np.stack([np.ones(n, np.int64), *[np.asarray(w, np.int64) for w in widths]])
        self.lanes, self.down = [lane], [np.arange(n)]
        while lane.shape[1] > EXPRESS:
            stay = np.flatnonzero(heights >= len(self.lanes))
            if len(stay) == lane.shape[1]:
                break
            lane = np.add.reduceat(lane, stay, axis=1)
            self.lanes.append(lane)
            self.down.append(stay)
            heights = heights[stay]

    def reach(self, rank: int) -> tuple[int, ...]:
        """Units and widths before unit ``rank``; beyond the end, those of the whole list."""
        done, at = np.zeros(len(self.lanes[0]), np.int64), 0
        for lane, down in zip(self.lanes[::-1], self.down[::-1], strict=True):
            while at < lane.shape[1] and done[0] + lane[0, at] <= rank:
                done = done + lane[:, at]
                at += 1
            if at == lane.shape[1]:
                break
            at = int(down[at])
        return tuple(done.tolist())


def lines(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Code points and bytes of each line of ``text``; a line keeps its line feed, the last may have none."""
    raw = np.frombuffer(text, np.uint8)
    starts = np.concatenate([[0], np.flatnonzero(raw == 10) + 1])
    starts = starts[starts < len(raw)]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.add.reduceat((raw & 0xC0) != 0x80, starts, dtype=np.int64)
    return points, np.diff(starts, append=len(raw))


def arrange(text: bytes, draws: tuple[int, int, int, int], rate: int, spm_rate: int) -> tuple[int, str, int | None, int | None, bytes]:
    """Number of lines, form, code points of prefix and middle, and the output."""
    points, sizes = lines(text)
    n = len(points)
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    if not text or p in text or s in text or m in text or draws[2] % 100 >= rate:
        return n, "plain", None, None, text
    units = SkipList(points, sizes)
    low, high = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    _, before, a = units.reach(low)
    _, until, b = units.reach(high)
    if draws[3] % 100 < spm_rate:
        return n, "spm", before, until - before, b"".join((s, text[b:], p, text[:a], m, text[a:b]))
    return n, "psm", before, until - before, b"".join((p, text[:a], s, text[b:], m, text[a:b]))


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the sha256 of seed and id."""
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(hexed, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, *, seed: int = 7, rate: int = 100, spm_rate: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n, form, prefix_chars, middle_chars, output`` of every row; ``rate`` and ``spm_rate`` in per cent."""
    doc_id = F.col(f"`{id_col}`")
    rows = docs.select(
        doc_id.cast("long").alias("id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("text"),
        *[h.alias(f"h{k}") for k, h in enumerate(draws(doc_id, seed))],
    )

    def cut(b: pa.RecordBatch) -> pa.RecordBatch:
        drawn = zip(*(b[f"h{k}"].to_pylist() for k in range(4)), strict=True)
        out = [arrange(t.as_py(), d, rate, spm_rate) for t, d in zip(b["text"], drawn, strict=True)]
        n, form, prefix, middle, output = zip(*out, strict=True) if out else ([],) * 5
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
        columns = [pa.array(v, k) for v, k in zip((n, form, prefix, middle, output), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([b["id"], *columns], names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return map_rows(rows, cut, SCHEMA).withColumn("output", F.col("output").cast("string"))


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of."""

    def between(start: str, end: str) -> Column:
        return F.substring_index(F.substring_index(output, end, 1), start, -1)

    middle = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
