"""Allow and block rules for URLs, held in a trie over reversed host labels and path segments.

A rule is ``(verdict, "host/path")``. It fits its host and every subdomain of it when the path of the
URL starts with the path of the rule. Of all rules that fit, the one with the most host labels wins,
then the one with the longest path; a rule given twice keeps its last verdict. A URL that no rule fits
gets the default verdict.

Null URLs and URLs without ``://`` have an empty host and an empty path, so no rule fits them. Rows are
judged one by one: repeated rows give repeated rows, an empty table gives an empty result, and columns
of the input other than the id and the URL are not read, whatever their names.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows

#: The trie is sent to every task, so the rule list has a size bound.
MAX_RULES = 1_000_000


class Trie:
    """Rules by reversed host labels, below them by path segments."""

    def __init__(self, rules: list[tuple[str, str]]):
        if len(rules) > MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} rules: judge with several rule lists instead")
        self.root: dict = {}
        for verdict, rule in rules:
            host, slash, rest = rule.partition("/")
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault("hosts", {}).setdefault(label, {})
            node = node.setdefault("path", {})
            # All segments but the last must be equal; the last one is a prefix of the URL's.
            *whole, last = (slash + rest).split("/")
            for segment in whole:
                node = node.setdefault("segments", {}).setdefault(segment, {})
            node.setdefault("prefixes", {})[last] = (rule, verdict)

    @staticmethod
    def _in_path(node: dict | None, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for segment in segments:
            if node is None:
                break
            fitting = [p for p in node.get("prefixes", ()) if segment.startswith(p)]
            if fitting:
                best = node["prefixes"][max(fitting, key=len)]
            node = node.get("segments", {}).get(segment)
        return best

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """The rule that wins and its verdict."""
        segments, node, best = path.split("/"), self.root, None
        for label in reversed(host.split(".")):
            node = node.get("hosts", {}).get(label)
            if node is None:
                break
            best = self._in_path(node.get("path"), segments) or best
        return best


def judge(pages: DataFrame, rules: list[tuple[str, str]], *, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``id_col, host, path, rule, verdict`` for every row of ``pages``."""
    spark = pages.sparkSession
    trie = spark.sparkContext.broadcast(Trie(rules))
    url = F.col(url_col)
    after = F.when(url.contains("://"), F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise(F.lit(""))
    split = pages.select(F.col(id_col).alias("id"), F.coalesce(after, F.lit("")).alias("after")).select(
        "id",
        F.translate(F.regexp_extract("after", r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"),
        F.regexp_extract(F.regexp_replace("after", r"^[^/?#]*", ""), r"^[^?#]*", 0).alias("path"),
    )

    def verdicts(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [trie.value.find(h, p) for h, p in zip(b["host"].to_pylist(), b["path"].to_pylist(), strict=True)]
        rule = pa.array([f and f[0] for f in found], pa.string())
        verdict = pa.array([f[1] if f else default for f in found], pa.string())
        return pa.RecordBatch.from_arrays([b["id"], b["host"], b["path"], rule, verdict], names=["id", "host", "path", "rule", "verdict"])

    kind = dict(split.dtypes)["id"]
    out = map_rows(split, verdicts, f"id {kind}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("id", id_col)
