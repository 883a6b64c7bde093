"""Every stage against what it should do with its own input."""

import os
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from test_queries import SF, fingerprint, words
from tidemark.llm import quality_fm
from tidemark.llm.common import table, written

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        out[name] = docs = written(stage(spark, docs, SF), f"test-{name}")
    return {k: v.collect() for k, v in out.items()}


def rows_of(rows):
    return Counter(tuple(r) for r in rows)


def test_quality_keeps_what_the_classifier_accepts(spark, stages):
    docs = table(spark, SF, "documents")
    model = quality_fm.train(docs, table(spark, SF, "labels"))
    wanted = [r for r in stages["documents"] if model.score(*quality_fm.features(r["text"] or "", r["n_chars"])) >= 0.7]
    assert rows_of(stages["quality"]) == rows_of(wanted) and len(wanted) < len(stages["documents"])


def test_one_of_each_group_stays(stages):
    fps = {r["doc_id"]: fingerprint(r["text"] or "") for r in stages["quality"]}
    root = {i: i for i in fps}
    for a in fps:
        for b in fps:
            if root[a] != root[b] and (fps[a] ^ fps[b]).bit_count() <= 3:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    assert sorted(r["doc_id"] for r in stages["near_duplicates"]) == sorted(set(root.values()))


def test_leaks_go(spark, stages):
    items = [" ".join(re.findall(r"\w+", r["text"].lower())) for r in table(spark, SF, "benchmark").collect()]

    def leaks(r):
        text = " ".join(re.findall(r"\w+", (r["text"] or "").lower()))
        return any(i in text for i in items)

    assert rows_of(stages["decontamination"]) == rows_of([r for r in stages["near_duplicates"] if not leaks(r)])


def test_mix_is_near_its_targets(stages):
    size, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in stages["decontamination"]:
        n = len(words(r["text"] or ""))
        size[r["source"]] += n
        longest[r["source"]] = max(longest[r["source"]], n)
    for r in stages["mixing"]:
        taken[r["source"]] += len(words(r["text"] or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(size))}
    target, free, left = {}, set(size), sum(size.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > 3 * size[s]} or free
        for s in full:
            target[s] = min(3 * size[s], weight[s] * level)
        left -= sum(target[s] for s in full)
        free = free - full
    for s in size:
        assert abs(taken[s] - target[s]) <= longest[s]
    repeats = Counter(r["doc_id"] for r in stages["mixing"])
    assert max(repeats.values()) <= 3 and set(repeats) <= {r["doc_id"] for r in stages["decontamination"]}


def test_tokens_of_the_whole_mix(stages):
    rows = sorted(stages["token_ids"], key=lambda r: r["start"])
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in stages["mixing"])
    assert [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in rows)
    start = 0
    for r in rows:
        assert r["start"] == start
        start += r["n_tokens"]
