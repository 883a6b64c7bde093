"""The methods of the operators on small inputs with known answers."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from test_queries import strict_spans
from tidemark.llm import decontamination, html_wrapper, lm_scoring, mixing, pii, quality_fm, quality_rules, simhash, tokens, url_filter
from tidemark.llm.gru import Gru


settings.register_profile("slow machine", deadline=None)
settings.load_profile("slow machine")


# --- mixing


def test_targets_are_filled_by_weight_up_to_the_caps(spark):
    sizes = {"a": 10, "b": 1000, "c": 500, "d": 20, None: 300}
    rows = spark.createDataFrame(list(sizes.items()), "_mix_source string, _mix_source_size long")
    got = {r["_mix_source"]: r["_mix_target"] for r in mixing.targets(rows).collect()}
    weight = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2], strict=True))
    wanted, free, left = {}, set(sizes), sum(sizes.values())
    while True:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not full:
            break
        for s in full:
            wanted[s] = 3 * sizes[s]
            left -= wanted[s]
        free -= full
    wanted |= {s: weight[s] * level for s in free}
    assert got == pytest.approx(wanted)


def test_due_inverts_the_integral(spark):
    for knots in [*mixing.SCHEDULES, [(0.0, 0.0), (0.25, 4.0), (1.0, 1.0)]]:
        shares = [k / 20 for k in range(21)]
        got = spark.createDataFrame([(s,) for s in shares], "s double").select("s", mixing.due(knots, mixing.F.col("s")).alias("t")).collect()
        for r in got:
            area = 0.0
            for (a, x), (b, y) in zip(knots, knots[1:], strict=False):
                e = min(b, r["t"])
                if e > a:
                    at = x + (y - x) * (e - a) / (b - a)
                    area += (e - a) * (x + at) / 2
            assert area / mixing.total(knots) == pytest.approx(r["s"], abs=1e-9)


def test_copies_follow_one_line_of_words(spark):
    docs = spark.createDataFrame([(i, "x" if i % 3 else "y", 10 + i) for i in range(300)] + [(7, "x", 17), (None, None, 5), (None, None, 5), (9, "z", 0)], "doc_id long, source string, size int")
    rows = mixing.assign(docs).select("source", "size", "_mix.*").collect()
    assert len(rows) == 304
    for source in ("x", "y", None, "z"):
        own = [r for r in rows if r["source"] == source]
        assert sum(r["taken"] for r in own) == math.floor(own[0]["target"])
        for r in own:
            assert r["taken"] == sum(c["words"] for c in r["copies"]) and all(0 <= c["position"] <= 1 for c in r["copies"])


# --- personal data


@given(st.text(alphabet="ab1.2@-+ _3(%)45 99.é", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert pii.joined(pii.base_spans(text)) == ",".join(strict_spans(text))


def test_long_runs_take_linear_time():
    for run in ("a" * 200_000, "1" * 200_000, "a@" * 50_000, "1." * 100_000, "+1" * 50_000, "(at)" * 50_000):
        pii.base_spans(run)
    assert len(pii.base_spans("a" * 200_000 + "@b.cd")) == 1


def test_model_adds_what_the_labelers_agree_on(spark):
    filler = "the quick brown fox jumps over the lazy dog "
    texts = [f"{filler}mail me at joe{k}@mail{k % 9}.example.com soon. call +1 (269) 555-{1000 + k} now." for k in range(60)]
    texts += [f"{filler}write to joe{k} [at] example [dot] com please" for k in range(10)]
    texts += [f"{filler}order 41{k:02}1111111111{k:02} shipped" for k in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in pii.find(docs).collect()}
    assert all("email" in rows[i]["spans"] for i in range(70)) and all(rows[i]["base"] == "" for i in range(60, 70))
    assert all(rows[i]["spans"] == rows[i]["base"] for i in range(70, 110))
    assert all(set(filter(None, r["base"].split(","))) <= set(r["spans"].split(",")) for r in rows.values())


def test_reliabilities_separate_good_from_bad_votes():
    rng = random.Random(2)
    counts: dict[str, int] = {}
    for _ in range(4000):
        real = rng.random() < 0.4
        votes = "".join("-" if rng.random() < 0.2 else str(int(real == (rng.random() < p))) for p in (0.95, 0.9, 0.85, 0.6, 0.8))
        p = f"0{votes}00"
        counts[p] = counts.get(p, 0) + 1
    accepted = pii.SpanModel(counts).accepted
    assert "01111100" in accepted and "00000000" not in accepted


# --- quality


def test_pairs_by_the_sum_of_squares():
    machine = quality_fm.FactorisationMachine(size=12, rank=3)
    machine.params["w"] = np.random.default_rng(0).normal(size=12).astype(np.float32)
    index, value = np.array([1, 4, 7, 11]), np.array([0.5, 1.0, -2.0, 0.25], np.float32)
    v, w = machine.params["v"], machine.params["w"]
    pairs = sum(float(v[i] @ v[j]) * float(x * y) for (i, x), (j, y) in itertools.combinations(zip(index, value, strict=True), 2))
    raw = float(machine.params["b"][0]) + float(w[index] @ value) + pairs
    assert machine.score(index, value) == pytest.approx(1 / (1 + math.exp(-raw)), rel=1e-5)


def test_machine_learns_an_interaction():
    rng = np.random.default_rng(3)
    x = (rng.random((4000, 6)) < 0.5).astype(np.float32)
    y = (x[:, 0] != x[:, 1]).astype(np.float32)
    machine = quality_fm.FactorisationMachine(size=6, rank=4).fit(x, y, epochs=30)
    right = [(machine.score(np.flatnonzero(r), r[np.flatnonzero(r)]) > 0.5) == t for r, t in zip(x[:400], y[:400], strict=True)]
    assert np.mean(right) > 0.95


def test_divergence_is_zero_for_equal_and_one_for_disjoint_histograms():
    p = np.array([0.5, 0.5, 0, 0])
    assert quality_rules.distance(p, np.array([p, [0, 0, 0.5, 0.5]])) == pytest.approx([0, 1])


def test_rules_keep_prose_and_reject_other_distributions(spark):
    rng = random.Random(1)
    en, de = "the of and to in a is that it was for on are as with".split(), "der die und in den von zu das mit sich des auf für ist".split()

    def prose(common):
        return " ".join(rng.choice(common) if rng.random() < 0.6 else "".join(rng.choices("abcdefghiklmnoprstu", k=6)) for _ in range(200))

    rows = [(i, prose(en), "en") for i in range(60)] + [(100 + i, prose(de), "de") for i in range(60)]
    rows += [(200, re.sub(r"(\w+)", r"\1###", prose(en)), "en"), (201, prose(en).upper(), "en"), (202, "the of and", "en"), (203, prose(de), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in quality_rules.score(docs).collect()}
    assert all(got[i]["kept"] for i in [*range(60), *range(100, 160), 203])
    assert not any(got[i]["kept"] for i in (200, 201, 202))
    assert got[203]["nearest_lang"] == "de"


@pytest.mark.parametrize("n", [19, 20])
def test_a_small_language_is_not_judged_by_others(spark, n):
    rng = random.Random(2)

    def prose(common, letters):
        return " ".join(rng.choice(common) if rng.random() < 0.6 else "".join(rng.choices(letters, k=6)) for _ in range(200))

    en = "the of and to in a is that it was for on are as with".split()
    el = "και το να η του που την της με για στο από δεν είναι θα".split()
    rows = [(i, prose(en, "abcdefghiklmnoprstu"), "en") for i in range(60)] + [(100 + i, prose(el, "αβγδεζηθικλμνοπρ"), "el") for i in range(n)]
    # No language claimed, or one with a reference: judged as before.
    rows += [(200, prose("### $$$ %%%".split(), "#$%&"), None), (201, prose("### $$$ %%%".split(), "#$%&"), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["kept"] for r in quality_rules.score(docs).collect()}
    assert all(got[i] for i in [*range(60), *range(100, 100 + n)]) and not got[200] and not got[201]


# --- URLs


def test_longest_rule_wins():
    trie = url_filter.Trie([("allow", "com/"), ("block", "a.com/x"), ("allow", "a.com/x/y/"), ("block", "b.a.com/")])
    cases = {
        ("a.com", "/"): "com/", ("a.com", "/xz"): "a.com/x", ("a.com", "/x/y/z"): "a.com/x/y/", ("a.com", "/x/y"): "a.com/x",
        ("c.b.a.com", "/x/y/"): "b.a.com/", ("com", "/"): "com/", ("acom", "/"): None, ("a.com", ""): None, ("", ""): None,
    }
    for (host, path), rule in cases.items():
        found = trie.find(host, path)
        assert (found and found[0]) == rule, (host, path)


# --- token files


@given(st.lists(st.text(max_size=40), max_size=5))
def test_encoder_equals_the_tokenizer(batch):
    import public_tokenizers

    encoder = tokens.encoder(public_tokenizers.path("word_bpe_49k.json"))
    for t, ids in zip(batch, encoder(batch), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids


def test_files_round_trip_and_are_indexed(spark, tmp_path):
    import public_tokenizers
    from pyarrow import orc

    path, name = str(tmp_path / "ids"), public_tokenizers.path("word_bpe_49k.json")
    docs = spark.createDataFrame([(i, f"word{i} <|startoftext|> and <|endoftext|>x " * (i % 5)) for i in range(500)], "doc_id long, text string")
    tokens.write(docs.repartition(7), path, name)
    rows = tokens.spans(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == list(range(500))
    plain, start = tokens.encoder(name).tokenizer, 0
    for r in rows:
        wanted = [*plain.encode(f"word{r['doc_id']} <|startoftext|> and <|endoftext|>x " * (r["doc_id"] % 5), add_special_tokens=False).ids, 1]
        assert r["ids"] == wanted and r["start"] == start
        start += len(wanted)
    assert tokens.read(spark, path).where("doc_id = 123").count() == 1
    plan = tokens.read(spark, path).where("doc_id = 123")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,123)]" in plan
    files = list((tmp_path / "ids").glob("*.orc"))
    assert files and all(orc.ORCFile(str(f)).nstripes >= 1 for f in files if orc.ORCFile(str(f)).nrows)


# --- decontamination


def plain_alignment(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


@given(st.lists(st.integers(0, 4), max_size=15), st.lists(st.integers(0, 4), max_size=25))
def test_alignment_equals_the_plain_one(a, b):
    assert decontamination.align(np.array(a, np.int32), np.array(b, np.int32))[0] == plain_alignment(a, b)


def test_edited_copies_are_found_and_others_left_alone(spark):
    rng = random.Random(4)
    lexicon = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8))) for _ in range(2000)]

    def prose(n):
        return [rng.choice(lexicon) for _ in range(n)]

    items = [prose(rng.randint(14, 60)) for _ in range(40)]
    rows, wanted = [], set()
    for d in range(300):
        text = prose(400)
        if d < 80:
            copy = [rng.choice(lexicon) if rng.random() < (0, 0.05, 0.1, 0.15)[d % 4] else w for w in items[d % 40]]
            if d % 3 == 0:
                del copy[len(copy) // 2]
            at = rng.randint(0, 400)
            text[at:at] = [w.capitalize() + "," for w in copy]
            if plain_alignment(items[d % 40], copy) >= 0.8 * len(items[d % 40]):
                wanted.add((d, d % 40))
        rows.append((d, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(90, None), (91, "too short"), (92, "")], "item_id long, text string")
    for size in (decontamination.BLOCK_GRAMS, 300):
        found = {(r["id"], r["item_id"]) for r in decontamination.matches(docs, bench, block_grams=size).collect()}
        assert found == wanted and len(found) > 70


def test_an_item_copied_into_most_documents_keeps_its_seeds(spark):
    item = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(i, f"start {item} end{i}" if i % 10 else f"plain text {i} of no item at all") for i in range(200)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {r["id"] for r in decontamination.matches(docs, bench).collect()} == {i for i in range(200) if i % 10}


def test_an_edited_hot_group_beside_one_exact_copy_is_found(spark):
    item = [f"w{k}" for k in range(30)]
    edited = [f"x{k}" if k % 5 == 4 else w for k, w in enumerate(item)]
    texts = [f"start{i} {' '.join(edited)} end{i}" for i in range(12)] + [f"start {' '.join(item)} end"]
    # One seed far from the copy, which shares frequent n-grams only.
    texts += [f"{' '.join(edited)} {' '.join(f'p{k}' for k in range(200))} {' '.join(item[3:6])} q"]
    texts += [f"plain text {i} with {' '.join(item[:3])} and no more of the item, which is longer by far than that" for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert {r["id"] for r in decontamination.matches(docs, bench).collect()} == set(range(14))


def test_a_copy_without_seeds_and_with_many_insertions_is_found(spark):
    item = [f"w{k}" for k in range(30)]
    # Two words go in after every second one; only the item's end is left in one piece.
    edited = [x for k, w in enumerate(item) for x in ([w, f"x{k}", f"y{k}"] if k % 2 and k < 26 else [w])]
    texts = [f"start{i} {' '.join(edited)} end{i}" for i in range(60)] + [f"start {' '.join(item)} end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    score = plain_alignment(item, edited) / (2 * len(item))
    got = {r["id"]: r["score"] for r in decontamination.matches(docs, bench).collect()}
    assert score >= decontamination.MIN_SCORE and got == {**{i: pytest.approx(score) for i in range(60)}, 60: 1.0}


# --- language model


def small_gru():
    return Gru(np.array([30, 20, 12, 9, 5, 4, 2, 1.0]), hidden=5, width=3)


def test_probabilities_sum_to_one():
    net = small_gru()
    states = np.random.default_rng(0).normal(size=(4, 5)).astype(np.float32)
    total = sum(np.exp(net.log_probabilities(states, np.full(4, i))) for i in range(8))
    assert total == pytest.approx(np.ones(4), abs=1e-5)


def test_slopes_equal_differences():
    net = small_gru()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(1)
    x, y, h = rng.integers(0, 8, (3, 4)), rng.integers(0, 8, (3, 4)), rng.normal(size=(3, 5)) * 0.3
    slopes = net.slopes(x, y, h)[0]
    for key, places in {"x": 6, "u": 6, "b": 6, "c": 6, "cb": 3, "w": 6, "wb": 3}.items():
        flat = net.p[key].reshape(-1)
        for i in rng.choice(len(flat), places, replace=False):
            if flat[i] < -1e8:
                continue
            kept = flat[i]
            flat[i] = kept + 1e-5
            up = net.slopes(x, y, h)[2]
            flat[i] = kept - 1e-5
            down = net.slopes(x, y, h)[2]
            flat[i] = kept
            assert slopes[key].reshape(-1)[i] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_loss_comes_from_the_pass_that_makes_the_slopes(monkeypatch):
    net, rng = small_gru(), np.random.default_rng(4)
    x, y, h = rng.integers(0, 8, (3, 4)), rng.integers(0, 8, (3, 4)), rng.normal(size=(3, 5)).astype(np.float32)
    states, last = [], h
    for t in range(4):
        last, _ = net.step(x[:, t], last)
        states.append(last)
    wanted = -net.log_probabilities(np.concatenate(states), y.T.reshape(-1)).mean()
    monkeypatch.setattr(Gru, "log_probabilities", None)
    _, end, loss = net.slopes(x, y, h)
    assert loss == pytest.approx(wanted, abs=1e-6) and end == pytest.approx(last, abs=1e-6)


@pytest.mark.parametrize("size", [1, 7, 10**6])
def test_blocks_hold_the_tokens_of_all_texts(monkeypatch, size):
    monkeypatch.setattr(lm_scoring, "BLOCK_TOKENS", size)
    rows = [(k, t, k % 3 == 0) for k, t in enumerate(["A b\u00c9 a", None, "", " x\x0b\tY  y ", "b", "Ab ab\u00a0AB"] * 4)]
    source = pa.RecordBatch.from_pylist([{"id": i, "held_out": out, "text": t} for i, t, out in rows])

    class Docs:
        dtypes = [("id", "bigint")]

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            monkeypatch.setattr(lm_scoring.TaskContext, "get", lambda: lm_scoring.TaskContext())
            monkeypatch.setattr(lm_scoring.TaskContext, "partitionId", lambda self: 1)
            return list(run(iter([source.slice(0, 5), source.slice(5, 0), source.slice(5)])))

    got, learnt = [], Counter()
    for b in lm_scoring.blocks(Docs()):
        r, at = b.to_pylist()[0], 0
        places, sizes = np.frombuffer(r["places"], "<i4"), np.frombuffer(r["sizes"], "<i8")
        for i, out, n in zip(r["ids"], r["held"], sizes, strict=True):
            got.append((i, out, [r["words"][k].encode() for k in places[at : at + n]]))
            at += n
        assert at == len(places) and (size == 10**6 or at - sizes[-1] < size <= at or got[-1][0] == len(rows) - 1)
        learnt.update(dict(zip(r["words"], r["counts"], strict=True)))
    assert got == [(i, out, lm_scoring.tokens(t or "")) for i, t, out in rows]
    assert +learnt == Counter(w.decode() for _, t, out in rows if not out for w in lm_scoring.tokens(t or ""))


def test_state_is_carried_through_whole_sequences():
    net = small_gru()
    rng = np.random.default_rng(2)
    lengths = np.array([5, 0, 1, 40, 7])
    flat = rng.integers(0, 8, lengths.sum())
    got = net.sequences(flat, lengths, 0, chunk=16)
    at = 0
    for n in lengths:
        h, before = np.zeros((1, 5), np.float32), np.array([0])
        for t in range(n):
            h, _ = net.step(before, h)
            before = flat[at + t : at + t + 1]
            assert got[at + t] == pytest.approx(net.log_probabilities(h, before)[0], abs=1e-5)
        at += n


def test_network_learns_order():
    stream = np.tile([0, 1, 2, 3], 2000)
    net = Gru(np.bincount(stream).astype(float), hidden=8, width=2)
    before = net.sequences(stream[:400], np.array([400]), 3).mean()
    net.fit(stream, streams=8, window=16, epochs=4, rate=0.01)
    assert net.sequences(stream[:400], np.array([400]), 3).mean() > before / 4


def test_network_learns_from_all_training_documents(spark, monkeypatch):
    rng = random.Random(6)
    ring = [f"w{k}" for k in range(40)]
    # A word tells the next one; counts alone don't.
    rows = [(i, " ".join(ring[(at + k) % 40] for k in range(200))) for i, at in enumerate(rng.choices(range(40), k=1500))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    first = lm_scoring.fit
    monkeypatch.setattr(lm_scoring, "fit", lambda *a: first(*a, fit_tokens=0))
    monkeypatch.setattr(lm_scoring, "BLOCK_TOKENS", 20_000)
    monkeypatch.setattr(lm_scoring, "STREAMS", 16)
    held = [r for r in lm_scoring.score(docs).collect() if r["held_out"]]
    assert len(held) > 100 and sum(r["score"] for r in held) > 0.8 * sum(r["base_score"] for r in held)


# --- SimHash


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3), st.integers(0, simhash.LEVELS - 1))
def test_masks_cover_the_radius(fp, flipped, level):
    other = fp
    for b in flipped:
        other ^= 1 << b
    assert any(fp & int(m) == other & int(m) for m in simhash.masks(3, level))


def brute_components(fps, radius=3):
    root = {f: f for f in fps}
    for a, b in itertools.combinations(fps, 2):
        if bin((a ^ b) & (2**64 - 1)).count("1") <= radius and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {f: low if r == high else r for f, r in root.items()}
    return root


@pytest.mark.parametrize("bucket", [2, 8, 2048])
def test_links_give_the_components_of_all_pairs(spark, bucket):
    rng = random.Random(bucket)
    fps = set()
    for _ in range(12):
        f = rng.getrandbits(64)
        for _ in range(20):
            fps.add(f)
            for _ in range(rng.randint(1, 4)):
                f ^= 1 << rng.randrange(64)
    signed = sorted(f - 2**64 if f >= 2**63 else f for f in fps)
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = {r["fp"]: r["root"] for r in simhash.components(simhash.links(frame, 3, bucket)).collect()}
    assert {f: roots.get(f, f) for f in signed} == brute_components(signed)


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(100)]
    star = [(500, k) for k in range(501, 560)] + [(559, 400)]
    frame = spark.createDataFrame(chain + star, "a long, b long")
    roots = {r["fp"]: r["root"] for r in simhash.components(frame).collect()}
    assert roots == {**{k: 0 for k in range(101)}, **{k: 400 for k in (400, *range(500, 560))}}


# --- pages


def text_of(page):
    return html_wrapper.main_text(html_wrapper.blocks(page), set())


def test_broken_and_unusual_pages():
    cases = {
        '<div class="sidebar">x</div><div id="content"><p>Hello &amp; you</p><p>second <b>bo</b>ld<br>line</p></div><div class="comments">bad</div>': "Hello & you second bold line",
        "<p>a<p>b</p": "a b", "text < 5 & more": "text < 5 & more", '<div><script>if(a<b){"</p>"}</script>ok</div>': "ok", "<ul><li>one<li>two</ul>": "one two",
        '<header>top</header><article><header><h1>T</h1></header><p>x<aside>no</aside>y</p><section class="comments">c</section></article>after': "T x y",
        "<div hidden>h</div>v": "v", '<p title="a>b">q</p>': "q", '<a title="unclosed>z</a> w <p>k': "z w k", "<form>f</form><!-- c --><p>a\n b&nbsp;c": "a b c", "": "",
    }
    for page, wanted in cases.items():
        assert text_of(page) == wanted, page


def test_tree_matching_is_the_largest_mapping():
    def tree(spec):
        t = html_wrapper.Tree(spec[0], 0)
        t.children = [tree(c) for c in spec[1]]
        return t

    a = tree((1, [(2, []), (3, [(4, []), (5, [])]), (6, [])]))
    b = tree((1, [(3, [(5, [])]), (2, []), (6, [])]))
    assert html_wrapper.match(a, b)[0] == 4


def test_constant_slots_become_template(spark):
    rows = []
    for k in range(40):
        body = f"<div><div>Welcome to our site</div><div><p>Story {k} tells of thing {k * 7}</p><p>More on {k}</p></div><div>All rights kept by us</div></div>"
        rows.append((k, f"https://www.site.com/{k}", f"<html><body>{body}</body></html>"))
    rows += [(100, "https://other.com/", "<p>Welcome to our site</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_wrapper.extract(pages).collect()}
    assert all(got[k] == f"Story {k} tells of thing {k * 7} More on {k}" for k in range(40))
    assert got[100] == "Welcome to our site"


def test_end_tags_pair_up_in_deep_pages():
    for n in (99, 120, 5000):
        assert text_of(f"<div><article>{'<div>' * n}in{'</div>' * n}<p>after</p></article></div>out") == "in after"
        assert text_of(f"<article>{'<div>' * n}<nav><div>menu</div></nav>in<ul><li>one<li>two</ul>{'</div>' * n}<p>after</p></article>out") == "in one two after"
        assert text_of(f"<article>{'<b>' * n}<span hidden>gone</span>in{'</b>' * n}<p>after</p></article>out") == "in after"
    deep = html_wrapper.blocks("<div>x" * 3000)
    assert len(deep) == 3000 and max(b.element.depth for b in deep) == html_wrapper.MAX_DEPTH + 1


def test_copies_of_a_page_are_no_template(spark):
    page = "<html><body><p>Front words</p><article><h1>A headline</h1><p>Short story of one page</p></article></body></html>"
    plain = "<html><body><h1>Plain page</h1><p>Words without an article</p></body></html>"
    rows = [(k, f"http{'s' * (k % 2)}://copies.com/x?utm={k}", page) for k in range(10)] + [(10 + k, f"https://plain.com/?{k}", plain) for k in range(10)]
    # Four pages besides ninety copies of a fifth: the foot is on all, the fifth page's text on one.
    rows += [(100 + k, f"https://mixed.com/{k}", f"<div><p>Story {max(k - 89, 0)} is told</p></div><div>All rights kept</div>") for k in range(94)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_wrapper.extract(pages).collect()}
    assert all(got[k] == "A headline Short story of one page" for k in range(10))
    assert all(got[k] == "Plain page Words without an article" for k in range(10, 20))
    assert all(got[100 + k] == f"Story {max(k - 89, 0)} is told" for k in range(94))


def test_hostile_pages_end():
    for page in ("<div>" * 20_000 + "x", '<a title="' * 20_000, "<div>a<p>b" * 5_000, "<" * 50_000, "<b><i>" * 10_000 + "x"):
        html_wrapper.Tree.of(html_wrapper.skeleton(html_wrapper.blocks(page)))


def stripped(page):
    """A page without class names, and with plain divisions for its article."""
    page = re.sub(r'\s(?:class|id|role)="[^"]*"', "", page)
    return re.sub(r"<(/?)(?:article|main|section)\b", r"<\1div", page)


def test_the_wrapper_needs_no_names(spark):
    """On hosts with a wrapper, content is found by what varies at aligned nodes: the same texts come out without class names and article tags."""
    import duckdb

    folder = "/root/testdata/sf0.01"
    rows = duckdb.execute(f"SELECT page_id, url, html FROM '{folder}/pages.parquet'").fetchall()
    # One host for every so many pages, so that each has a wrapper.
    rows = [(i, f"https://host{i % 8}.com/{i}", h) for i, _, h in rows]
    kinds = "page_id long, url string, html string"
    named = {r["page_id"]: r["text"] for r in html_wrapper.extract(spark.createDataFrame(rows, kinds)).collect()}
    bare_rows = [(i, u, stripped(h)) for i, u, h in rows]
    bare = {r["page_id"]: r["text"] for r in html_wrapper.extract(spark.createDataFrame(bare_rows, kinds)).collect()}
    assert bare == named
    # Without a wrapper, the names are missed.
    alone = {i: html_wrapper.main_text(html_wrapper.blocks(h), set()) for i, _, h in bare_rows}
    assert sum(alone[i] != named[i] for i in named) > 0.9 * len(named)


def test_headlines_beside_the_body_are_content(spark):
    """The content slot is not narrowed to the part with most text where a varying heading would be lost."""
    rows = []
    for k in range(12):
        body = "".join(f"<p>Sentence {j} of story {k} goes on and on for a while</p>" for j in range(9))
        page = f"<div><div>Old news {k}</div><div><h2>Title {k}</h2><div><div>{body}</div></div></div><div><span>You may like {k}</span></div></div>"
        rows.append((k, f"https://x.com/{k}", page))
    got = {r["page_id"]: r["text"] for r in html_wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(12):
        assert got[k] == f"Title {k} " + " ".join(f"Sentence {j} of story {k} goes on and on for a while" for j in range(9))


def test_content_slot_by_hand():
    part, text, heading = html_wrapper.PART, html_wrapper.TEXT, html_wrapper.HEADING
    assert html_wrapper.content_slot([]) == 0
    # root 0 - 1 (menu), 2 (main) - 3 (body) - 4 (paragraphs)
    found = [(0, 0, 0, 0), (1, 0, part, 30), (2, 0, part, 0), (3, 2, part, 0), (4, 3, text, 300)]
    assert html_wrapper.content_slot(found) == 3
    assert html_wrapper.content_slot([*found, (5, 2, heading, 9)]) == 2
    assert html_wrapper.content_slot([*found, (5, 2, text, 200)]) == 2
    assert html_wrapper.content_slot([(0, 0, 0, 0), (1, 0, part, 100), (2, 0, part, 100)]) == 0


# --- token ids of words that change their length


def special_letters():
    """Code points whose lower case or normal form is longer than one character, or that join with marks."""
    import unicodedata

    points = [chr(k) for k in range(0x110000) if not 0xD800 <= k < 0xE000]
    return [c for c in points if len(c.lower()) > 1 or any(len(unicodedata.normalize(f, c)) > 1 for f in ("NFC", "NFKC", "NFD"))]


def test_words_that_gain_marks_get_the_tokenizers_ids():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = tokens.WordEncoder(path)
    rng, special = random.Random(8), special_letters()
    assert "İ" in special
    batch = ["İ!", "TEKLİFİ, ÖNERİ", "İ", "İİ...", "x İ", "ſt ﬁn!", "e\u0301!", "\u0301", "\u0301!"]
    for _ in range(4000):
        word = lambda: "".join(rng.choice(special) if rng.random() < 0.4 else rng.choice("aZé1'.!,-\u0301\u0307ß") for _ in range(rng.randint(1, 5)))
        batch.append(" ".join(word() for _ in range(rng.randint(1, 4))))
    got = encoder(batch)
    wanted = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in batch]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == wanted
    # Again, when all words are known.
    assert encoder(batch) == got


def test_letters_and_marks_are_learnt_once_for_all_words_made_of_them():
    import public_tokenizers

    encoder = tokens.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [b"Word, word! WORD", b"", b"caf\xc3\xa9, caf\xc3\xa9! ?! it's 4th", b" "]
    values, n = encoder.column(pa.array([b"left out", *texts]).slice(1))
    wanted = [encoder.tokenizer.encode(t.decode(), add_special_tokens=False).ids for t in texts]
    assert values.tolist() == sum(wanted, []) and n.tolist() == [len(ids) for ids in wanted]
    assert set(encoder.pieces) == {b"", b"word", "café".encode(), b",", b"!"} and set(encoder.known) == {b"?!", b"it's", b"4th"}
    assert [x.tolist() for x in encoder.column(pa.array([], pa.binary()))] == [[], []]


def test_ids_that_are_no_numbers_are_null(spark, tmp_path):
    import public_tokenizers

    docs = spark.createDataFrame([("7", "a b"), ("x1", "c"), (None, "d"), ("12", None)], "doc_id string, text string")
    tokens.write(docs, str(tmp_path / "t"), public_tokenizers.path("word_bpe_49k.json"))
    rows = tokens.digests(tokens.spans(spark, str(tmp_path / "t"))).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in rows)[0] == ("12", 1) and sum(r["doc_id"] is None for r in rows) == 2


# --- personal data in long texts


def test_overlaps_equal_the_plain_version():
    rng = random.Random(4)
    for _ in range(300):
        spans = lambda n: [(a, a + rng.randint(1, 9), rng.randrange(4)) for a in (rng.randrange(60) for _ in range(n))]
        base, loose = sorted(spans(rng.randrange(6)), key=lambda s: (s[0], s[2])), spans(rng.randrange(12))
        wanted = []
        for s in sorted(loose, key=lambda s: (s[0], s[2])):
            if not any(s[0] < b and a < s[1] for a, b, _ in [*base, *wanted]):
                wanted.append(s)
        assert pii.apart(loose, base) == wanted


def test_two_megabytes_of_addresses_and_numbers():
    import time

    text = "192.168.10.7 (415) 555-2671 " * (2_000_000 // 28)
    began = time.time()
    base = pii.base_spans(text)
    more = pii.apart(pii.loose_spans(text), base)
    assert len(base) > 70_000 and len(more) > 70_000 and time.time() - began < 15


# --- groups with a hot fingerprint


def test_hot_fingerprints_are_joined_like_others(spark, monkeypatch):
    rows = [(k, "the same words again and again") for k in range(500)] + [(1000 + k, f"words of text {k} alone {k * k}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    monkeypatch.setattr(simhash, "HOT", 10)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()} == want
    assert len(want) == 560 and {want[k][1] for k in range(500)} == {0}


def test_clashing_names_stay(spark):
    names = ["_sh_fp", "_sh_row", "_sh_text", "_sh_root", "a.b", "fp"]
    docs = spark.createDataFrame([(2, "one two three four"), (1, "one two three four"), (3, "else")], "doc_id long, text string").select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "one two three four", *range(6)), (3, "else", *range(6))]


def test_numbers_swallowed_by_a_strict_match_are_candidates():
    text = "call +1 (826) 555-4081 4111 1111 1111 1111 12 now, or +49 30 1234567 and 4111 1111 1111 1112"
    assert pii.base_spans("call +1 (826) 555-4081 4111 1111 1111 1111 12") == []
    found = {(text[a:b], k) for a, b, k in pii.apart(pii.loose_spans(text), pii.base_spans(text))}
    assert ("+1 (826) 555-4081", 3) in found
    assert ("4111 1111 1111 1111", 2) in {(text[a:b], k) for a, b, k in pii.loose_spans(text)}
    assert pii.base_spans(text) == [(text.index("+49"), text.index("+49") + 14, 3)]


def test_spans_are_counted(spark):
    found = spark.createDataFrame([(1, "", ""), (2, "email:0:5", "email:0:5,phone:7:20")], "doc_id long, base string, spans string")
    assert {r["doc_id"]: (r["n_email"], r["n_spans"]) for r in pii.digests(found).collect()} == {1: (0, 0), 2: (1, 2)}


def test_scoring_keeps_nothing_for_a_way_back(monkeypatch):
    """op9_lm_scoring: each step of scoring made what only learning needs; the sums are those of the single steps."""
    from tidemark.llm.gru import Gru

    net, rng = Gru(np.arange(40, 0, -1.0)), np.random.default_rng(3)
    lengths = np.array([3, 0, 7, 1, 7])
    tokens, want = rng.integers(0, 40, lengths.sum()), []
    for a, b in zip(np.cumsum(lengths) - lengths, np.cumsum(lengths), strict=True):
        h, before = np.zeros((1, net.hidden), np.float32), np.array([5])
        for t in tokens[a:b]:
            h, _ = net.step(before, h)
            before = np.array([t])
            want.append(net.log_probabilities(h, before)[0])
    monkeypatch.setattr(Gru, "step", None)
    for chunk in (1, 4, 8_192):
        np.testing.assert_allclose(net.sequences(tokens, lengths, 5, chunk), want, rtol=1e-5)
    assert len(net.sequences(np.zeros(0, int), np.zeros(2, int), 5)) == 0
