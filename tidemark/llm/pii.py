"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation learns how
far each can be trusted, and a span classifier trained on the result decides.

Strict patterns give the base spans, which always stay. Looser patterns propose more candidates: emails
written with "at" and "dot", addresses with bracketed dots, card numbers with other separators, phone
numbers without a plus sign, and cards and phones that a strict pattern swallowed together with a number behind them. Five labelers look at every candidate, base ones included: its format, its
check digits or ranges, a gazetteer (domain endings, card issuers, first octets, area codes), the words
before it, and the characters beside it. They vote yes, no or nothing.

A candidate is reduced to its kind, its votes and a few features of its shape, so there are at most
``PATTERNS`` different ones; the cluster counts them over all documents, and the counts are all that the
driver fits on. A candidate that overlaps a base span is never added.

Null and empty texts have no spans. Documents are searched whole, one by one: repeated rows give repeated
rows and an empty table gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, texts, written

KINDS = ["email", "ip", "card", "phone"]
LABELERS = ["format", "check", "gazetteer", "context", "neighbours"]
#: Four kinds, five votes of three values, two shape features of four and two values.
PATTERNS = 4 * 3**5 * 8
#: A candidate is added if the classifier gives it at least this probability.
ADD_FROM = 0.9

Span = tuple[int, int, int]  # start, end, kind

_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_AT_DOT = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?: at |\s?[\[({]at[\])}]\s?|@)[A-Za-z0-9-]{1,63}(?:(?: dot |\s?[\[({](?:dot|\.)[\])}]\s?|\.)[A-Za-z0-9-]{1,63})+", re.I)
_IP_BRACKETS = re.compile(r"(?<![0-9])[0-9]{1,3}(?:[\[(]\.[\])][0-9]{1,3}){3}(?![0-9])")
_CARD_LOOSE = re.compile(r"(?<![0-9])[0-9]{4}(?:[./_ –][0-9]{4}){2}[./_ –][0-9]{1,7}(?![0-9])")
#: What a strict match may have swallowed together with the number behind it, and failed for.
_CARD_GROUPS = re.compile(r"(?<![0-9])(?=([0-9]{4}([ -])[0-9]{4}\2[0-9]{4}\2[0-9]{4})(?![0-9]))")
_PHONE_PREFIX = re.compile(r"\+[1-9][0-9]{0,2}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])")
_PHONE_LOOSE = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9+])00[1-9][0-9 ().-]{6,20}[0-9](?![0-9])")

# Gazetteers and cue words.
DOMAIN_ENDS = set("com org net edu gov mil int info io de fr es uk it nl eu us ca au ch at be se no dk pl pt br mx ar jp cn in ru".split())
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "22", "23", "24", "25", "26", "27", "34", "37", "36", "38", "30", "6011", "65", "35")
CUES = {
    0: set("mail email e-mail contact write address adresse correo courriel schreiben".split()),
    1: set("ip host server address addr node gateway client login".split()),
    2: set("card visa mastercard amex credit debit karte carte tarjeta payment".split()),
    3: set("phone tel telephone call mobile cell fax telefon appel llama whatsapp".split()),
}
COUNTER_CUES = set("version v order id isbn page section figure seite artikel numero ref invoice build".split())


def luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        # What stands before this sign can't be part of a later match.
        done = m.end() if m else at + 1
        if m:
            yield start, done, 0
        at = text.find("@", done)


def _ips(text: str) -> Iterator[Span]:
    for m in _NUMBERS.finditer(text):
        if m.group().count(".") < 3:
            continue
        ends, at = [], m.start()
        for label in m.group().split("."):
            ends.append((at, at + len(label)))
            at += len(label) + 1
        for k in range(0, len(ends) - 3, 4):
            four = ends[k : k + 4]
            if all(len(p := text[a:b].lstrip("0")) < 4 and int(p or 0) <= 255 for a, b in four):
                yield four[0][0], four[3][1], 1


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def base_spans(text: str) -> list[Span]:
    """The strict spans in order of start, then kind."""
    out = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        out += _ips(text)
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m.group())) <= 19 and luhn(d):
                out.append((m.start(), m.end(), 2))
        if "+" in text:
            out += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


def loose_spans(text: str) -> list[Span]:
    """Further candidates, which the classifier accepts or not."""
    out = []
    low = text.lower()
    if any(x in low for x in (" dot ", "[dot]", "(dot)", "{dot}", "[at]", "(at)", "{at}", "[.]", "(.)")):
        out += [(m.start(), m.end(), 0) for m in _AT_DOT.finditer(text)]
        out += [(m.start(), m.end(), 1) for m in _IP_BRACKETS.finditer(text)]
    if _DIGIT.search(text):
        # Of spans with one start, the first in the list is kept.
        out += [(m.start(1), m.end(1), 2) for m in _CARD_GROUPS.finditer(text) if luhn(_digits(m.group(1)))]
        out += [(m.start(), m.end(), 2) for m in _CARD_LOOSE.finditer(text)]
        # Numbers of a card's length that fail its check, so that the labelers see both outcomes.
        out += [(m.start(), m.end(), 2) for m in _CARD.finditer(text) if m.end() - m.start() >= 12 and 12 <= len(_digits(m.group())) <= 19]
        if "+" in text:
            out += [(m.start(), m.end(), 3) for m in _PHONE_PREFIX.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
        out += [(m.start(), m.end(), 3) for m in _PHONE_LOOSE.finditer(text)]
    return out


def pattern(text: str, span: Span, strict: bool) -> str:
    """Kind, votes (1 yes, 0 no, - nothing) and shape of a candidate."""
    start, end, kind = span
    inside = text[start:end]
    digits = _digits(inside)
    if kind == 0:
        plain = re.sub(r"\s?[\[({ ](?:dot|\.)[\])} ]\s?", ".", re.sub(r"\s?[\[({ ]at[\])} ]\s?", "@", inside, flags=re.I), flags=re.I)
        end_label = plain.rpartition(".")[2].lower()
        form = "1" if strict else "-" if plain.count("@") == 1 else "0"
        check = "1" if re.fullmatch(r"[a-z]{2,24}", end_label) else "0"
        gazetteer = "1" if end_label in DOMAIN_ENDS else "0"
    elif kind == 1:
        parts = [int(p) for p in re.findall(r"[0-9]{1,9}", inside)]
        form = "1" if strict else "-"
        check = "1" if len(parts) == 4 and max(parts) <= 255 else "0"
        gazetteer = "1" if parts and 1 <= parts[0] <= 223 else "0"
    elif kind == 2:
        form = "1" if strict else "-" if re.search(r"[./_ –]", inside) else "0"
        check = "1" if luhn(digits) else "0"
        gazetteer = "1" if digits.startswith(CARD_PREFIXES) else "0"
    else:
        form = "1" if strict else "-"
        check = "1" if 9 <= len(digits) <= 15 else "0"
        local = digits[-10:]
        gazetteer = "1" if len(local) == 10 and local[0] in "23456789" else "-"
    before = set(re.findall(r"[a-z-]+", text[max(0, start - 40) : start].lower())[-5:])
    context = "1" if before & CUES[kind] else "0" if before & COUNTER_CUES else "-"
    beside = text[max(0, start - 1) : start] + text[end : end + 1]
    neighbours = "0" if any(c.isalnum() or c in "_=/\\" for c in beside) else "1"
    groups = min(len(re.findall(r"[A-Za-z0-9]+", inside)), 8) // 3
    return f"{kind}{form}{check}{gazetteer}{context}{neighbours}{groups}{int(' ' in inside)}"


def apart(spans: list[Span], base: list[Span]) -> list[Span]:
    """``spans`` in order of start, then kind, without those that meet a base span or one taken before; base spans are sorted by start.

    Both lists are gone through once: a place only moves on in the base spans, joined where they meet.
    """
    joined_: list[list[int]] = []
    for a, b, _ in base:
        if joined_ and a < joined_[-1][1]:
            joined_[-1][1] = max(joined_[-1][1], b)
        else:
            joined_.append([a, b])
    out: list[Span] = []
    k = end = 0
    for s in sorted(spans, key=lambda s: (s[0], s[2])):
        while k < len(joined_) and joined_[k][1] <= s[0]:
            k += 1
        if s[0] >= end and (k == len(joined_) or joined_[k][0] >= s[1]):
            out.append(s)
            end = s[1]
    return out


class SpanModel:
    """Reliabilities of the labelers and the span classifier, fitted on counts of patterns."""

    def __init__(self, counts: dict[str, int], rounds: int = 50):
        if len(counts) > PATTERNS:
            raise ValueError("more patterns than the votes and features allow")
        names = sorted(counts)
        weight = np.array([counts[p] for p in names], float)
        votes = np.array([["01-".index(c) for c in p[1:6]] for p in names], int).reshape(-1, len(LABELERS))
        kinds = np.array([int(p[0]) for p in names], int)
        self.accepted: set[str] = set()
        self.posterior = np.zeros(len(names))
        for kind in range(len(KINDS)):
            own = kinds == kind
            if own.any():
                self.posterior[own] = self._reliabilities(votes[own], weight[own], rounds)
        if names:
            x = self._features(names)
            self.weights = self._classifier(x, self.posterior, weight)
            for p, score in zip(names, 1 / (1 + np.exp(-x @ self.weights)), strict=True):
                if score >= ADD_FROM:
                    self.accepted.add(p)

    @staticmethod
    def _reliabilities(votes: np.ndarray, weight: np.ndarray, rounds: int) -> np.ndarray:
        """Probability of each pattern to be real, by expectation-maximisation over both unknowns."""
        n = votes.shape[1]
        # Start: a labeler that votes is right four times out of five.
        rate = np.array([[[0.7, 0.15, 0.15]] * n, [[0.15, 0.7, 0.15]] * n])
        prior = np.array([0.5, 0.5])
        post = np.zeros(len(votes))
        for _ in range(rounds):
            log = np.log(prior)[:, None] + np.log(rate[:, np.arange(n)[None], votes]).sum(axis=2)
            post = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
            both = np.stack([1 - post, post]) * weight
            prior = (both.sum(axis=1) + 1) / (weight.sum() + 2)
            for value in range(3):
                # Ten made-up votes keep the meaning of "yes" when real ones are few.
                pseudo = np.array([[7.0, 1.5, 1.5], [1.5, 7.0, 1.5]])[:, value]
                rate[:, :, value] = (both @ (votes == value) + pseudo[:, None]) / (both.sum(axis=1) + 10)[:, None]
        return post

    @staticmethod
    def _features(names: list[str]) -> np.ndarray:
        rows = []
        for p in names:
            row = [1.0] + [float(int(p[0]) == k) for k in range(len(KINDS))]
            row += [float(c == v) for c in p[1:6] for v in "01"]
            rows.append(row + [float(p[6] == v) for v in "0123"] + [float(p[7])])
        return np.array(rows)

    @staticmethod
    def _classifier(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 30, ridge: float = 0.05) -> np.ndarray:
        """Logistic regression on the posteriors (Newton steps); common patterns count by their logarithm."""
        w, scale = np.zeros(x.shape[1]), np.log1p(weight)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (scale * (p - y)) + ridge * w
            w -= np.linalg.solve((x.T * (scale * p * (1 - p))) @ x + ridge * np.eye(len(w)), slope)
        return w


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def candidates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, base, patterns, spans``: base spans as text, and every candidate with its pattern."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for text in texts(b["text"]):
            base = base_spans(text)
            own = [(s, pattern(text, s, True)) for s in base]
            own += [(s, pattern(text, s, False)) for s in apart(loose_spans(text), base)]
            found.append((joined(base), [p for _, p in own], [f"{a}:{e}:{k}" for (a, e, k), _ in own]))
        base, patterns, spans = zip(*found, strict=True) if found else ((), (), ())
        return pa.RecordBatch.from_arrays([b["id"], pa.array(base, pa.string()), pa.array(patterns, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.string()))], names=["id", "base", "patterns", "spans"])

    return map_rows(rows, run, f"id {kind}, base string, patterns array<string>, spans array<string>")


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, base, spans`` for every document: strict spans, and all spans, as ``kind:start:end`` texts."""
    seen = written(candidates(docs, id_col=id_col, text_col=text_col), "pii-candidates")
    # At most PATTERNS rows.
    counts = {r["p"]: r["n"] for r in seen.select(F.explode("patterns").alias("p")).groupBy("p").agg(F.count("*").alias("n")).collect()}
    accepted = SpanModel(counts).accepted
    kind = dict(seen.dtypes)["id"]

    def decide(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for base, patterns, spans in zip(b["base"].to_pylist(), b["patterns"].to_pylist(), b["spans"].to_pylist(), strict=True):
            n = base.count(",") + 1 if base else 0
            own = [tuple(map(int, s.split(":"))) for s in spans]
            out.append(joined(sorted(own[:n] + [s for s, p in zip(own[n:], patterns[n:], strict=True) if p in accepted], key=lambda s: (s[0], s[2]))))
        return pa.RecordBatch.from_arrays([b["id"], b["base"], pa.array(out, pa.string())], names=["id", "base", "spans"])

    return map_rows(seen, decide, f"id {kind}, base string, spans string").withColumnRenamed("id", id_col)


def digests(found: DataFrame) -> DataFrame:
    """Counts and the hash of the base spans beside all spans and their number."""
    def count(kind: str):
        # The filter's function gets one argument; a second one would be the index.
        return F.size(F.filter(F.split("base", ","), lambda s: s.startswith(f"{kind}:"))).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    number = F.when(F.col("spans") == "", 0).otherwise(F.size(F.split("spans", ","))).cast("long").alias("n_spans")
    ids = [c for c in found.columns if c not in ("base", "spans")]
    return found.select(*ids, *counts, F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans", number)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
