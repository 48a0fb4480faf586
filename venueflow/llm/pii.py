"""Personal data by weak supervision.

Patterns propose candidate spans of four kinds. Labelers vote on each candidate: strict patterns and
check digits (regex), lists of top-level domains, calling codes and issuer ranges (gazetteer), and
the words before the span (context). Votes are counted over the whole corpus, expectation
maximisation estimates how reliable each labeler is, and a logistic span classifier is trained on
the resulting probabilities. Spans of the base patterns always stay; other candidates are added
where the classifier is sure.

Defined results: a null text is an empty one and has no spans; very long texts are scanned whole, in
time linear in their length; repeated rows and null ids are handled row by row; without any
candidate the classifier accepts nothing; an empty table gives an empty one.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venueflow.llm.common import free_names
from venueflow.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "check", "gazetteer", "context", "edges")
BELIEFS = (0.8, 0.98, 0.7, 0.75, 0.7)  # how often each labeler is right before any data; check digits hardly err
BELIEF_SHARE = 0.1  # weight of these beliefs beside the counts, so that no labeler turns around
ABSTAIN, NO, YES = 0, 1, 2
ACCEPT = 0.9  # probability from which a candidate outside the base patterns is added
CONTEXT_CHARS = 40

# The base patterns, as given.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A leftmost match starts at the start of a digit run; possessive repeats keep the scan linear.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Wider patterns, for candidates the base ones leave out.
HIDDEN_AT = re.compile(r"[(\[{] ?[aA][tT] ?[)\]}]")
HIDDEN_DOMAIN = re.compile(r" ?[A-Za-z0-9-]++(?: ?[(\[{] ?[dD][oO][tT] ?[)\]}] ?[A-Za-z0-9-]++|\.[A-Za-z0-9-]++)++")
IP6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
SOLID_CARD = re.compile(r"(?<![0-9])(?:[0-9]{13,19}|(?:[0-9]{4}[ -]){3}[0-9]{4})(?![0-9])")
NATIONAL = re.compile(r"(?<![0-9+A-Za-z(])(?:\+[0-9]{1,3}[-. ]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-.][0-9]{4}(?![0-9A-Za-z])")

# Gazetteers and context words (fixed values).
TOP_DOMAINS = frozenset("com org net edu gov mil int info biz io dev app co me eu uk us de fr es it nl be ch at pl se no dk fi pt ie cz ru cn jp kr in br mx ar au nz ca za example test".split())
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "98", "212", "213", "234", "254", "351", "352", "353", "354", "358", "370", "371", "372", "380", "420", "421", "966", "971", "972")
ISSUERS = ("4", "51", "52", "53", "54", "55", "22", "23", "24", "25", "26", "27", "34", "37", "36", "38", "35", "6011", "64", "65", "62", "50", "56", "57", "58", "67")
FOR_CONTEXT = {
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|write to|reach|kontakt|correo|courriel|adresse)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|host|server|address|login|from|client|adresse)\b"),
    "card": re.compile(r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta|payment)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|telephone|mobile|call|fax|cell|telefon|téléphone|teléfono)\b"),
}
AGAINST_CONTEXT = re.compile(r"(?i)\b(?:version|release|isbn|issn|doi|section|chapter|invoice|order no|serial|build)\b")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the base e-mail pattern, found from their @ so that long runs cost linear time."""
    free = 0  # where the previous match ended
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            free = m.end()
            yield start, free


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in order."""
    spans = [(s, 0, e) for s, e in _emails(text)]
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p) <= 3 and int(p) <= 255 or int(p) <= 255 for p in map(_short, m.group().split(".")))]
    for m in CARD.finditer(text):
        if 14 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            spans.append((m.start(), 2, m.end()))
    spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(spans)


def _short(part: str) -> str:
    """A digit run without leading zeros, cut after four digits, so that its number is cheap to read."""
    return (part.lstrip("0") or "0")[:4]


def wider_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates outside the base spans: written-out addresses, IPv6, national numbers, other digit groups."""
    found = []
    for m in HIDDEN_AT.finditer(text):
        start = m.start() - (m.start() > 0 and text[m.start() - 1] == " ")
        at = start
        while start > 0 and text[start - 1] in LOCAL:
            start -= 1
        tail = HIDDEN_DOMAIN.match(text, m.end())
        if start < at and tail:
            found.append((start, 0, tail.end()))
    found += [(m.start(), 1, m.end()) for m in IP6.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in SOLID_CARD.finditer(text)]  # also where a neighbouring number hid it
    found += [(m.start(), 3, m.end()) for m in NATIONAL.finditer(text)]
    starts = [s for s, _, _ in base]  # in order
    reach = list(itertools.accumulate((e for _, _, e in base), max))
    out, free = [], 0
    for s, k, e in sorted(set(found)):
        i = bisect.bisect_left(starts, e)
        if s >= free and (i == 0 or reach[i - 1] <= s):
            out.append((s, k, e))
            free = e
    return out


def _votes(text: str, kind: int, start: int, end: int, base: bool) -> tuple[int, ...]:
    span = text[start:end]
    digits = _digits(span)
    before = text[max(0, start - CONTEXT_CHARS) : start]
    name = KINDS[kind]
    pattern = YES if base or kind == 2 else NO if kind == 1 and ":" not in span else ABSTAIN
    if name == "email":
        parts = re.split(r"\.| ?[(\[{] ?dot ?[)\]}] ?", span.lower())
        check = YES if len(span) <= 254 and not span.startswith(".") and ".." not in span else NO
        listed = YES if parts[-1].strip() in TOP_DOMAINS else NO
    elif name == "ip":
        check = YES if ":" in span or (base and not any(len(p) > 1 and p[0] == "0" for p in span.split("."))) else NO
        listed = NO if span.startswith(("0.", "255.")) else ABSTAIN
    elif name == "card":
        check = YES if luhn(digits) else NO
        listed = YES if digits.startswith(ISSUERS) and len(set(digits)) > 2 else NO
    else:
        check = YES if 10 <= len(digits) <= 15 else NO
        listed = (YES if digits.startswith(CALLING_CODES) else NO) if span.startswith("+") else ABSTAIN
    near = YES if FOR_CONTEXT[name].search(before) else NO if AGAINST_CONTEXT.search(before) else ABSTAIN
    left, right = text[start - 1 : start], text[end : end + 1]
    edges = NO if left.isalnum() or right.isalnum() or (kind and (left in tuple("-./=") or right in tuple("-/="))) else YES
    return pattern, check, listed, near, edges


def _features(text: str, kind: int, start: int, end: int) -> tuple[int, ...]:
    """Yes-or-no features of the span itself; with the votes they feed the classifier."""
    span = text[start:end]
    return (
        int(end - start > 16), int(" " in span), int("-" in span), int("." in span),
        int(span[:1] in "+("), int(len(set(span)) <= 3),
    )


def code(numbers: tuple[int, ...], base: int) -> int:
    out = 0
    for v in numbers:
        out = out * base + v
    return out


def decode(value: int, base: int, n: int) -> list[int]:
    out = []
    for _ in range(n):
        value, v = divmod(value, base)
        out.append(v)
    return out[::-1]


N_FEATURES = 6
PATTERNS = len(KINDS) * 2 * 3 ** len(LABELERS) * 2**N_FEATURES  # the most rows the driver can get: 124,416


def candidates(text: str | None) -> list[tuple[int, int, int, bool, int, int]]:
    """(start, kind, end, base, votes, features) of every candidate, by start."""
    text = text or ""
    base = base_spans(text)
    out = [(s, k, e, True) for s, k, e in base] + [(s, k, e, False) for s, k, e in wider_spans(text, base)]
    return [(s, k, e, b, code(_votes(text, k, s, e, b), 3), code(_features(text, k, s, e), 2)) for s, k, e, b in sorted(out)]


CANDIDATE = pa.list_(pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32()), ("b", pa.bool_()), ("v", pa.int32()), ("f", pa.int32())]))
CANDIDATE_SQL = "array<struct<s:int,k:int,e:int,b:boolean,v:int,f:int>>"


def _scanned(rows: DataFrame) -> DataFrame:
    """``rows`` with ``found``, the candidates of their ``text``."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[dict(zip("skebvf", c)) for c in candidates(t)] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, CANDIDATE)], names=[*names, "found"])

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields]
    return rows.mapInArrow(run, ", ".join([*fields, f"found {CANDIDATE_SQL}"]))


def scan(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id and ``found``, the candidates of the text."""
    return _scanned(docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))).select("doc_id", "found")


@dataclass
class SpanModel:
    """Labeler reliabilities and the span classifier."""

    prior: dict[str, float] = field(default_factory=dict)
    reliability: dict[str, dict[str, list[list[float]]]] = field(default_factory=dict)  # kind -> labeler -> [truth][vote]
    weights: list[float] = field(default_factory=list)

    def probability(self, kind: int, votes: int, features: int) -> float:
        if not self.weights:
            return 0.0
        x = design(np.array([kind]), np.array([votes]), np.array([features]))
        return float(1 / (1 + np.exp(-(x @ np.array(self.weights))[0])))

    def accepts(self, kind: int, base: bool, votes: int, features: int) -> bool:
        return base or self.probability(kind, votes, features) >= ACCEPT


def design(kind: np.ndarray, votes: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Classifier inputs: one, kind, each labeler's yes and no, the span's own features."""
    v = np.array([decode(int(x), 3, len(LABELERS)) for x in votes]).reshape(len(votes), -1)
    f = np.array([decode(int(x), 2, N_FEATURES) for x in features]).reshape(len(features), -1)
    return np.hstack([np.ones((len(kind), 1)), np.eye(len(KINDS))[kind], v == YES, v == NO, f]).astype(float)


def estimate(kind: np.ndarray, votes: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, dict, dict]:
    """Expectation maximisation per kind: P(private | votes), the labelers' vote tables and priors.

    Labelers start out with BELIEFS, which also smooth the counts and fix which side of the hidden
    label is which. A labeler's abstaining carries no weight.
    """
    v = np.array([decode(int(x), 3, len(LABELERS)) for x in votes]).reshape(len(votes), -1)
    start = np.array([[[0.0, r, 1 - r], [0.0, 1 - r, r]] for r in BELIEFS])
    q, prior, tables = np.full(len(kind), 0.5), {}, {}
    for k, name in enumerate(KINDS):
        own = kind == k
        if not own.any():
            continue
        w, x = n[own].astype(float), v[own]
        table, p = start.copy(), 0.5
        for _ in range(rounds):
            with np.errstate(divide="ignore"):
                logs = np.where(x[:, :, None] == ABSTAIN, 0.0, np.log(table[np.arange(len(LABELERS))[None, :], :, x]))
            score = logs.sum(axis=1) + np.log([1 - p, p])
            qk = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -50, 50)))
            p = float(np.clip((w @ qk + 1) / (w.sum() + 2), 0.01, 0.99))
            for j in range(len(LABELERS)):
                for y, share in ((0, 1 - qk), (1, qk)):
                    c = np.array([w @ (share * (x[:, j] == vote)) for vote in (NO, YES)]) + (10 + BELIEF_SHARE * w.sum()) * start[j, y, 1:]
                    table[j, y, 1:] = c / c.sum()
        q[own], prior[name] = qk, p
        tables[name] = {label: table[j].tolist() for j, label in enumerate(LABELERS)}
    return q, prior, tables


def fit(scanned: DataFrame) -> SpanModel:
    """The model of all candidates in ``scanned``. At most PATTERNS counted patterns reach the driver."""
    each = scanned.select(F.explode("found").alias("c")).groupBy("c.k", "c.b", "c.v", "c.f").agg(F.count("*").alias("n"))
    rows = sorted(tuple(r) for r in each.collect())
    if not rows:
        return SpanModel()
    kind, _, votes, features, n = (np.array(c) for c in zip(*rows))
    q, prior, tables = estimate(kind, votes, n)
    x = design(kind, votes, features)
    w, weights = n / n.sum(), np.zeros(x.shape[1])
    for _ in range(50):  # Newton steps for a ridge-penalised weighted logistic fit to the probabilities
        p = 1 / (1 + np.exp(-x @ weights))
        grad = x.T @ (w * (p - q)) + 1e-4 * weights
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(weights))
        step = np.linalg.solve(hess, grad)
        weights -= step / max(1.0, float(np.abs(step).max()) / 2)
        if np.abs(step).max() < 1e-8:
            break
    return SpanModel(prior, tables, weights.tolist())


def _accepted(found: list, model: SpanModel, seen: dict) -> list:
    out = []
    for c in found:
        known = (c["k"], c["b"], c["v"], c["f"])
        if known not in seen:
            seen[known] = model.accepts(*known)
        if seen[known]:
            out.append(c)
    return out


def _listed(spans: list) -> str:
    return ",".join(f"{KINDS[c['k']]}:{c['s']}:{c['e']}" for c in sorted(spans, key=lambda c: (c["s"], c["k"])))


def spans_table(scanned: DataFrame, model: SpanModel) -> DataFrame:
    """doc_id, base counts by kind, base_sha256 and spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for batch in batches:
            counts, digests, spans = [[] for _ in KINDS], [], []
            for found in batch.column("found").to_pylist():
                base = [c for c in found if c["b"]]
                for k in range(len(KINDS)):
                    counts[k].append(sum(c["k"] == k for c in base))
                digests.append(hashlib.sha256(_listed(base).encode()).hexdigest())
                spans.append(_listed(_accepted(found, model, seen)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests), pa.array(spans, pa.string())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

    kind = scanned.schema["doc_id"].dataType.simpleString()
    return scanned.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def find_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Personal data of every row: scans once, keeps the candidates in the shared folder, fits on all of them."""
    scanned = materialize(scan(docs, doc_id, text), "pii-candidates")
    return spans_table(scanned, fit(scanned))


def mask(text: str | None, spans: list) -> str | None:
    """The text with every span replaced by its kind in brackets."""
    if not text:
        return text
    out, at = [], 0
    for c in sorted(spans, key=lambda c: (c["s"], -c["e"])):
        if c["e"] <= at:
            continue
        if c["s"] >= at:
            out += [text[at : c["s"]], f"[{KINDS[c['k']].upper()}]"]
        at = c["e"]  # a span that overlaps the one before goes under its mark
    return "".join(out) + text[at:]


def mask_pii(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with personal data replaced in ``text``; ``n_chars``, where present, follows the new text.

    Texts are scanned once: the candidates are written beside their row.
    """
    others = [c for c in docs.columns if c != text]
    row = F.struct(*[docs[c] for c in others]) if others else F.struct(F.lit(0).alias("none"))
    scanned = materialize(_scanned(docs.select(row.alias("row"), docs[text].alias("text"))), "pii-candidates")
    model = fit(scanned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for batch in batches:
            pairs = zip(batch.column("text").to_pylist(), batch.column("found").to_pylist())
            masked = pa.array([mask(t, _accepted(found, model, seen)) for t, found in pairs], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("row"), masked], names=["row", "text"])

    kind = scanned.schema["row"].dataType.simpleString()
    masked = scanned.mapInArrow(run, f"row {kind}, text string")
    out = masked.select(*[F.col("text").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
    if n_chars in docs.columns:
        (fresh,) = free_names(out, "fresh")
        kind = docs.schema[n_chars].dataType
        out = out.withColumn(fresh, F.length(text).cast(kind)).withColumn(n_chars, F.col(fresh)).drop(fresh)
    return out
