"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length.

Texts are folded first: lower case, accents and invisible characters gone, look-alike letters of
other scripts and digits or signs standing for letters read as the letters, everything else a blank.
The lexicon holds word beginnings and whole words learned from labelled rows, each weighing its log
odds. Matches inside an exception phrase do not count. A logistic curve over the total weight and
the weight per word gives the score.

Learning reads at most ``SAMPLE_TOXIC`` toxic and ``SAMPLE_CLEAN`` clean labelled rows outside the
held-out share, the first by a hash of their id; scoring reads every whole text.

Defined results: null and empty texts score as texts without matches; without labelled rows of both
classes the lexicon is empty and every score is 0; repeated labels of an id count once, as toxic if
any says so; rows with a null id are scored and not held out; an empty table gives an empty one.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE_TOXIC = 4000
SAMPLE_CLEAN = 8000
MIN_SHARE = 0.005  # a term must stand in this share of the toxic sample, and in MIN_DOCS of its texts
MIN_DOCS = 4
MIN_WEIGHT = math.log(20)
STEMS = range(4, 10)  # lengths of word beginnings that can become terms
COVER = 3  # terms wanted in every toxic text; a term that helps no text to this many is left out
CUT = 0.3

# Look-alike letters and signs, and what they stand for.
LOOKALIKES = dict(zip("аеорсухіјѕԁһӏкмтвнгпԛԝαβεηικνορτυχγωʟıſøđłħ", "aeopcyxijsdhlkmtbhrnqwabenikvoptuxywlisodlh"))
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "l": "i"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i", "€": "e"}
SIGN = re.compile(r"[@$!|€](?=[^\W\d_])")

# Phrases in which a listed word is harmless (fixed values).
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "clownfish", "idiot proof", "pond scum", "sore loser", "garbage collection")


class _Table(dict):
    """str.translate table that decides each character once."""

    def __missing__(self, point: int) -> str:
        ch = chr(point)
        kind = unicodedata.category(ch)
        if ch in LOOKALIKES:
            out = DIGITS.get(LOOKALIKES[ch], LOOKALIKES[ch])
        elif ch in DIGITS:
            out = DIGITS[ch]
        elif kind in ("Mn", "Cf"):
            out = ""
        else:
            out = ch if kind[0] == "L" else " "
        self[point] = out
        return out


TABLE = _Table()


def fold(text: str | None) -> str:
    """The folded text: words of letters, one blank between them."""
    t = (text or "").lower()
    if not t.isascii():
        t = unicodedata.normalize("NFKD", t)
    t = SIGN.sub(lambda m: SIGNS[m.group()], t)
    return " ".join(t.translate(TABLE).split())


def terms_of(folded: str) -> set[str]:
    """Candidate terms: word beginnings as `` stem`` and whole words as `` word ``."""
    out = set()
    for w in set(folded.split(" ")):
        out.add(f" {w} ")
        for n in STEMS:
            if len(w) < n:
                break
            out.add(f" {w[:n]}")
    return out


@dataclass
class Lexicon:
    """Terms with weights, and the curve from matches to a score."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            found.add_word(f" {fold(phrase)} ", (len(fold(phrase)) + 2, None))
        found.make_automaton()
        return found

    def score(self, total: float, n_words: int) -> float:
        if not self.weights:
            return 0.0
        a, b, c = self.curve
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, a + b * math.log1p(total) + c * math.log1p(100 * total / max(n_words, 1))))))


def weigh(folded: str, automaton) -> tuple[float, int]:
    """Total weight of the matches outside exceptions, and the number of words."""
    hits, spared = [], []
    for end, (size, weight) in automaton.iter(f" {folded} "):
        (hits if weight is not None else spared).append((end - size + 1, end, weight))
    if spared:
        # Exceptions and matches both come in order of their ends: the nearest that ends later decides.
        spared_ends = np.array([e for _, e, _ in spared])
        starts = np.array([s for s, _, _ in spared])
        reach = np.minimum.accumulate(starts[::-1])[::-1]
        at = np.searchsorted(spared_ends, [e - 1 for _, e, _ in hits])
        hits = [h for h, i in zip(hits, at) if i == len(reach) or h[0] < reach[i]]
    best: dict[int, float] = {}
    for start, _, weight in hits:  # of the terms that start at one word the heaviest counts
        best[start] = max(weight, best.get(start, 0.0))
    return sum(best.values()), folded.count(" ") + 1 if folded else 0


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(toxic, text): distinct texts of the sampled labelled rows that are not held out."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("turn", F.xxhash64("doc_id"))
    pick = lambda toxic, n: known.filter(F.col("toxic") == toxic).orderBy("turn", "doc_id").limit(n)
    picked = pick(1, SAMPLE_TOXIC).union(pick(0, SAMPLE_CLEAN)).select(F.col("doc_id").alias("picked_id"), "toxic")
    # At most SAMPLE_TOXIC + SAMPLE_CLEAN ids: a bounded side.
    return docs.join(F.broadcast(picked), docs["doc_id"] == F.col("picked_id")).select("toxic", "text").distinct()


def learn(sample: DataFrame) -> Lexicon:
    """The lexicon and curve of a bounded sample; only term counts and folded matches leave the tasks."""

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.int32()), pa.array([fold(t) for t in batch.column("text").to_pylist()], pa.string())], names=["toxic", "folded"])

    rows = sample.mapInArrow(folded, "toxic int, folded string").filter("folded <> ''").persist()
    try:
        totals = dict(tuple(r) for r in rows.groupBy("toxic").count().collect())
        n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
        if not n_toxic or not n_clean:
            return Lexicon()
        least = max(MIN_DOCS, math.ceil(MIN_SHARE * n_toxic))
        toxic = _term_counts(rows.filter("toxic = 1")).filter(F.col("n") >= least)
        in_toxic = {r["term"]: r["n"] for r in toxic.collect()}
        in_toxic = _specific(in_toxic)
        in_clean = {r["term"]: r["n"] for r in _term_counts(rows.filter("toxic = 0"), frozenset(in_toxic)).collect()}
        odds = {
            t: math.log((n + 0.5) / (n_toxic + 1)) - math.log((in_clean.get(t, 0) + 0.5) / (n_clean + 1)) for t, n in in_toxic.items()
        }
        odds = {t: w for t, w in odds.items() if w >= MIN_WEIGHT}
        weights = _cover(rows.filter("toxic = 1"), odds, in_toxic, least)
        lexicon = Lexicon(weights)
        lexicon.curve = _curve(rows, lexicon)
        return lexicon
    finally:
        rows.unpersist()


def _term_counts(rows: DataFrame, only: frozenset[str] | None = None) -> DataFrame:
    """(term, n): in how many texts each term stands."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for t in batch.column("folded").to_pylist():
                found = terms_of(t)
                seen.update(found if only is None else found & only)
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["term", "n"])

    return rows.select("folded").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def _specific(counts: dict[str, int]) -> dict[str, int]:
    """Terms without a longer one that stands in nearly the same texts."""
    longer: dict[str, int] = {}
    for t, n in counts.items():
        for k in range(2, len(t)):
            if t[:k] in counts:
                longer[t[:k]] = max(longer.get(t[:k], 0), n)
    return {t: n for t, n in counts.items() if longer.get(t, 0) < 0.95 * n}


def _cover(toxic: DataFrame, odds: dict[str, float], counts: dict[str, int], least: int) -> dict[str, float]:
    """Terms, heaviest use first, that bring at least ``least`` texts closer to COVER terms each.

    Words that merely share texts with the true ones (in copies of one text, say) add nothing and stay out.
    """
    own = frozenset(odds)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(terms_of(t) & own) for t in batch.column("folded").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.list_(pa.string()))], names=["terms"])

    texts = [r["terms"] for r in toxic.select("folded").mapInArrow(found, "terms array<string>").collect()]
    holders: dict[str, list[int]] = {}
    for i, terms in enumerate(texts):
        for t in terms:
            holders.setdefault(t, []).append(i)
    covered = np.zeros(len(texts), dtype=np.int64)
    chosen: dict[str, float] = {}
    for t in sorted(holders, key=lambda t: (-counts[t] * min(odds[t], 8.0), t)):
        # A longer word that begins with a chosen stem is matched by it already.
        if any(t[:k] in chosen for k in range(2, len(t))):
            continue
        at = np.array(holders[t])
        if (covered[at] < COVER).sum() >= least:
            chosen[t] = odds[t]
            covered[at] += 1
    return chosen


def _curve(rows: DataFrame, lexicon: Lexicon) -> tuple[float, float, float]:
    """Logistic fit of the label to log weight and log weight per word."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            both = [weigh(t, automaton) for t in batch.column("folded").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array([w for w, _ in both], pa.float64()), pa.array([n for _, n in both], pa.int64())], names=["toxic", "total", "n"]
            )

    got = sorted(tuple(r) for r in rows.mapInArrow(measure, "toxic int, total double, n long").collect())
    y, total, n = (np.array(c, dtype=float) for c in zip(*got))
    x = np.stack([np.ones(len(y)), np.log1p(total), np.log1p(100 * total / np.maximum(n, 1))], axis=1)
    w = np.zeros(3)
    ridge = np.diag([1e-6, 1e-3, 1e-3])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) / len(y) + ridge @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge, grad)
        w -= step / max(1.0, float(np.abs(step).max()) / 2)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def score(docs: DataFrame, lexicon: Lexicon, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, weight and n_words of every row."""
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            both = [weigh(fold(t.as_py()), automaton) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([lexicon.score(w, n) for w, n in both], pa.float64()),
                 pa.array([w for w, _ in both], pa.float64()), pa.array([n for _, n in both], pa.int64())],
                names=["doc_id", "score", "weight", "n_words"],
            )

    scored = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, weight double, n_words long")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "weight", "n_words")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from ``labels`` and score every row of ``docs``."""
    narrow = docs.select("doc_id", "text")
    return score(narrow, learn(training_sample(narrow, labels.select("doc_id", "toxic"))))
