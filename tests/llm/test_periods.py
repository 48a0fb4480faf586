"""Periodic runs against a quadratic search in plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import docs, empty  # noqa: F401
from venueflow.llm import periods
from venueflow.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def looped(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def runs(words):
    """(start, period, length) by comparing the words with themselves, shifted by every period."""
    number = {}
    codes = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    found = []
    for q in range(1, len(words) // 4 + 1):
        edge = np.diff(np.concatenate(([0], codes[:-q] == codes[q:], [0])).astype(int))
        found += [(s, q, e - s + q) for s, e in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)) if e - s + q >= max(6, 4 * q)]
    smaller = lambda s, q, n: any(q2 < q and s2 <= s and s2 + n2 >= s + n for s2, q2, n2 in found)
    return sorted((int(s), int(q), int(n)) for s, q, n in found if not smaller(s, q, n))


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, words):
    found = runs(words)
    gone = {i for s, q, n in found for i in range(s + q, s + n)}
    s, q, n = min(found, key=lambda r: (-r[2], r[0], r[1])) if found else (None, None, None)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{n},{q}\n" for s, q, n in found)
    return (doc_id, len(found), s, n, q, None if n is None else 1000 * n // q, digest(lines), digest(kept))


def sample(seed, n):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        words = []
        while len(words) < r.choice([0, 3, 20, 150, 600]):
            phrase = [r.choice("abc") for _ in range(r.choice([1, 2, 3, 4, 6, 9, 17, 40]))]
            words += (phrase * 8)[: r.randint(1, 8 * len(phrase))]
        out.append(r.choice([" ", "\n", "\t "]).join(words))
    return out


@pytest.mark.parametrize("how", [{}, {"long_chars": 50, "core": 16, "small": 2}, {"core": 64, "small": 3}, {"long_chars": 0, "core": 32, "small": 1}])
def test_equals_the_quadratic_search_however_tiles_are_cut(docs, how):
    texts = sample(3, 150) + [None, "", " \n ", "a " * 3000, "a b " * 1500, " ".join(f"w{i % 700}" for i in range(4000))]
    got = periods.report(periods.periodic_runs(docs(texts), **how)).collect()
    assert sorted(map(tuple, got)) == [brute(i, WORD.findall(t or "")) for i, t in enumerate(texts)]


def test_tiles_cover_every_octave_with_overlap():
    codes = np.arange(20_000)
    for first, last, start, opens, closes, tile in periods.tiles_of(codes, core=64, small=3):
        assert (tile == codes[start : start + len(tile)]).all() and opens == (start == 0) and closes == (start + len(tile) == len(codes))
        assert closes or len(tile) >= (4 << last) + 64
    firsts = {x[0] for x in periods.tiles_of(codes, core=64, small=3)}
    assert firsts == {0, *range(3, 13)}  # 4 * 2^12 words fit, 4 * 2^13 do not


def test_a_match_over_the_gap_between_tiles_is_none():
    tile, q, lo, hi = periods.pieces_of([np.array([1, 2, 1, 2]), np.array([2, 1, 2, 1])], 0, 2)
    assert all(l + 1 <= h and h + p <= 4 for p, l, h in zip(q.tolist(), lo.tolist(), hi.tolist()))


def test_dropped_words_and_text(docs):
    rows = {r["doc_id"]: r for r in periods.periodic_runs(docs(["x  y z\nx y z x y z x y z end", "no phrase here"])).collect()}
    assert rows[0]["collapsed"] == "x y z end" and [tuple(r) for r in rows[0]["runs"]] == [(0, 3, 12)]
    assert rows[1]["collapsed"] is None and rows[1]["runs"] == [] and rows[1]["collapsed_sha256"] == digest("no phrase here")


def test_repeated_rows_missing_ids_and_other_columns(docs):
    texts = ["la la la la la la la", "la la la la la la la", "do re do re do re do re", None, "x"]
    df = docs(texts, ids=[1, 1, 1, None, None]).withColumns({"t1": F.lit("a"), "words": F.lit(2), "pieces": F.create_map(F.lit("k"), F.lit("v"))})
    got = periods.periodic_runs(df).collect()
    assert sorted((str(r["doc_id"]), [tuple(x) for x in r["runs"]]) for r in got) == [("1", [(0, 1, 7)]), ("1", [(0, 1, 7)]), ("1", [(0, 2, 8)]), ("None", []), ("None", [])]


def test_empty_table(empty):
    assert periods.report(periods.periodic_runs(empty)).collect() == []


def test_loops_are_those_of_the_rule(docs):
    texts = [f"w{i} a b c d e f g h i j k l m n o p" for i in range(60)] + ["", None]
    got = {r["doc_id"]: r["text"] for r in periods.with_loops(docs(texts)).collect()}
    for i, t in enumerate(texts):
        assert (got[i] or "").split() == looped(i, (t or "").split())
    assert any(got[i] != t for i, t in enumerate(texts))


def test_the_query_equals_plain_python(spark):
    out = QUERIES["op13_periodic_runs"](spark, "/root/testdata/sf0.001")
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, out.collect())) == sorted(brute(i, looped(i, WORD.findall(t or ""))) for i, t in rows)
