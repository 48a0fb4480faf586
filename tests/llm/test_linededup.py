"""Line runs against plain Python: counts, holders, levels, and the edge cases the docstring defines."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import plan
from llm_fixtures import docs, empty  # noqa: F401
from venueflow.llm import linededup
from venueflow.llm.queries import QUERIES

UPPER = {ord(a): ord(a.lower()) for a in linededup.UPPER}


def key_of(line):
    return line.strip(linededup.BLANKS).translate(UPPER)


def brute(rows):
    """(id, lines, dropped, text left) of every row."""
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= linededup.MIN_CHARS:
                holders[key_of(line)].add(i)
    low = lambda i: (i is not None, i or 0)
    last = {k: max(ids, key=low) for k, ids in holders.items() if len(ids) >= linededup.MIN_DOCS}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key_of(x) not in last or last[key_of(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), text if len(kept) == len(lines) else "\n".join(kept)))
    return sorted(out, key=repr)


def found(df, **how):
    return sorted((tuple(r) for r in linededup.drop_repeated_lines(df, **how).select("doc_id", "n_lines", "n_dropped", "text").collect()), key=repr)


def sample(seed, n):
    r = random.Random(seed)
    lines = [f"A line that many documents share, number {i}" for i in range(12)] + ["short", "", "   ", "é" * 19, "É" * 20, "exactly twenty chars"]
    pad = lambda x: r.choice(["", " ", "\t", "\x0b"]) + (x.upper() if r.random() < 0.2 and x.isascii() else x) + r.choice(["", " ", "\r"])
    return ["\n".join(pad(r.choice(lines) if r.random() < 0.6 else f"own line {r.random():.12f}") for _ in range(r.randint(1, 15))) for _ in range(n)]


@pytest.mark.parametrize("how", [{}, {"batches": 1}, {"batches": 5, "fanout": 3}, {"batches": 3, "fanout": 10}])
def test_equals_plain_python_however_batches_are_cut(docs, how):
    texts = sample(1, 120) + [None, "", "\n", "\n\n\n"]
    assert found(docs(texts), **how) == brute(list(enumerate(texts)))


def test_repeated_and_missing_ids(docs):
    line = "this line stands in several documents"
    texts = [line, line + "\nown", line, line, line, line + "\n" + line]
    ids = [7, 7, None, None, 3, 9]
    rows = list(zip(ids, texts))
    assert found(docs(texts, ids=ids)) == brute(rows)
    two = rows[:4]  # two documents only: nothing goes
    assert all(r[2] == 0 for r in found(docs(texts[:4], ids=ids[:4]))) and brute(two) == found(docs(texts[:4], ids=ids[:4]))


def test_the_holder_keeps_every_one_of_its_lines_and_others_lose_theirs(docs):
    line = "the very same words, again and again"
    got = {r[0]: r[2:] for r in found(docs([f"{line}\nx\n{line}", line, f"a\n{line.upper()} ", f"{line}\n{line}"]))}
    assert got[3] == (0, f"{line}\n{line}") and got[0] == (2, "x") and got[1] == (1, "") and got[2] == (1, "a")


def test_equal_rows_get_equal_results(docs):
    texts = ["common line of all documents here\nmine"] * 40 + ["common line of all documents here"] * 3
    ids = [1] * 40 + [2, 3, 4]
    got = found(docs(texts, ids=ids))
    assert got == brute(list(zip(ids, texts))) and [r[3] for r in got].count("mine") == 40


def test_other_columns_pass_whatever_their_names(docs):
    df = docs(["x", None]).withColumns({"n_lines": F.lit("a"), "dropped": F.lit(1), "gone_doc": F.lit(2), "row": F.create_map(F.lit("k"), F.lit("v")), "k1": F.lit(0)})
    out = linededup.drop_repeated_lines(df)
    assert [c for c in out.columns if c not in ("n_lines", "n_dropped")] == [c for c in df.columns if c != "n_lines"]
    assert out.select("text", "row").orderBy("doc_id").collect()[0] == ("x", {"k": "v"})


def test_empty_table(empty):
    assert linededup.drop_repeated_lines(empty).collect() == []


def test_runs_are_joined_without_a_shuffle_and_levels_are_merged(spark):
    runs = linededup.Runs(spark)
    batch = lambda lo, n: spark.range(lo, lo + n).select(F.col("id").alias("doc"), (F.col("id") % 7).alias("k1"), F.lit(0).cast("long").alias("k2"))
    for i in range(3):
        runs.add(batch(100 * i, 50))
    assert [len(level) for level in runs.levels] == [1, 1]
    a, b = (spark.table(level[0][0]) for level in runs.levels)
    assert "Exchange" not in plan(a.join(b.hint("merge"), linededup.KEY, "left_anti"))
    assert sorted(map(tuple, runs.repeated().select("k1", "holder").collect())) == sorted((k, max(x for x in range(200, 250) if x % 7 == k)) for k in range(7))


def test_a_settled_line_adds_nothing_to_later_runs(spark):
    runs = linededup.Runs(spark, fanout=10)
    rows = lambda docs: spark.createDataFrame([(d, 1, 1) for d in docs], "doc long, k1 long, k2 long")
    runs.add(rows([5, 6, 9]))
    runs.add(rows([7, 8]))
    runs.add(rows([12]))
    sizes = [spark.table(name).count() for name, _ in runs.levels[0]]
    assert sizes == [1, 0, 1] and [r["holder"] for r in runs.repeated().collect()] == [12]


def test_the_query_gives_the_contract_columns(spark):
    out = QUERIES["op11_line_dedup"](spark, "/root/testdata/sf0.001")
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = sorted((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute([tuple(r) for r in rows]))
    assert sorted(map(tuple, out.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect())) == want
