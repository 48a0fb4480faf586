import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from venueflow.llm import simhash
from venueflow.llm.components import components
from llm_fixtures import docs, empty  # noqa: F401

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def check(rows, out):
    rows = sorted(rows)
    fps = [plain_fingerprint(t) for _, t in rows]
    want = {d: (f"{f:016x}", rows[r][0]) for (d, _), f, r in zip(rows, fps, plain_components(fps))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in out.collect()}
    assert got == want


def test_whole_table_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    check(rows, simhash.simhash(docs))


def test_edge_texts(docs):
    texts = [None, "", " \n", "One", "one", "one two", "A b c", "a\tB\x0bC", "é è É", "x " * 70_000, None]
    check([(i, t) for i, t in enumerate(texts)], simhash.simhash(docs(texts)))


def test_empty_table(empty):
    assert simhash.simhash(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).columns == empty.columns


def test_null_and_repeated_ids(docs):
    out = simhash.simhash(docs(["same text here now"] * 3 + ["other words entirely so"], ids=[None, 7, 7, None])).collect()
    assert sorted((r["doc_id"] is None, r["component_id"]) for r in out if r["component_id"]) == [(False, 7), (False, 7), (True, 7)]
    assert [r["component_id"] for r in out].count(None) == 1


@pytest.mark.parametrize("bucket", [4096, 4])
def test_links_connect_the_same_fingerprints_however_buckets_are_cut(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", bucket)
    rng = random.Random(5)
    centre, fps = rng.getrandbits(64), set()
    while len(fps) < 150:  # a dense cloud and strangers
        fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    fps |= {rng.getrandbits(64) for _ in range(60)} | {0}
    fps = sorted(fps)
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    out = simhash.group_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp long"))
    got = {r["node"]: r["root"] for r in out.collect()}
    groups = {}
    for f, r in zip(signed, plain_components(fps)):
        groups.setdefault(r, set()).add(f)
    mine = {}
    for f in signed:
        mine.setdefault(got.get(f, f), set()).add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("most", [4, 64])
def test_no_gathered_bucket_is_larger_than_allowed(spark, most):
    """A third share one half, another third the same half but for a bit: they go to the next cut ungathered."""
    rng = random.Random(9)
    half = rng.getrandbits(32)
    fps = {half << 32 | rng.getrandbits(32) for _ in range(300)} | {(half ^ 4) << 32 | rng.getrandbits(32) for _ in range(300)}
    fps = [int(np.uint64(f).astype(np.int64)) for f in fps | {rng.getrandbits(64) for _ in range(300)}]
    rows = spark.createDataFrame([(0, f, 0) for f in fps], "key long, fp long, off int")
    variants = simhash._variants(rows, 64, simhash._crowded(rows, 64, most)).cache()
    gathered = variants.filter("not send").groupBy("key").count().agg({"count": "max"}).first()[0]
    assert gathered <= most and variants.filter("send").count() >= 600
    assert simhash._variants(rows, 64).groupBy("key").count().agg({"count": "max"}).first()[0] >= 600


def test_a_half_shared_by_a_hundred_thousand(spark):
    near = [(1 << 40) + 5, (1 << 40) + 4, (1 << 40) + 6]
    rows = spark.range(100_000).select(((F.xxhash64("id").bitwiseAND(F.lit((1 << 32) - 1))) + F.lit(7 << 33)).alias("fp"))
    extra = spark.createDataFrame([(f,) for f in near], "fp long")
    got = {r["node"]: r["root"] for r in simhash.group_fingerprints(rows.union(extra).distinct()).collect()}
    assert {got[f] for f in near} == {near[1]}


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5), (3, 2)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(101)} | {i: 1000 for i in range(1000, 1200)}


def test_one_row_of_each_group_stays(docs):
    text = " ".join(f"word{i}" for i in range(300))
    rows = docs([text, text, text + " more", "quite another text about things", "quite another text about things"], ids=[3, 2, 9, 5, 5])
    kept = simhash.drop_near_duplicates(rows.union(rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 5] and kept.columns == rows.columns


def test_rows_with_maps_are_deduplicated(docs):
    rows = docs(["the same text here", "the same text here", "something else than that"]).withColumn("m", F.create_map(F.lit("k"), F.lit("v")))
    assert sorted(r["doc_id"] for r in simhash.drop_near_duplicates(rows).collect()) == [0, 2]
