import math
import random
import zlib

import duckdb
import pytest

from venueflow.llm import licenses, toxicity
from llm_fixtures import docs, empty  # noqa: F401

LABELS = "doc_id long, quality int, toxic int"


def test_fold_reads_disguises():
    assert toxicity.fold("1D10T ïdiot іdiоt id​iot @mor0n") == " ".join([toxicity.fold("idiot")] * 4 + [toxicity.fold("amoron")])
    assert toxicity.fold(None) == "" and toxicity.fold("### 5") == "s"


def test_held_out_accuracy_and_disguises(spark, docs):
    sf = "/root/testdata/sf0.1"
    table, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    lexicon = toxicity.learn(toxicity.training_sample(table.select("doc_id", "text"), labels))
    scored = toxicity.score(table, lexicon)
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    toxic, clean = [r["predicted"] for r in rows if r["toxic"] == 1], [r["predicted"] for r in rows if r["toxic"] == 0]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.02 * len(clean)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in scored.select("doc_id", "held_out").collect())
    texts = ["you are an idiot and a moron in the end", "you are an 1d10t and a m0r0n in the end", "уou are an іdіоt and a mоrоn", "the trash can stood in the yard", None, "", "nice words"]
    got = [r["predicted"] for r in toxicity.score(docs(texts), lexicon).orderBy("doc_id").collect()]
    assert got == [1, 1, 1, 0, 0, 0, 0]


def test_without_labels_nothing_is_toxic(spark, docs, empty):
    out = toxicity.toxicity(docs(["idiot", None]), spark.createDataFrame([(0, 1, 1), (None, 1, 1), (1, 1, None)], LABELS))
    assert [(r["score"], r["predicted"]) for r in out.collect()] == [(0.0, 0)] * 2
    assert toxicity.toxicity(empty, spark.createDataFrame([], LABELS)).count() == 0


def test_exceptions_spare_only_what_they_cover():
    found = toxicity.Lexicon({f" {toxicity.fold('trash')} ": 5.0}).automaton()
    assert toxicity.weigh(toxicity.fold("a trash can and trash"), found) == (5.0, 5)
    assert toxicity.weigh("", found) == (0.0, 0)


def test_license_texts_in_other_dress(docs, empty):
    mit = licenses.LICENSES["MIT"]
    dressed = "Copyright (c) 2020 Some One\n\n" + mit.upper().replace("SUBLICENSE", "SUB-LICENSE").replace(". ", ".\n").replace('"', "'")
    texts = [mit, dressed, mit + " And more.", "Released under the MIT Licence!\nwords\nlicensed under the apache license version 2.0", None, "", "x"]
    rows = {r["doc_id"]: (r["license"], r["notices"]) for r in licenses.scan(docs(texts).withColumnRenamed("lang", "digest")).collect()}
    assert [rows[i][0] for i in range(7)] == ["MIT", "MIT", None, None, None, None, None]
    assert rows[3][1] == "Apache-2.0,MIT" and rows[4][1] == ""
    assert licenses.scan(empty).count() == 0


def test_sql_knows_what_the_operator_knows(docs):
    heads = ("Copyright The X Authors", "Copyright the Y team. All rights reserved.\r", "Copyright: 2020 X", "(c)2020 X", "(c) Some One", "(c) you may", "Copyright law", "copyright by X", "(c) you (c) x")
    texts = [text for _, _, text in licenses.known()] + [f"{head}\n\n{licenses.LICENSES['MIT']}" for head in heads] + [None, "", "Licensed under the MIT license\r\nx"]
    table = docs(texts)
    got = sorted((r["doc_id"], r["digest"], r["license"], r["notices"]) for r in licenses.scan(table).collect())
    con = duckdb.connect()
    con.register("documents", table.select("doc_id", "text").toPandas())
    want = con.execute(f"SELECT doc_id, digest, license, notices FROM ({licenses.sql()}) ORDER BY doc_id").fetchall()
    assert got == [(i, d, n, s) for i, d, n, s in want]
    assert sum(r[2] is not None for r in got) >= len(licenses.known()) - sum(len(t) for t in licenses.NOTICES.values())


def plain_weigh(folded, weights, exceptions):
    """Every term and exception found by looking at every place of the text."""
    line = f" {folded} "
    places = lambda t: [(i, i + len(t)) for i in range(len(line)) if line.startswith(t, i)]
    spared = [p for e in exceptions for p in places(f" {toxicity.fold(e)} ")]
    best = {}
    for term, weight in weights.items():
        for a, b in places(term):
            # A word's own blanks may lie outside the phrase that spares it.
            if not any(s <= a and b <= e for s, e in spared):
                best[a] = max(weight, best.get(a, 0.0))
    return sum(best.values()), len(folded.split())


@pytest.mark.parametrize("seed", range(4))
def test_matching_against_a_plain_scan(seed):
    rng = random.Random(seed)
    vocabulary = ["trash", "can", "bag", "clown", "fish", "clownfish", "idiot", "idiotic", "proof", "pond", "scum", "a", "nice"]
    folded = [toxicity.fold(w) for w in vocabulary]
    terms = {f" {w[:n]}" for w in folded for n in range(3, 6) if len(w) >= n} | {f" {w} " for w in folded}
    weights = {t: float(rng.randint(1, 9)) for t in rng.sample(sorted(terms), 12)}
    lexicon = toxicity.Lexicon(weights)
    automaton = lexicon.automaton()
    for _ in range(300):
        text = toxicity.fold(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 12))))
        assert toxicity.weigh(text, automaton) == plain_weigh(text, weights, lexicon.exceptions), text


def test_learned_weights_against_plain_counts(spark):
    rng = random.Random(5)
    clean = [" ".join(rng.choices(["river", "walk", "table", "green", "music"], k=12)) for _ in range(200)]
    toxic = [f"{rng.choice(['gorblax', 'fnurp'])} {t} snavvle" for t in clean[:100]]
    clean += ["snavvle walk"]
    rows = [(1, t) for t in toxic] + [(0, t) for t in clean]
    lexicon = toxicity.learn(spark.createDataFrame(rows, "toxic int, text string").distinct())
    bad, good = {toxicity.fold(t) for t in toxic}, {toxicity.fold(t) for t in clean}
    assert lexicon.weights
    for term, weight in lexicon.weights.items():
        count = lambda texts: sum(term in f" {t} " for t in texts)
        odds = math.log((count(bad) + 0.5) / (len(bad) + 1)) - math.log((count(good) + 0.5) / (len(good) + 1))
        assert weight == pytest.approx(odds) and weight >= toxicity.MIN_WEIGHT
    held = lambda word: any(f" {toxicity.fold(word)} ".startswith(t) for t in lexicon.weights)
    assert held("gorblax") and held("fnurp") and held("snavvle") and not held("river") and not held("music")


def test_whole_texts_of_common_licenses_and_of_a_table(spark, docs):
    whole = {(name, text) for kind, name, text in licenses.known() if kind == "license"}
    named = ("BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0")
    assert set(named) <= {name for name, _ in whole}
    cases = sorted(whole)
    cases += [(name, "\n".join(p.replace("\n", " ") for p in text.split("\n\n"))) for name, text in cases if name == "Apache-2.0" and "APPENDIX" not in text]
    cases += [("MIT", f"{head}\n\n{licenses.LICENSES['MIT']}") for head in ("Copyright The X Authors", "Copyright: 2020 X", "(c)2020 X", "(c) Some One")]
    cases += [("Own", "You may read this."), (None, "You may not."), (None, ""), (None, None)]
    more = spark.createDataFrame([("Own", "YOU may read this"), ("Nothing", ""), ("Null", None), ("Late", licenses.LICENSES["MIT"])], "license string, text string")
    rows = licenses.scan(docs([text for _, text in cases]), more=more).orderBy("doc_id").collect()
    assert [r["license"] for r in rows] == [name for name, _ in cases]
