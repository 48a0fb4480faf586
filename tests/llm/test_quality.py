from collections import Counter

from pyspark.sql import functions as F

from checks.compare import compare, duck
from venueflow.llm import quality
from venueflow.llm.common import SPACE
from venueflow.llm.queries import QUERIES, SQL

import re

import pytest
from llm_fixtures import docs, empty  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    result = compare(QUERIES[name](spark, SF), duck(SF).execute(SQL[name]))
    assert result.startswith("ok"), result


def plain(text):
    w = [x for x in re.split(SPACE, text or "") if x]
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_counts_of_edge_texts(docs):
    texts = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a a a a a", "x\ny\nx\n x\n\n", "é😀 #*$%&|<>", "a b " * 20_000, "one word"]
    got = {r["doc_id"]: tuple(r[c] for c in quality.COUNTS) for r in quality.quality(docs(texts)).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_rules_name_what_they_reject(docs):
    good = "the cat and the dog of a house sat in the sun, as it was warm. " * 1
    words = " ".join(f"word{i} of the" for i in range(40))
    texts = [words, words.replace(" of the", "### $$$"), good, words + "\n" + "same line\n" * 5, " ".join("x" * 30 + str(i) for i in range(90))]
    rows = {r["doc_id"]: (r["base_failed"], list(r["broken"]), r["kept"]) for r in quality.quality(docs(texts)).collect()}
    assert rows[0] == (False, [], True)
    assert "symbols" in rows[1][1] and not rows[1][2]
    assert rows[2][0] and not rows[2][2]
    assert rows[3][1] == ["repeated_lines"]
    assert "word_length" in rows[4][1] and "stop_words" in rows[4][1]


def test_filter_keeps_columns_that_share_names_with_measures(docs):
    words = " ".join(f"word{i} of the" for i in range(40))
    rows = docs([words, "short", None]).withColumnRenamed("lang", "n_words").withColumnRenamed("n_chars", "h").withColumnRenamed("source", "whole")
    out = quality.filter_quality(rows)
    assert out.columns == rows.columns and [r["doc_id"] for r in out.collect()] == [0]


def test_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    judged = quality.quality(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    lost = judged.filter("quality = 1 AND NOT base_failed AND NOT kept").count()
    assert lost == 0 and judged.filter("quality = 0 AND NOT kept").count() >= 0.9 * judged.filter("quality = 0").count()


def test_no_python_in_the_plan_and_empty_table(empty):
    out = quality.quality(empty)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 0 and "Python" not in plan and "Arrow" not in plan


def test_length_alone_breaks_no_rule(spark):
    m = {"n_words": 2_000_000, "mean_word_chars": 5.0, "symbol_ratio": 0.0, "stop_ratio": 0.3, "foreign_ratio": 0.0, "dup_line_ratio": 0.0, "ellipsis_line_ratio": 0.0, "bullet_line_ratio": 0.0}
    row = spark.createDataFrame([m]).withColumn("m", F.struct("*"))
    assert row.select(quality.broken(F.col("m")).alias("b")).first()["b"] == []


def test_prose_of_other_languages_and_scripts_stays(docs):
    numbers = [f"{i}" for i in range(60)]
    prose = {
        "ru": "сегодня утром {} мы пошли вдоль реки и увидели старый мост",
        "el": "σήμερα το πρωί {} περπατήσαμε δίπλα στο ποτάμι",
        "hi": "आज सुबह {} हम नदी के किनारे चले",
        "zh": "今天早上第{}次我们沿着河边走到那座古老的大桥旁边看风景 ",
        "pl": "dzisiaj rano {} nie poszliśmy na spacer, który jest długi",
        "tr": "bu sabah {} nehir boyunca bir yürüyüş ve gezinti yaptık",
        "fi": "tänään aamulla {} joki oli kaunis ja silta ei näkynyt",
        "it": "questa mattina {} il fiume non era lontano e per fortuna",
    }
    # A number after every second word keeps the windows of three words from repeating.
    numbered = lambda line, n: " ".join(w + (f" {n}" if i % 2 else "") for i, w in enumerate(line.format(n).split()))
    texts = [" ".join(numbered(line, n) for n in numbers) for line in prose.values()]
    junk = " ".join(f"qzx{i} vbn{i} wrt{i}" for i in range(60))
    rows = {r["doc_id"]: (list(r["broken"]), r["kept"]) for r in quality.quality(docs([*texts, junk, "# " * 200])).collect()}
    assert all(rows[i] == ([], True) for i in range(len(texts))), rows
    assert rows[len(texts)] == (["stop_words"], False) and not rows[len(texts) + 1][1]
