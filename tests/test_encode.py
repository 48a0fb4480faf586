import pytest

from venueflow.operators import encode


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_codes_follow_sorted_labels(spark):
    names = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    df = spark.createDataFrame([(n, n) for n in names], "name string, code string")
    got = dict(rows(encode.label_encode(df, ["code"]), "name", "code"))
    assert got == {n: i for i, n in enumerate(sorted(names))}


def test_missing_label_is_the_text_nan(spark):
    df = spark.createDataFrame([("a",), (None,), ("z",)], "x string")
    codes = encode.fit_label_codes(df, ["x"])
    assert rows(codes, "label", "code") == [("a", 0), ("nan", 1), ("z", 2)]


def test_unseen_label_raises_or_is_kept(spark):
    codes = encode.fit_label_codes(spark.createDataFrame([("a",), ("b",)], "x string"), ["x"])
    other = spark.createDataFrame([("b",), ("c",)], "x string")
    with pytest.raises(Exception, match="not seen"):
        encode.apply_label_codes(other, codes, ["x"]).collect()
    assert rows(encode.apply_label_codes(other, codes, ["x"], unseen="keep"), "x") == [(1,), (2,)]
    with pytest.raises(ValueError):
        encode.apply_label_codes(other, codes, ["x"], unseen="skip")


def test_codes_number_the_sorted_labels_of_each_column(spark):
    df = spark.createDataFrame([(f"k{i % 37:02d}", f"v{i % 11}") for i in range(200)], "a string, b string")
    want = [("a", f"k{i:02d}", i) for i in range(37)]
    want += [("b", label, i) for i, label in enumerate(sorted(f"v{i}" for i in range(11)))]
    assert rows(encode.fit_label_codes(df, ["a", "b"]), "column", "label", "code") == want


def test_token_codes(spark):
    df = spark.createDataFrame([("s1", "Izakaya"), ("s2", "Bar/Cocktail"), ("s3", None)], "s string, genre string")
    out = encode.encode_tokens(df, {"genre": "/"}, 3)
    # whole: Bar Cocktail, Izakaya, nan; first word: Bar, Izakaya, nan; second: '', Cocktail
    assert rows(out, "s", "genre", "genre0", "genre1", "genre2") == [
        ("s1", 1, 1, 0, 0), ("s2", 0, 0, 1, 0), ("s3", 2, 2, 0, 0)]


def test_scaling_extrapolates_and_shifts_constants(spark):
    train = spark.createDataFrame([(0.0, 7), (10.0, 7)], "x double, c int")
    test = spark.createDataFrame([(20.0, 9)], "x double, c int")
    assert rows(encode.min_max_scale(train, test, ["x", "c"]), "x", "c") == [(2.0, 2.0)]
    assert rows(encode.min_max_scale(train, train, ["x", "c"]), "x", "c") == [(0.0, 0.0), (1.0, 0.0)]


def test_sentinel_fills_text_too(spark):
    df = spark.createDataFrame([(None, None, 1.5)], "i int, s string, d double")
    assert tuple(encode.fill_sentinel(df).first()) == (-1, "-1", 1.5)


def test_assemble_and_exclude(spark):
    df = spark.createDataFrame([("a", 1, 2.0)], "id string, x int, y double")
    cols = encode.feature_columns(df, ["id"])
    assert cols == ["x", "y"]
    assert list(encode.assemble(df, cols).first()["features"]) == [1.0, 2.0]
