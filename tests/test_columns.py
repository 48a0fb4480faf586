import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from venueflow.functions import columns as C


def one(spark, ddl, row, *cols):
    return tuple(spark.createDataFrame([row], ddl).select(*cols).first())


def test_weekday_starts_on_monday(spark):
    rows = spark.createDataFrame([(dt.date(2017, 4, 24 + i),) for i in range(7)], "d date")
    assert [r[0] for r in rows.orderBy("d").select(C.weekday("d")).collect()] == list(range(7))


def test_ids_split_and_join(spark):
    row = one(spark, "id string", ("air_00a9_2017-04-23",), C.split_entity("id"), C.split_date("id"),
              C.make_id(C.split_entity("id"), C.split_date("id")))
    assert row == ("air_00a9", dt.date(2017, 4, 23), "air_00a9_2017-04-23")


def test_tokens_past_the_end_are_empty_and_missing_text_is_literal(spark):
    words = C.separate_words("x", "/")
    assert one(spark, "x string", ("a/b",), C.token(words, 0), C.token(words, 1), C.token(words, 9)) == ("a", "b", "")
    assert one(spark, "x string", (None,), C.token(words, 0)) == ("nan",)


def test_lead_days_ignores_time_of_day(spark):
    row = (dt.datetime(2017, 1, 3, 1), dt.datetime(2017, 1, 1, 23))
    assert one(spark, "v timestamp, r timestamp", row, C.lead_days("v", "r")) == (2,)


def test_date_int(spark):
    assert one(spark, "d date", (dt.date(2016, 3, 7),), C.date_int("d")) == (20160307,)


@pytest.mark.parametrize("value,expected", [(-3.0, 0.0), (9.0, 6.8), (2.0, 2.0), (None, None)])
def test_clip_keeps_missing(spark, value, expected):
    assert one(spark, "x double", (value,), C.clip("x", 0, 6.8)) == (expected,)


def test_clip_keeps_nan_below_upper_bound_only(spark):
    assert math.isnan(one(spark, "x double", (float("nan"),), C.clip("x", lower=0))[0])


def test_weighted_mean_counts_the_weight_of_missing_values(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, None)], "w double, v double")
    assert df.agg(C.weighted_mean("v", "w")).first()[0] == 2.0


def test_weighted_mean_without_weight_is_null(spark):
    df = spark.createDataFrame([(0.0, 4.0)], "w double, v double")
    assert df.agg(C.weighted_mean("v", "w")).first()[0] is None


def test_blend_of_equal_inputs_is_identity(spark):
    assert one(spark, "x double", (3.25,), C.blend(["x", "x"], [0.4, 0.6])) == (3.25,)
    with pytest.raises(ValueError):
        C.blend(["x"], [0.5, 0.5])


def test_parse_timestamp(spark):
    assert one(spark, "x string", ("2016-01-01 19:00:00",), C.day(C.parse_timestamp("x"))) == (dt.date(2016, 1, 1),)


def test_format_floats(spark):
    df = spark.createDataFrame([("a", 1.23456)], "k string, x double")
    assert tuple(df.select(*C.format_floats(df.schema, 4)).first()) == ("a", "1.2346")


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "a double, b double")
    assert df.agg(C.rmse("a", "b")).first()[0] == pytest.approx(math.sqrt(0.5))
    assert df.agg(F.count("a")).first()[0] == 2


def test_clip_keeps_nan_and_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (9.0,), (-1.0,)], "x double")
    got = [r[0] for r in df.select(C.clip("x", 0, 6.8)).collect()]
    assert got[0] != got[0] and got[1:] == [None, 6.8, 0.0]


def test_id_of_a_missing_part_is_missing(spark):
    df = spark.createDataFrame([("a", "2016-01-02"), (None, "2016-01-02"), ("a", None)], "s string, d string")
    assert [r[0] for r in df.select(C.make_id("s", "d")).collect()] == ["a_2016-01-02", None, None]
