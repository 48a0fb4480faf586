import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from venueflow.operators.baseline import lookup_baseline, mean_of_means, sweep_exponents, weighted_log_means
from venueflow.operators.calendar import clear_weekend_holidays, with_recency_weights
from venueflow.plans.forecast import add_baseline_feature, baseline_forecast


@pytest.fixture()
def calendar(spark):
    # 2017-01-02 is a Monday; the 7th (Saturday) and the 9th (Monday) are holidays.
    days = [dt.date(2017, 1, 2) + dt.timedelta(days=i) for i in range(14)]
    rows = [(d, d.strftime("%A"), int(d.day in (7, 9))) for d in days]
    return spark.createDataFrame(rows, "calendar_date date, day_of_week string, holiday_flg int")


def test_weekend_holidays_are_cleared(calendar):
    flagged = clear_weekend_holidays(calendar).filter("holiday_flg = 1").collect()
    assert [r["calendar_date"].day for r in flagged] == [9]


def test_recency_weights_follow_date_order(calendar):
    rows = with_recency_weights(calendar.orderBy(F.desc("calendar_date"))).orderBy("calendar_date").collect()
    assert rows[0]["weight"] == pytest.approx((1 / 14) ** 5) and rows[-1]["weight"] == 1.0


def test_null_keys_form_no_group(spark):
    df = spark.createDataFrame([("a", None, 1.0, 3), ("a", "Monday", 1.0, 3)], "s string, d string, weight double, visitors int")
    out = weighted_log_means(df, ["s", "d"]).collect()
    assert len(out) == 1 and out[0]["wmean"] == pytest.approx(math.log(4))


def test_mean_of_means_is_unweighted(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 6.0)], "s string, wmean double")
    assert mean_of_means(df, "s").first()["wmean"] == 3.0


@pytest.fixture()
def lookup(spark):
    base = spark.createDataFrame(
        [("a", "Monday", 0, 1.0), ("a", "Monday", 1, 5.0), ("a", "Sunday", 0, 3.0)],
        "s string, d string, h int, wmean double",
    )
    rows = spark.createDataFrame(
        [(1, "a", "Monday", 1), (2, "a", "Sunday", 1), (3, "a", "Friday", 0), (4, "b", "Monday", 0), (5, "a", None, None)],
        "id int, s string, d string, h int",
    )
    return rows, base


def test_three_levels(lookup):
    out = lookup_baseline(*lookup, "s", ["d", "h"], holiday="h", level_name="level").orderBy("id").collect()
    assert [(r["wmean"], r["level"]) for r in out] == [(5.0, 1), (3.0, 2), (3.0, 3), (None, None), (3.0, 3)]


def test_one_level(lookup):
    out = lookup_baseline(*lookup, "s", ["d", "h"], holiday="h", levels=1).orderBy("id").collect()
    assert [r["wmean"] for r in out] == [5.0, None, None, None, None]
    with pytest.raises(ValueError):
        lookup_baseline(*lookup, "s", ["d", "h"], levels=4)


def test_lookup_never_multiplies_rows(lookup):
    rows, base = lookup
    assert lookup_baseline(rows.union(rows), base, "s", ["d", "h"], holiday="h").count() == 10


def test_forecast_matches_hand_computation(spark, calendar):
    first = dt.date(2017, 1, 2)
    visits = [("air_x", first, 10), ("air_x", first + dt.timedelta(days=7), 30), ("air_x", first + dt.timedelta(days=1), 5)]
    visits = spark.createDataFrame(visits, "store_id string, visit_date date, visitors int")
    targets = spark.createDataFrame([("air_x_2017-01-09",), ("air_x_2017-01-10",), ("air_x_2017-01-11",)], "id string")
    out = {r["id"]: r["visitors"] for r in baseline_forecast(visits, calendar, targets).collect()}
    monday, holiday, tuesday = math.log(11), math.log(31), math.log(6)
    assert out["air_x_2017-01-09"] == pytest.approx(30)
    assert out["air_x_2017-01-10"] == pytest.approx(5)
    assert out["air_x_2017-01-11"] == pytest.approx(math.expm1((monday + holiday + tuesday) / 3))


def test_more_recent_visits_weigh_more(spark, calendar):
    first = dt.date(2017, 1, 3)
    visits = spark.createDataFrame(
        [("air_x", first, 10), ("air_x", first + dt.timedelta(days=7), 30)], "store_id string, visit_date date, visitors int"
    )
    targets = spark.createDataFrame([("air_x_2017-01-10",)], "id string")
    by_power = [baseline_forecast(visits, calendar, targets, exponent=p).first()["visitors"] for p in (0, 1, 5)]
    assert by_power[0] == pytest.approx(math.expm1((math.log(11) + math.log(31)) / 2))
    assert by_power[0] < by_power[1] < by_power[2]


def test_leakage_safe_feature_uses_earlier_visits_only(spark, calendar):
    first = dt.date(2017, 1, 3)
    visits = spark.createDataFrame(
        [("air_x", first, 10), ("air_x", first + dt.timedelta(days=7), 30)], "store_id string, visit_date date, visitors int"
    )
    out = add_baseline_feature(visits, visits, calendar, before=first + dt.timedelta(days=7))
    assert [r["baseline_feature"] for r in out.collect()] == [pytest.approx(10), pytest.approx(10)]
    assert set(out.columns) == {"store_id", "visit_date", "visitors", "baseline_feature"}


def test_exponent_sweep_is_one_aggregation(spark, calendar):
    from conftest import plan

    names = ["w1", "w2"]
    cal = with_recency_weights(calendar, exponents=(1, 2), names=names)
    facts = cal.withColumn("s", F.lit("a")).withColumn("visitors", F.dayofmonth("calendar_date"))
    out = sweep_exponents(facts, ["s"], names)
    row = out.first()
    w = [(i + 1) / 14 for i in range(14)]
    v = [math.log1p(i + 2) for i in range(14)]
    assert row["w2"] == pytest.approx(sum(a * a * b for a, b in zip(w, v)) / sum(a * a for a in w))
    assert plan(out).count("Exchange hashpartitioning") <= 1
