"""The baseline from strictly earlier dates, against a plain loop over the visits."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan
from venueflow.plans.forecast import add_prior_baseline

START = dt.date(2020, 1, 1)
DAYS = 90


@pytest.fixture(scope="module")
def calendar(spark):
    days = [START + dt.timedelta(i) for i in range(DAYS)]
    return spark.createDataFrame([(d, d.strftime("%A"), int(d.day in (1, 10, 11, 12, 20))) for d in days], "calendar_date date, day_of_week string, holiday_flg int")


def random_visits(seed=1, n=400):
    r = random.Random(seed)
    rows = [(r.choice("abc"), START + dt.timedelta(r.randrange(DAYS - 10)), r.randrange(1, 60)) for _ in range(n)]
    return rows + [("d", START + dt.timedelta(40), 5)] * 50  # many visits of one day


def contexts(context):
    out = {}
    for i in range(DAYS):
        d = START + dt.timedelta(i)
        flag = int(d.day in (1, 10, 11, 12, 20) and d.weekday() < 5)
        parts = {"day_of_week": d.strftime("%A"), "holiday_flg": flag, "month": d.month}
        bare = {**parts, "holiday_flg": 0}
        out[d] = (tuple(parts[c] for c in context), tuple(bare[c] for c in context), ((i + 1) / DAYS) ** 5)
    return out


def brute(visits, entity, day, context):
    days = contexts(context)
    if entity is None or day not in days:
        return None, None
    sums = {}
    for e, d, v in visits:
        if e == entity and d < day:
            own, _, w = days[d]
            s = sums.setdefault(own, [0.0, 0.0])
            s[0] += w * math.log1p(v)
            s[1] += w
    means = {k: a / b for k, (a, b) in sums.items()}
    own, bare, _ = days[day]
    steps = [means.get(own), means.get(bare), sum(means.values()) / len(means) if means else None]
    for i, s in enumerate(steps, start=1):
        if s is not None:
            return math.expm1(s), i
    return None, None


@pytest.mark.parametrize("context", [("day_of_week", "holiday_flg"), ("month", "day_of_week", "holiday_flg")])
def test_equals_a_loop_over_earlier_visits(spark, calendar, context):
    visits = random_visits()
    asked = [(e, START + dt.timedelta(i)) for e in ("a", "b", "c", "d", "nobody", None) for i in range(0, DAYS + 5, 3)]
    df = spark.createDataFrame(visits, "store_id string, visit_date date, visitors int")
    rows = spark.createDataFrame(asked, "store_id string, visit_date date").withColumn("_v", F.lit("kept"))
    out = add_prior_baseline(rows, df, calendar, context=context, level_name="level")
    assert out.columns == ["store_id", "visit_date", "_v", "prior_baseline", "level"]
    got = {(r["store_id"], r["visit_date"]): (r["prior_baseline"], r["level"]) for r in out.collect()}
    assert len(got) == len(asked)
    for e, d in asked:
        want = brute(visits, e, d, context)
        assert got[e, d][1] == want[1] and got[e, d][0] == (None if want[0] is None else pytest.approx(want[0]))
    assert {w[1] for w in got.values()} == {None, 1, 2, 3}


def test_own_and_later_visits_do_not_leak(spark, calendar):
    visits = random_visits(2)
    day = START + dt.timedelta(30)
    changed = [(e, d, v * 7 if d >= day else v) for e, d, v in visits]
    schema = "store_id string, visit_date date, visitors int"
    rows = spark.createDataFrame([(e, day) for e in "abc"], "store_id string, visit_date date")
    first, second = (sorted(map(tuple, add_prior_baseline(rows, spark.createDataFrame(v, schema), calendar).collect())) for v in (visits, changed))
    assert first == second and all(r[2] is not None for r in first)


def test_fewer_levels_and_no_visits(spark, calendar):
    empty = spark.createDataFrame([], "store_id string, visit_date date, visitors int")
    rows = spark.createDataFrame([("a", START)], "store_id string, visit_date date")
    assert add_prior_baseline(rows, empty, calendar).first()["prior_baseline"] is None
    with pytest.raises(ValueError):
        add_prior_baseline(rows, empty, calendar, levels=4)


def test_one_window_serves_all_dates(spark, calendar):
    visits = spark.createDataFrame(random_visits(), "store_id string, visit_date date, visitors int")
    text = plan(add_prior_baseline(visits, visits, calendar))
    assert sum("_entity" in line for line in text.splitlines() if "Window [" in line) == 1  # the others number the calendar
