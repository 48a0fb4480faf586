import datetime as dt
import random
import statistics

import pytest
from conftest import plan
from pyspark.sql import functions as F

from venueflow.operators import profiles


def test_profile_values_and_counting(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 4), ("a", 9), ("a", None)], "k string, visitors int")
    r = profiles.profile(df, ["k"]).first()
    assert (r["min_visitors"], r["mean_visitors"], r["median_visitors"], r["max_visitors"]) == (1, 4.0, 3.0, 9)
    assert r["count_observations"] == 4
    assert profiles.profile(df, ["k"], count_nulls=True).first()["count_observations"] == 5


def test_profile_is_one_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("visitors"))
    assert plan(profiles.profile(df, ["k"])).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("seed", range(3))
def test_bracketed_median_is_exact(spark, seed):
    rng = random.Random(seed)
    groups = {"hot": 4001, "even": 100, "pair": 2, "one": 1, "three": 3}
    rows = [(g, rng.choice([rng.gauss(0, 1), 0.25])) for g, n in groups.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r["m"] for r in profiles.bracketed_median(df, ["k"], "v", "m", accuracy=100).collect()}
    for g in groups:
        assert got[g] == pytest.approx(statistics.median(v for k, v in rows if k == g)), g


def test_profile_medians_agree(spark):
    rows = [("a", i * i % 97) for i in range(60)] + [("b", 5), ("c", None)]
    df = spark.createDataFrame(rows, "k string, visitors int")
    exact = {r["k"]: r["median_visitors"] for r in profiles.profile(df, ["k"]).collect()}
    again = {r["k"]: r["median_visitors"] for r in profiles.profile(df, ["k"], median="bracketed").collect()}
    assert exact == again


def bookings(spark, rows, key="store_id"):
    return spark.createDataFrame(
        rows, f"{key} string, visit_datetime timestamp, reserve_datetime timestamp, reserve_visitors int"
    )


def at(day, hour=0):
    return dt.datetime(2017, 1, day, hour)


def test_only_earlier_week_reservations_count(spark):
    # Visits on Wednesday 2017-01-11 (weekday 2): 2 days ahead is the same week, 3 days is not.
    df = bookings(spark, [("a", at(11, 19), at(9, 23), 4), ("a", at(11, 18), at(8, 1), 6)])
    r = profiles.reservation_features(df).first()
    assert (r["rs1"], r["rv1"], r["rs2"], r["rv2"]) == (3, 6, 3.0, 6.0)
    assert profiles.reservation_features(df, far_only=False).first()["rv1"] == 10


def test_paired_features_keep_missing_sides_missing(spark):
    a = bookings(spark, [("a", at(11), at(1), 4), ("a", at(12), at(1), 1)])
    b = bookings(spark, [("p", at(11), at(2), 2)], "partner_id")
    unmapped = bookings(spark, [("q", at(11), at(2), 50)], "partner_id")
    relation = spark.createDataFrame([("a", "p")], "store_id string, partner_id string")
    own = profiles.translate_partner_ids(b.union(unmapped), relation)
    out = profiles.reservation_totals(profiles.paired_reservation_features(a, own)).orderBy("visit_date").collect()
    assert [(r["rv1_a"], r["rv1_b"], r["total_reserv_sum"]) for r in out] == [(4, 2, 6), (1, None, None)]
    assert out[0]["total_reserv_dt_diff_mean"] == 9.5


def test_grid_and_membership(spark):
    targets = spark.createDataFrame([("a",), ("b",), ("a",)], "store_id string")
    grid = profiles.entity_weekday_grid(targets)
    assert grid.count() == 14 and {r["dow"] for r in grid.collect()} == set(range(7))
    facts = spark.createDataFrame([("a", 1), ("c", 2)], "store_id string, x int")
    known = profiles.only_known(facts, targets, "store_id")
    assert [r["x"] for r in known.collect()] == [1] and "LeftSemi" in plan(known)


def test_distance_to_max_is_per_frame(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 2.0)], "lat double, lon double")
    got = profiles.distance_to_max(df, {"lat": "a", "lon": "b"}).orderBy("lat").collect()
    assert [(r["a"], r["b"]) for r in got] == [(2.0, 0.0), (0.0, 3.0)]


def test_share_and_active(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("b", 0)], "store_id string, x int")
    assert sorted(r["x"] for r in profiles.share_of_total(df, "x").collect()) == [0.0, 0.25, 0.75]
    assert profiles.active_entities(df, ["x"]).filter("x = 3").first()["n_entities"] == 1


def test_missing_keys_are_left_out_of_every_profile(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 2.0)], "k string, visitors double")
    rows = [sorted(tuple(r) for r in profiles.profile(df, ["k"], median=m).collect()) for m in ("exact", "bracketed")]
    assert rows[0] == rows[1] == [("a", 1.0, 2.0, 2.0, 3.0, 2)]


def test_profiles_of_all_grains_from_one_scan(spark, tmp_path):
    rows = [("a", 1, 1, 5), ("a", 1, 1, 8), ("a", 2, 1, None), ("b", 1, 1, 7), ("b", None, 2, 4), (None, 1, 2, 3), ("c", 1, 1, 100)]
    path = str(tmp_path / "visits")
    spark.createDataFrame(rows, "store_id string, dow int, month int, visitors int").write.parquet(path)
    visits = spark.read.parquet(path)
    side = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", None)], "store_id string, area_name string")
    grains = {"store": ["store_id", "dow"], "area": ["area_name", "dow"], "month": ["area_name", "month"]}
    for count_nulls in (False, True):
        merged = profiles.profiles_at(visits, grains, side=side, count_nulls=count_nulls)
        assert merged._jdf.queryExecution().optimizedPlan().toString().count("Relation [store_id") == 1
        for grain, keys in grains.items():
            got = profiles.at_grain(merged, grain, keys, prefix="p_")
            want = profiles.profile(visits.join(side, "store_id", "left"), keys, prefix="p_", count_nulls=count_nulls)
            assert got.columns == want.columns
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), grain
