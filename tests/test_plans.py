import datetime as dt
import math
import re

import pytest
from pyspark.sql import functions as F

from conftest import plan
from venueflow import session
from venueflow.operators import models, profiles
from venueflow.plans import ensemble, runs
from venueflow.plans.features import feature_frames, model_columns
from venueflow.session import materialize
from venueflow.sources.tables import read_table, write_csv

MONDAY = dt.date(2017, 1, 2)


def day(n):
    return MONDAY + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def tables(spark):
    """Stores a and b are predicted, c only has history, n has none."""
    visits = [(s, day(i), 10 * k + i % 7) for k, s in enumerate(("st_a", "st_b", "st_c"), 1) for i in range(42) if (i + k) % 5]
    calendar = [(day(i), day(i).strftime("%A"), int(i % 10 == 0)) for i in range(50)]
    stores = [("st_a", "Bar/Cocktail", "X-North", 1.0, 2.0), ("st_b", None, "Y", 3.0, 1.0), ("st_c", "Cafe", "Z", 99.0, 99.0),
              ("st_n", "Cafe", "Z", 0.0, 0.0)]
    book = "visit_datetime timestamp, reserve_datetime timestamp, reserve_visitors int"
    at = lambda i: dt.datetime.combine(day(i), dt.time(19))
    return dict(
        visits=spark.createDataFrame(visits, "store_id string, visit_date date, visitors int"),
        stores=spark.createDataFrame(stores, "store_id string, genre_name string, area_name string, latitude double, longitude double"),
        calendar=spark.createDataFrame(calendar, "calendar_date date, day_of_week string, holiday_flg int"),
        reservations_a=spark.createDataFrame([("st_a", at(20), at(3), 4), ("st_a", at(43), at(3), 5)], f"store_id string, {book}"),
        reservations_b=spark.createDataFrame([("p_a", at(20), at(10), 2)], f"partner_id string, {book}"),
        relation=spark.createDataFrame([("st_a", "p_a")], "store_id string, partner_id string"),
    )


def targets(spark, *stores):
    return spark.createDataFrame([(f"{s}_{day(i)}", 0.0) for s in stores for i in range(42, 49)], "id string, visitors double")


def frames(spark, tables, *stores, **options):
    return feature_frames(targets=targets(spark, *stores), tokens=2, **tables, **options)


def test_inner_keeps_predicted_stores_only(spark, tables):
    train, test = frames(spark, tables, "st_a", "st_b")
    assert {r["store_id"] for r in train.select("store_id").distinct().collect()} == {"st_a", "st_b"}
    assert test.count() == 14 and "visitors" not in test.columns
    row = train.filter((F.col("store_id") == "st_a") & (F.col("visit_date") == F.lit(day(20)))).first()
    assert (row["rv1_a"], row["rv1_b"], row["total_reserv_sum"], row["total_reserv_mean"]) == (4, 2, 6, 3.0)
    assert (row["rs1_a"], row["rs1_b"], row["store_code"], row["var_max_lat"], row["lon_plus_lat"]) == (17, 10, 0, 2.0, 3.0)
    assert (row["genre_name"], row["genre_name0"], row["genre_name1"]) == (0, 0, 1)
    assert row["id"] == f"st_a_{day(20)}" and row["date_int"] == int(day(20).strftime("%Y%m%d"))
    other = train.filter(F.col("store_id") == "st_b").first()
    assert (other["rv1_a"], other["total_reserv_sum"], other["genre_name1"], other["store_code"]) == (-1, -1, 0, 1)


def test_profile_columns_match_the_weekday(spark, tables):
    train, test = frames(spark, tables, "st_a", "st_b")
    # Weekday values of a store are constant by construction.
    wrong = train.filter("min_visitors <> visitors OR max_visitors <> visitors OR median_visitors <> visitors")
    assert wrong.count() == 0 and test.filter("count_observations < 1").count() == 0


def test_left_keeps_all_history(spark, tables):
    train, _ = frames(spark, tables, "st_a", "st_b", how="left")
    c = train.filter("store_id = 'st_c'").first()
    assert (c["latitude"], c["min_visitors"], c["genre_name"], c["store_code"], c["var_max_lat"]) == (-1.0, -1, -1, 2, -1.0)
    assert train.count() == tables["visits"].count()


def test_store_without_history(spark, tables):
    train, test = frames(spark, tables, "st_a", "st_n")
    with pytest.raises(Exception, match="without history"):
        test.collect()
    _, kept = frames(spark, tables, "st_a", "st_n", unseen="keep")
    codes = {r["store_id"]: (r["store_code"], r["min_visitors"]) for r in kept.collect()}
    assert codes["st_n"] == (1, -1) and codes["st_a"][0] == 0


@pytest.mark.parametrize("grouped,keys", [("weekday", ["area_name", "dow"]), ("month", ["area_name", "month", "dow"])])
def test_grouped_profiles(spark, tables, grouped, keys):
    train, test = frames(spark, tables, "st_a", "st_b", grouped=grouped)
    want = train.groupBy(*keys).agg(F.max("visitors").alias("m"), F.count("visitors").alias("n"))
    joined = train.join(want, keys)
    assert joined.filter("m <> area_max_visitors OR n <> area_count_observations").count() == 0
    assert "genre_median_visitors" in test.columns


def test_ensemble_and_final_mix(spark, tables):
    train, test = (materialize(f, "frame") for f in frames(spark, tables, "st_a", "st_b"))
    columns = model_columns(train)
    assert not {"id", "store_id", "visit_date", "visitors"} & set(columns)
    members = [
        ensemble.spark_ml("line", 0.5, models.linear()),
        ensemble.neighbours("near", 0.3, 4),
        ensemble.factor("factors", 0.2, ["store_code", "dow"], factors=2, sweeps=1),
    ]
    out = ensemble.fit_and_predict(train, test, columns, members)
    assert out.count() == 14 and out.filter("visitors IS NULL OR visitors < 0").count() == 0
    row = out.first()
    mix = 0.5 * row["line"] + 0.3 * row["near"] + 0.2 * row["factors"]
    assert row["visitors"] == pytest.approx(max(0.0, math.expm1(mix)))
    baseline = out.select("id", F.when(F.col("store_id") == "st_a", 20.0).alias("visitors"))
    final = {r["id"]: r["visitors"] for r in ensemble.final_forecast(out, baseline).collect()}
    model = {r["id"]: r["visitors"] for r in out.collect()}
    for key, value in final.items():
        expected = 0.7 * model[key] + 0.3 * 1.1 * 20 if key.startswith("st_a") else model[key]
        assert value == pytest.approx(expected)


def test_holdout_report(spark, tables):
    train, _ = frames(spark, tables, "st_a", "st_b")
    train = materialize(train, "frame")
    report = ensemble.holdout_report(train, model_columns(train), [ensemble.spark_ml("line", 1.0, models.linear())], 0.2)
    rows = {r["model"]: (r["n_rows"], r["rmse"]) for r in report.collect()}
    assert rows["line"][0] == int(train.count() * 0.2) and rows["line"][1] == pytest.approx(rows["blend"][1])


@pytest.fixture(scope="module")
def csv_folder(spark, tables, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("inputs"))
    own = {"store_id": "air_store_id", "partner_id": "hpg_store_id", "genre_name": "air_genre_name", "area_name": "air_area_name"}
    names = dict(visits="air_visit_data", stores="air_store_info", calendar="date_info", reservations_a="air_reserve",
                 reservations_b="hpg_reserve", relation="store_id_relation")
    for role, name in names.items():
        write_csv(tables[role].withColumnsRenamed(own), f"{folder}/{name}.csv")
    write_csv(targets(spark, "st_a", "st_b"), f"{folder}/sample_submission.csv")
    return folder


def test_baseline_run(spark, csv_folder, tmp_path):
    runs.baseline_run(spark, csv_folder, f"{tmp_path}/out")
    out = read_table(spark, f"{tmp_path}/out", "id string, visitors string").collect()
    assert len(out) == 14 and all(len(r["visitors"].split(".")[1]) == 4 for r in out)


@pytest.mark.parametrize("options", [{}, {"final": "mix", "how": "left"}, {"final": "half", "far_only": False, "baseline_feature": True}],
                         ids=["null_aware", "mix", "half"])
def test_ensemble_run(spark, csv_folder, tmp_path, options):
    members = [ensemble.spark_ml("line", 0.5, models.linear()), ensemble.neighbours("near", 0.5, 4)]
    runs.ensemble_run(spark, csv_folder, f"{tmp_path}/out", members, **options)
    out = read_table(spark, f"{tmp_path}/out", "id string, visitors double")
    assert out.count() == 14 and out.filter("visitors IS NULL OR visitors < 0").count() == 0


def test_default_members_are_a_convex_blend(spark):
    assert sum(m.weight for m in runs.default_members()) == pytest.approx(1.0)


def test_what_is_joined_has_a_row_per_store_and_large_sides_are_not_broadcast(spark, tables, monkeypatch):
    """Targets hold 39 dates a store; as one side of a join they grew beyond the driver's memory."""
    seen = []
    plain = profiles.only_known
    monkeypatch.setattr(profiles, "only_known", lambda df, keys, key: seen.append(keys.count()) or plain(df, keys, key))
    before = [sorted(map(str, f.collect())) for f in frames(spark, tables, "st_a", "st_b", grouped="month")]
    assert seen == [2, 2]
    monkeypatch.setattr(session, "BROADCAST_ROWS", 1)
    small = frames(spark, tables, "st_a", "st_b", grouped="month")
    assert [sorted(map(str, f.collect())) for f in small] == before
    # Stores, bookings and the two group profiles; what is left to broadcast is the calendar.
    joins = re.findall(r"(SortMergeJoin|BroadcastHashJoin) \[(\w+?)#", plan(small[0]))
    assert {key for kind, key in joins if kind == "BroadcastHashJoin"} <= {"visit_date"}
    assert {key for kind, key in joins if kind == "SortMergeJoin"} >= {"store_id", "area_name", "genre_name"}
