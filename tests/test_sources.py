import pytest

from venueflow import session
from venueflow.sources.tables import load_catalog, read_table, write_csv


def test_round_trip_and_catalog(spark, tmp_path):
    visits = spark.createDataFrame([("air_1", "2016-01-01", 25)], "air_store_id string, visit_date string, visitors int")
    write_csv(visits, f"{tmp_path}/air_visit_data.csv")
    (tmp_path / "store_id_relation.csv").write_text("air_store_id,hpg_store_id\nair_1,hpg_1\n")
    tables = load_catalog(spark, str(tmp_path))
    assert set(tables) == {"air_visit_data", "store_id_relation"}
    assert dict(tables["air_visit_data"].dtypes) == {"air_store_id": "string", "visit_date": "date", "visitors": "int"}
    assert spark.sql("SELECT hpg_store_id FROM store_id_relation").first()[0] == "hpg_1"


def test_inferred_types(spark, tmp_path):
    (tmp_path / "x.csv").write_text("d,n\n2016-01-01,3\n")
    assert read_table(spark, f"{tmp_path}/x.csv").dtypes == [("d", "date"), ("n", "int")]


def test_fixed_decimals(spark, tmp_path):
    write_csv(spark.createDataFrame([("a", 1.0)], "id string, visitors double"), f"{tmp_path}/out", float_scale=4)
    assert read_table(spark, f"{tmp_path}/out", "id string, visitors string").first()["visitors"] == "1.0000"


def test_columns_are_found_by_name(spark, tmp_path):
    path, schema = f"{tmp_path}/t.csv", "store string, day date, visitors int"
    spark.createDataFrame([("2016-01-13", 25, "x", "a")], "day string, visitors int, extra string, store string").write.option("header", True).csv(path)
    got = read_table(spark, path, schema)
    assert got.columns == ["store", "day", "visitors"] and [str(v) for v in got.first()] == ["a", "2016-01-13", "25"]
    with pytest.raises(ValueError, match="no column holiday"):
        read_table(spark, path, "store string, holiday int")
    with pytest.raises(Exception):
        read_table(spark, path, "store int, day date").collect()


def test_missing_numbers_are_empty_fields(spark, tmp_path):
    write_csv(spark.createDataFrame([("a", None), ("b", float("nan"))], "id string, visitors double"), f"{tmp_path}/out", float_scale=4)
    assert sorted(r[0] for r in spark.read.text(f"{tmp_path}/out").collect() if r[0] != "id,visitors") == ["a,", "b,"]


def test_materialize_keeps_schema(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    back = session.materialize(df, "t")
    assert back.dtypes == df.dtypes and back.count() == 1


def test_read_missing_folder_raises(spark, tmp_path):
    with pytest.raises(Exception):
        read_table(spark, f"{tmp_path}/none.csv", "a int").count()
