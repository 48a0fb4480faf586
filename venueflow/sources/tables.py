"""CSV sources and sinks, and the directory catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venueflow.functions.columns import format_floats

# Columns of the input tables.
SCHEMAS: dict[str, str] = {
    "air_visit_data": "air_store_id string, visit_date date, visitors int",
    "air_store_info": "air_store_id string, air_genre_name string, air_area_name string,"
    " latitude double, longitude double",
    "hpg_store_info": "hpg_store_id string, hpg_genre_name string, hpg_area_name string,"
    " latitude double, longitude double",
    "air_reserve": "air_store_id string, visit_datetime timestamp, reserve_datetime timestamp,"
    " reserve_visitors int",
    "hpg_reserve": "hpg_store_id string, visit_datetime timestamp, reserve_datetime timestamp,"
    " reserve_visitors int",
    "store_id_relation": "air_store_id string, hpg_store_id string",
    "date_info": "calendar_date date, day_of_week string, holiday_flg int",
    "sample_submission": "id string, visitors double",
}


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read CSV with a header. Give a schema at scale: inferring one costs a pass over the data.

    Columns of the schema are found by their names in the header, whatever their order, and come
    back in the schema's order. A missing column, a file with another header and a value that does
    not parse fail.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = reader.csv(path).columns
    if missing := [f.name for f in wanted if f.name not in names]:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    kinds = {f.name: f for f in wanted}
    whole = T.StructType([kinds.get(n, T.StructField(n, T.StringType())) for n in names])
    return reader.schema(whole).option("enforceSchema", False).option("mode", "FAILFAST").csv(path).select(wanted.names)


def load_catalog(
    spark: SparkSession, folder: str, schemas: dict[str, T.StructType | str] | None = None
) -> dict[str, DataFrame]:
    """Read every ``<name>.csv`` file or folder under ``folder`` and register it as view ``<name>``.

    The listing goes through Spark's file sources, so it works on any file system Spark reads.
    """
    schemas = SCHEMAS if schemas is None else schemas
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(
            F.regexp_extract("path", r"^(.*?/([^/.]+)\.csv)(/|$)", 1).alias("path"),
            F.regexp_extract("path", r"^(.*?/([^/.]+)\.csv)(/|$)", 2).alias("name"),
        )
        .filter(F.col("name") != "")
        .distinct()
    )
    # One row per table name, not per data row.
    tables = {r["name"]: read_table(spark, r["path"], schemas.get(r["name"])) for r in listing.collect()}
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return tables


def write_csv(df: DataFrame, path: str, float_scale: int | None = None, mode: str = "errorifexists") -> None:
    """Write CSV with a header and no index; optionally print floats with fixed decimals."""
    if float_scale is not None:
        df = df.select(*format_floats(df.schema, float_scale))
    df.write.mode(mode).option("header", True).csv(path)


# Input column names and the names the plans use.
RENAMES: dict[str, dict[str, str]] = {
    "air_visit_data": {"air_store_id": "store_id"},
    "air_store_info": {"air_store_id": "store_id", "air_genre_name": "genre_name", "air_area_name": "area_name"},
    "air_reserve": {"air_store_id": "store_id"},
    "hpg_reserve": {"hpg_store_id": "partner_id"},
    "store_id_relation": {"air_store_id": "store_id", "hpg_store_id": "partner_id"},
}
# Argument of the plans per input table.
ROLES = {
    "air_visit_data": "visits",
    "air_store_info": "stores",
    "date_info": "calendar",
    "sample_submission": "targets",
    "air_reserve": "reservations_a",
    "hpg_reserve": "reservations_b",
    "store_id_relation": "relation",
}


def load_inputs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The CSV tables of a folder under the argument and column names of the plans."""
    tables = load_catalog(spark, folder)
    return {
        role: tables[name].withColumnsRenamed(RENAMES.get(name, {})) for name, role in ROLES.items() if name in tables
    }
