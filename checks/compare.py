"""Run registered queries in Spark and DuckDB and compare the results.

Usage: python -m checks.compare [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import sys
import time
import traceback

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[sorted(pdf.columns)].astype(object).where(pdf.notna(), None)
    for c in pdf.columns:
        pdf[c] = pdf[c].map(lambda v: f"{v + 0.0:.6f}" if isinstance(v, float) else str(v)[:10] if hasattr(v, "year") else str(v))
    return pdf.sort_values(list(pdf.columns)).reset_index(drop=True)


def compare(spark_df, rel) -> str:
    got = spark_df.toPandas()
    cur = rel
    want = cur.df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} vs {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    types = dict(spark_df.dtypes)
    kinds = {d[0]: str(d[1]).lower() for d in cur.description}
    same = {"bigint": "bigint", "integer": "int", "varchar": "string", "double": "double", "date": "date",
            "boolean": "boolean", "timestamp": "timestamp_ntz", "float": "float"}
    bad_types = {c: (types[c], kinds[c]) for c in types if same.get(kinds[c], kinds[c]) != types[c]}
    a, b = normal(got), normal(want)
    if not a.equals(b):
        diff = (a != b).any(axis=1)
        return f"values differ in {int(diff.sum())} of {len(a)} rows\n{a[diff].head(4)}\n{b[diff].head(4)}"
    if bad_types:
        return f"types differ {bad_types}"
    return f"ok ({len(got)} rows)"


def main(argv: list[str]) -> int:
    from checks.all_queries import QUERIES, SQL

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    prefixes = tuple(argv[1:])
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failures = 0
    for name, fn in QUERIES.items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in SQL:
                result = compare(df, con.execute(SQL[name]))
            else:
                result = f"ok (rows only, {len(df.toPandas())} rows)"
        except Exception as e:  # report and go on with the next query
            result = f"error {type(e).__name__}: {str(e)[:1500]}"
            if "-v" in prefixes:
                traceback.print_exc()
        failures += not result.startswith("ok")
        print(f"{name:36s} {time.time() - start:6.2f}s  {result}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1:])))
