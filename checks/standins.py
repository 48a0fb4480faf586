"""Stand-in input tables derived from the given parquet tables, in Spark and in SQL.

| table          | built from                                                                  |
| visits         | lineitem summed per (supplier, ship date)                                    |
| stores         | supplier with nation, region and the part of the same key                    |
| reservations_a | lineitem with its order, not returned, shipped on or after the order date    |
| reservations_b | the same for returned lines, keyed by a partner id                           |
| relation       | store id to partner id for suppliers with a positive balance                 |
| calendar       | every date from the first visit to the end of the horizon                    |
| targets        | every store on each of the 39 days after the last visit                      |
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HORIZON_DAYS = 39  # fixed value: length of the forecast horizon


def store_key(suppkey: str) -> Column:
    return F.concat(F.lit("air_"), F.lpad(F.col(suppkey).cast("string"), 12, "0"))


def partner_key(suppkey: str) -> Column:
    return F.concat(F.lit("hpg_"), F.lpad(F.col(suppkey).cast("string"), 12, "0"))


class Standins:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}
        self._span = None

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def visits(self) -> DataFrame:
        daily = (
            self.table("lineitem")
            .groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("visit_date"))
            .agg(F.sum("l_quantity").cast("int").alias("visitors"))
        )
        return daily.select(store_key("l_suppkey").alias("store_id"), "visit_date", "visitors")

    def stores(self) -> DataFrame:
        place = (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", F.concat("r_name", F.lit("-"), "n_name").alias("area_name"))
        )
        kind = self.table("part").select(
            F.col("p_partkey").alias("s_suppkey"),
            F.translate("p_name", " ", "/").alias("genre_name"),
        )
        # Suppliers meet the parts first: they are fewer, so that Spark does not send the parts to every task.
        return (
            self.table("supplier")
            .join(kind, "s_suppkey")
            .join(place, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                store_key("s_suppkey").alias("store_id"),
                "genre_name",
                "area_name",
                F.col("s_acctbal").alias("latitude"),
                F.col("s_nationkey").cast("double").alias("longitude"),
            )
        )

    def _bookings(self, returned: bool, key: Column) -> DataFrame:
        flag = F.col("l_returnflag")
        lines = self.table("lineitem").filter(flag == "R" if returned else flag != "R")
        return (
            lines.join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .filter(F.col("l_shipdate") >= F.col("o_orderdate"))
            .select(
                key,
                F.col("l_shipdate").alias("visit_datetime"),
                F.col("o_orderdate").alias("reserve_datetime"),
                F.col("l_quantity").cast("int").alias("reserve_visitors"),
            )
        )

    def reservations_a(self) -> DataFrame:
        return self._bookings(False, store_key("l_suppkey").alias("store_id"))

    def reservations_b(self) -> DataFrame:
        return self._bookings(True, partner_key("l_suppkey").alias("partner_id"))

    def relation(self) -> DataFrame:
        return self.table("supplier").filter("s_acctbal > 0").select(
            store_key("s_suppkey").alias("store_id"), partner_key("s_suppkey").alias("partner_id")
        )

    def last_visit(self):
        """First and last visit date: one row."""
        if self._span is None:
            self._span = self.table("lineitem").agg(
                F.min("l_shipdate").cast("date").alias("first_day"),
                F.max("l_shipdate").cast("date").alias("last_day"),
            ).first()
        return self._span

    def calendar(self) -> DataFrame:
        shipped = F.col("l_shipdate")
        span = self.table("lineitem").agg(F.min(shipped).cast("date").alias("a"), F.max(shipped).cast("date").alias("b"))
        days = span.select(F.explode(F.sequence("a", F.date_add("b", HORIZON_DAYS))).alias("calendar_date"))
        d = F.col("calendar_date")
        special = F.dayofmonth(d).isin(1, 15) | ((F.month(d) == 12) & (F.dayofmonth(d) >= 24))
        return days.select(
            d,
            F.date_format(d, "EEEE").alias("day_of_week"),
            F.when(special, 1).otherwise(0).alias("holiday_flg"),
        )

    def targets(self) -> DataFrame:
        last = F.lit(self.last_visit()["last_day"])
        days = F.sequence(F.date_add(last, 1), F.date_add(last, HORIZON_DAYS))
        return (
            self.table("supplier")
            .select(store_key("s_suppkey").alias("store_id"), F.explode(days).alias("d"))
            .select(F.concat_ws("_", "store_id", F.col("d").cast("string")).alias("id"), F.lit(0.0).alias("visitors"))
        )

    def vectors(self) -> DataFrame:
        return self.table("embeddings").select(
            "vec_id", F.col("embedding").cast("array<double>").alias("vec"), "label"
        )


_STORE = "concat('air_', lpad(cast({0} as varchar), 12, '0'))"
_PARTNER = "concat('hpg_', lpad(cast({0} as varchar), 12, '0'))"
_BOOKING = """
  SELECT {key}, l_shipdate AS visit_datetime, o_orderdate AS reserve_datetime,
         cast(l_quantity AS integer) AS reserve_visitors
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_returnflag {flag} AND l_shipdate >= o_orderdate"""

# Named SQL fragments; a query names those it reads and gets them, and what they read, as CTEs.
CTES: dict[str, str] = {
    "visits": f"""
  SELECT {_STORE.format('l_suppkey')} AS store_id, cast(l_shipdate AS date) AS visit_date,
         cast(sum(l_quantity) AS integer) AS visitors
  FROM lineitem GROUP BY l_suppkey, cast(l_shipdate AS date)""",
    "stores": f"""
  SELECT {_STORE.format('s_suppkey')} AS store_id, replace(p_name, ' ', '/') AS genre_name,
         concat(r_name, '-', n_name) AS area_name, s_acctbal AS latitude,
         cast(s_nationkey AS double) AS longitude
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN part ON p_partkey = s_suppkey""",
    "reservations_a": _BOOKING.format(key=_STORE.format("l_suppkey") + " AS store_id", flag="<> 'R'"),
    "reservations_b": _BOOKING.format(key=_PARTNER.format("l_suppkey") + " AS partner_id", flag="= 'R'"),
    "relation": f"""
  SELECT {_STORE.format('s_suppkey')} AS store_id, {_PARTNER.format('s_suppkey')} AS partner_id
  FROM supplier WHERE s_acctbal > 0""",
    "span": """
  SELECT min(cast(l_shipdate AS date)) AS first_day, max(cast(l_shipdate AS date)) AS last_day FROM lineitem""",
    "calendar": f"""
  SELECT calendar_date, dayname(calendar_date) AS day_of_week,
         CASE WHEN day(calendar_date) IN (1, 15) OR (month(calendar_date) = 12 AND day(calendar_date) >= 24)
              THEN 1 ELSE 0 END AS holiday_flg
  FROM (SELECT cast(unnest(generate_series(first_day, last_day + INTERVAL {HORIZON_DAYS} DAY, INTERVAL 1 DAY)) AS date)
        AS calendar_date FROM span)""",
    "targets": f"""
  SELECT concat({_STORE.format('s_suppkey')}, '_', cast(d AS varchar)) AS id, 0.0e0 AS visitors
  FROM supplier, (SELECT cast(unnest(generate_series(last_day + INTERVAL 1 DAY,
       last_day + INTERVAL {HORIZON_DAYS} DAY, INTERVAL 1 DAY)) AS date) AS d FROM span)""",
    "weekday_calendar": """
  SELECT calendar_date, day_of_week,
         CASE WHEN day_of_week IN ('Saturday', 'Sunday') AND holiday_flg = 1 THEN 0 ELSE holiday_flg END AS holiday_flg
  FROM calendar""",
    "weighted_calendar": """
  SELECT *, pow(cast(row_number() OVER (ORDER BY calendar_date) AS double) / count(*) OVER (), 5) AS weight
  FROM weekday_calendar""",
    "dated_visits": """
  SELECT v.*, c.day_of_week, c.holiday_flg, c.weight, cast(month(v.visit_date) AS integer) AS month
  FROM visits v LEFT JOIN weighted_calendar c ON v.visit_date = c.calendar_date""",
    "baseline": """
  SELECT store_id, day_of_week, holiday_flg, sum(weight * ln(1 + visitors)) / sum(weight) AS wmean
  FROM dated_visits GROUP BY ALL""",
    "month_baseline": """
  SELECT store_id, month, day_of_week, holiday_flg, sum(weight * ln(1 + visitors)) / sum(weight) AS wmean
  FROM dated_visits GROUP BY ALL""",
    "parsed_targets": """
  SELECT id, regexp_replace(id, '_[^_]*$', '') AS store_id, cast(split_part(id, '_', 3) AS date) AS visit_date
  FROM targets""",
    "dated_targets": """
  SELECT t.*, c.day_of_week, c.holiday_flg, cast(month(t.visit_date) AS integer) AS month
  FROM parsed_targets t LEFT JOIN weekday_calendar c ON t.visit_date = c.calendar_date""",
    "forecast": """
  SELECT id, t.store_id, visit_date, exp(coalesce(b1.wmean, b2.wmean, b3.wmean)) - 1 AS visitors,
         CASE WHEN b1.wmean IS NOT NULL THEN 1 WHEN b2.wmean IS NOT NULL THEN 2
              WHEN b3.wmean IS NOT NULL THEN 3 END AS level
  FROM dated_targets t
  LEFT JOIN baseline b1 ON t.store_id = b1.store_id AND t.day_of_week = b1.day_of_week
       AND t.holiday_flg = b1.holiday_flg
  LEFT JOIN baseline b2 ON t.store_id = b2.store_id AND t.day_of_week = b2.day_of_week AND b2.holiday_flg = 0
  LEFT JOIN (SELECT store_id, avg(wmean) AS wmean FROM baseline GROUP BY store_id) b3 ON t.store_id = b3.store_id""",
    "month_forecast": """
  SELECT id, t.store_id, visit_date, exp(coalesce(b1.wmean, b2.wmean, b3.wmean)) - 1 AS visitors,
         CASE WHEN b1.wmean IS NOT NULL THEN 1 WHEN b2.wmean IS NOT NULL THEN 2
              WHEN b3.wmean IS NOT NULL THEN 3 END AS level
  FROM dated_targets t
  LEFT JOIN month_baseline b1 ON t.store_id = b1.store_id AND t.month = b1.month AND t.day_of_week = b1.day_of_week
       AND t.holiday_flg = b1.holiday_flg
  LEFT JOIN month_baseline b2 ON t.store_id = b2.store_id AND t.month = b2.month AND t.day_of_week = b2.day_of_week
       AND b2.holiday_flg = 0
  LEFT JOIN (SELECT store_id, avg(wmean) AS wmean FROM month_baseline GROUP BY store_id) b3
       ON t.store_id = b3.store_id""",
}


# Read more than once by the queries that join forecasts; worked out once, instead of once per use.
MATERIALIZED = ("visits", "dated_visits", "baseline", "month_baseline", "dated_targets", "forecast", "month_forecast")


def with_ctes(sql: str) -> str:
    """Prefix ``sql`` with the named fragments it reads, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name, body in CTES.items():
            if name not in ordered and re.search(rf"\b{name}\b", text):
                visit(body)
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    if not ordered:
        return sql
    parts = ",\n".join(f"{n} AS {'MATERIALIZED ' if n in MATERIALIZED else ''}({CTES[n]})" for n in ordered)
    head, body = ("WITH ", sql) if not sql.lstrip().upper().startswith("WITH") else (
        "WITH ", sql.lstrip()[4:].lstrip())
    joiner = "\n" if head == "WITH " and body is sql else ",\n"
    return f"{head}{parts}{joiner}{body}"
