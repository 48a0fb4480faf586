"""Sources, projections, joins, aggregates, ordering, scalar functions and encoders."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.registry import query
from venueflow.functions import columns as C
from venueflow.operators import encode, profiles, split
from venueflow.operators.calendar import clear_weekend_holidays
from venueflow.operators.position import with_position
from venueflow.plans.forecast import parse_targets
from venueflow.session import new_shared_path
from venueflow.sources.tables import load_catalog, read_table, write_csv

VISITS = "store_id string, visit_date date, visitors int"

# ---- sources and sinks ----


@query("s1_read_csv", "SELECT store_id, visit_date, visitors FROM visits")
def _(t):
    path = new_shared_path(t.spark, "visits") + ".csv"
    write_csv(t.visits(), path)
    return read_table(t.spark, path, VISITS)


@query(
    "s2_catalog",
    """SELECT 'calendar' AS name, count(*) AS n_rows FROM calendar UNION ALL SELECT 'stores', count(*) FROM stores
       UNION ALL SELECT 'visits', count(*) FROM visits""",
)
def _(t):
    folder = new_shared_path(t.spark, "catalog")
    for name in ("visits", "stores", "calendar"):
        write_csv(getattr(t, name)(), f"{folder}/{name}.csv")
    schemas = {
        "visits": VISITS,
        "calendar": "calendar_date date, day_of_week string, holiday_flg int",
        "stores": "store_id string, genre_name string, area_name string, latitude double, longitude double",
    }
    out = None
    for name, df in load_catalog(t.spark, folder, schemas).items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


@query("s3_write_csv", "SELECT id, store_id, visit_date FROM parsed_targets")
def _(t):
    path = new_shared_path(t.spark, "targets") + ".csv"
    write_csv(parse_targets(t.targets()), path)
    return read_table(t.spark, path, "id string, store_id string, visit_date date")


@query(
    "s4_write_csv_fixed_decimals",
    "SELECT l_orderkey, printf('%.4f', l_discount * l_extendedprice) AS amount FROM lineitem",
)
def _(t):
    path = new_shared_path(t.spark, "amounts") + ".csv"
    amounts = t.table("lineitem").select(
        "l_orderkey", (F.col("l_discount") * F.col("l_extendedprice")).alias("amount")
    )
    write_csv(amounts, path, float_scale=4)
    return read_table(t.spark, path, "l_orderkey long, amount string")


# ---- projections, filters, mutation ----


@query("p1_projection", "SELECT store_id, visitors FROM visits")
def _(t):
    return t.visits().select("store_id", "visitors")


@query("p2_exclude_columns", "SELECT genre_name, area_name, longitude FROM stores")
def _(t):
    stores = t.stores()
    return stores.select(encode.feature_columns(stores, ["store_id", "latitude"]))


@query("p3_rename", "SELECT calendar_date AS visit_date, day_of_week, holiday_flg FROM calendar")
def _(t):
    return t.calendar().withColumnsRenamed({"calendar_date": "visit_date"})


@query("p4_drop_column", "SELECT id FROM targets")
def _(t):
    return t.targets().drop("visitors")


@query(
    "p5_column_arithmetic",
    """SELECT store_id, round(longitude + latitude, 6) AS lon_plus_lat,
              round((longitude + latitude) / 2, 6) AS mid, round(longitude - latitude, 6) AS gap FROM stores""",
)
def _(t):
    lon, lat = F.col("longitude"), F.col("latitude")
    return t.stores().select(
        "store_id",
        F.round(lon + lat, 6).alias("lon_plus_lat"),
        F.round((lon + lat) / 2, 6).alias("mid"),
        F.round(lon - lat, 6).alias("gap"),
    )


_LEADS = """
  SELECT store_id, cast(visit_datetime AS date) AS visit_date, reserve_visitors,
         cast(date_diff('day', cast(reserve_datetime AS date), cast(visit_datetime AS date)) AS integer) AS lead_days
  FROM reservations_a"""


@query(
    "p6_far_reservations",
    f"SELECT * FROM ({_LEADS}) WHERE lead_days > isodow(visit_date) - 1",
)
def _(t):
    far = profiles.far_reservations(profiles.with_lead(t.reservations_a()))
    return far.select("store_id", "visit_date", "reserve_visitors", "lead_days")


@query("p7_equality_filter", "SELECT calendar_date, day_of_week FROM weekday_calendar WHERE holiday_flg = 0")
def _(t):
    return clear_weekend_holidays(t.calendar()).filter("holiday_flg = 0").select("calendar_date", "day_of_week")


_PAIRED = """
  SELECT store_id, visit_date,
    cast(sum(lead_days) FILTER (s = 'a') AS bigint) AS rs1_a, cast(sum(reserve_visitors) FILTER (s = 'a') AS bigint) AS rv1_a,
    round(avg(lead_days) FILTER (s = 'a'), 6) AS rs2_a, round(avg(reserve_visitors) FILTER (s = 'a'), 6) AS rv2_a,
    cast(sum(lead_days) FILTER (s = 'b') AS bigint) AS rs1_b, cast(sum(reserve_visitors) FILTER (s = 'b') AS bigint) AS rv1_b,
    round(avg(lead_days) FILTER (s = 'b'), 6) AS rs2_b, round(avg(reserve_visitors) FILTER (s = 'b'), 6) AS rv2_b
  FROM (
    SELECT s, store_id, cast(visit_datetime AS date) AS visit_date, reserve_visitors,
           date_diff('day', cast(reserve_datetime AS date), cast(visit_datetime AS date)) AS lead_days
    FROM (SELECT 'a' AS s, store_id, visit_datetime, reserve_datetime, reserve_visitors FROM reservations_a
          UNION ALL
          SELECT 'b', store_id, visit_datetime, reserve_datetime, reserve_visitors
          FROM reservations_b JOIN relation USING (partner_id)))
  WHERE lead_days > isodow(visit_date) - 1
  GROUP BY store_id, visit_date"""


def paired(t):
    b = profiles.translate_partner_ids(t.reservations_b(), t.relation())
    return profiles.paired_reservation_features(t.reservations_a(), b)


@query(
    "p9_null_mask",
    f"""SELECT rs1_a IS NULL AS no_a, rs1_b IS NULL AS no_b, count(*) AS n FROM ({_PAIRED}) GROUP BY ALL""",
)
def _(t):
    masks = [F.col("rs1_a").isNull().alias("no_a"), F.col("rs1_b").isNull().alias("no_b")]
    return paired(t).groupBy(*masks).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p10_fill_sentinel",
    f"SELECT store_id, visit_date, coalesce(rs1_a, -1) AS rs1_a, coalesce(rv2_b, -1) AS rv2_b FROM ({_PAIRED})",
)
def _(t):
    rows = paired(t).select("store_id", "visit_date", "rs1_a", F.round("rv2_b", 6).alias("rv2_b"))
    return encode.fill_sentinel(rows)


@query(
    "p12_date_range_filter",
    """SELECT store_id, visit_date FROM visits
       WHERE cast(strftime(visit_date, '%Y%m%d') AS integer) BETWEEN 20000401 AND 20000531""",
)
def _(t):
    rows = t.visits().filter(C.date_int("visit_date").between(20000401, 20000531))
    return rows.select("store_id", "visit_date")


# ---- joins ----


@query("j1_translate_partner_ids", "SELECT store_id, count(*) AS n FROM reservations_b JOIN relation USING (partner_id) GROUP BY 1")
def _(t):
    own = profiles.translate_partner_ids(t.reservations_b(), t.relation())
    return own.groupBy("store_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "j2_sum_and_mean_in_one",
    f"""SELECT * REPLACE (cast(rs1_a AS double) AS rs1_a, cast(rv1_a AS double) AS rv1_a,
          cast(rs1_b AS double) AS rs1_b, cast(rv1_b AS double) AS rv1_b) FROM ({_PAIRED})""",
)
def _(t):
    measures = [f"{m}_{s}" for s in "ab" for m in ("rs1", "rv1", "rs2", "rv2")]
    return paired(t).withColumns({c: F.round(F.col(c).cast("double"), 6) for c in measures})


@query("j3_left_join_store_info", "SELECT v.*, s.genre_name, s.latitude FROM visits v LEFT JOIN stores s USING (store_id)")
def _(t):
    return profiles.attach(t.visits(), t.stores().select("store_id", "genre_name", "latitude"), ["store_id"])


_DOW = "cast(isodow(visit_date) - 1 AS integer)"
_PROFILE = """min(visitors) AS {p}min_visitors, round(avg(visitors), 6) AS {p}mean_visitors,
  median(visitors) AS {p}median_visitors, max(visitors) AS {p}max_visitors,
  count({c}) AS {p}count_observations"""


def profile_sql(keys, source, prefix="", counted="visitors"):
    return f"SELECT {keys}, {_PROFILE.format(p=prefix, c=counted)} FROM ({source}) GROUP BY {keys}"


_PARTS = f"""SELECT store_id, visit_date, visitors, {_DOW} AS dow, cast(year(visit_date) AS integer) AS year,
  cast(month(visit_date) AS integer) AS month FROM visits"""
_PLACED = f"SELECT p.*, s.area_name, s.genre_name FROM ({_PARTS}) p LEFT JOIN stores s USING (store_id)"


def rounded_profile(df, keys, prefix="", **options):
    out = profiles.profile(df, keys, prefix=prefix, **options)
    return out.withColumn(f"{prefix}mean_visitors", F.round(f"{prefix}mean_visitors", 6))


def placed_visits(t):
    return profiles.attach(
        profiles.date_parts(t.visits()), t.stores().select("store_id", "area_name", "genre_name"), ["store_id"]
    )


@query(
    "j5_left_join_profile",
    f"""SELECT v.*, q.* EXCLUDE (store_id, dow) FROM ({_PARTS}) v
        LEFT JOIN ({profile_sql('store_id, dow', _PARTS)}) q USING (store_id, dow)""",
)
def _(t):
    visits = profiles.date_parts(t.visits())
    return profiles.attach(visits, rounded_profile(visits, ["store_id", "dow"]), ["store_id", "dow"])


_GRID = """SELECT DISTINCT store_id, cast(dow AS integer) AS dow
  FROM (SELECT store_id FROM parsed_targets) CROSS JOIN generate_series(0, 6) AS g(dow)"""


@query(
    "j6_inner_join_grid",
    f"SELECT v.store_id, v.visit_date, v.visitors, v.dow FROM ({_PARTS}) v JOIN ({_GRID}) g USING (store_id, dow)",
)
def _(t):
    grid = profiles.entity_weekday_grid(parse_targets(t.targets()))
    rows = profiles.date_parts(t.visits()).select("store_id", "visit_date", "visitors", "dow")
    return profiles.attach(rows, grid, ["store_id", "dow"], how="inner")


@query("j7_membership_filter", "SELECT * FROM visits WHERE store_id IN (SELECT store_id FROM relation)")
def _(t):
    return profiles.only_known(t.visits(), t.relation(), "store_id")


@query("j8_store_weekday_grid", _GRID)
def _(t):
    return profiles.entity_weekday_grid(parse_targets(t.targets()))


# ---- aggregates ----


@query(
    "a1_reservation_sums",
    f"""SELECT store_id, visit_date, cast(sum(lead_days) AS bigint) AS rs1, cast(sum(reserve_visitors) AS bigint) AS rv1
        FROM ({_LEADS}) WHERE lead_days > isodow(visit_date) - 1 GROUP BY ALL""",
)
def _(t):
    return profiles.reservation_features(t.reservations_a()).select("store_id", "visit_date", "rs1", "rv1")


@query(
    "a2_reservation_means",
    f"""SELECT store_id, visit_date, round(avg(lead_days), 6) AS rs2, round(avg(reserve_visitors), 6) AS rv2
        FROM ({_LEADS}) GROUP BY ALL""",
)
def _(t):
    means = profiles.reservation_features(t.reservations_a(), far_only=False)
    return means.select("store_id", "visit_date", F.round("rs2", 6).alias("rs2"), F.round("rv2", 6).alias("rv2"))


@query("a3_store_weekday_profile", profile_sql("store_id, dow", _PARTS))
def _(t):
    return rounded_profile(profiles.date_parts(t.visits()), ["store_id", "dow"])


@query("a3_profile_bracketed_median", profile_sql("store_id, dow", _PARTS))
def _(t):
    return rounded_profile(profiles.date_parts(t.visits()), ["store_id", "dow"], median="bracketed")


@query("a4_area_weekday_profile", profile_sql("area_name, dow", _PLACED, "area_"))
def _(t):
    return rounded_profile(placed_visits(t), ["area_name", "dow"], "area_")


@query("a4_genre_weekday_profile", profile_sql("genre_name, dow", _PLACED, "genre_"))
def _(t):
    return rounded_profile(placed_visits(t), ["genre_name", "dow"], "genre_")


@query("a5_area_month_weekday_profile", profile_sql("area_name, month, dow", _PLACED, "area_"))
def _(t):
    return rounded_profile(placed_visits(t), ["area_name", "month", "dow"], "area_")


@query("a5_genre_month_weekday_profile", profile_sql("genre_name, month, dow", _PLACED, "genre_"))
def _(t):
    return rounded_profile(placed_visits(t), ["genre_name", "month", "dow"], "genre_")


@query("a6_store_month_profile", profile_sql("store_id, month", _PARTS))
def _(t):
    return rounded_profile(profiles.date_parts(t.visits()), ["store_id", "month"])


_HOLED = "SELECT * REPLACE (CASE WHEN visitors > 100 THEN NULL ELSE visitors END AS visitors) FROM ({})".format(_PARTS)


@query("a7_profile_counting_rows", profile_sql("store_id, dow", _HOLED, counted="*"))
def _(t):
    holed = profiles.date_parts(t.visits()).withColumn("visitors", F.expr("if(visitors > 100, null, visitors)"))
    return rounded_profile(holed, ["store_id", "dow"], count_nulls=True)


GRAINS = {
    "store_dow": ["store_id", "dow"],
    "area_dow": ["area_name", "dow"],
    "genre_dow": ["genre_name", "dow"],
    "area_month_dow": ["area_name", "month", "dow"],
    "genre_month_dow": ["genre_name", "month", "dow"],
    "store_month": ["store_id", "month"],
}
_GRAIN_KEYS = ("store_id", "dow", "area_name", "genre_name", "month")


def grain_sql(name, keys):
    absent = {"dow": "-1", "month": "-1"}  # numbers stay integers on either side
    shown = ", ".join(k if k in keys else f"{absent.get(k, 'NULL')} AS {k}" for k in _GRAIN_KEYS)
    source = _PARTS if "store_id" in keys else _PLACED
    return f"SELECT '{name}' AS grain, {shown}, * EXCLUDE ({', '.join(keys)}) FROM ({profile_sql(', '.join(keys), source)})"


@query("a3_a6_profiles_one_scan", " UNION ALL BY NAME ".join(grain_sql(n, ks) for n, ks in GRAINS.items()))
def _(t):
    merged = profiles.profiles_at(profiles.date_parts(t.visits()), GRAINS, side=t.stores())
    return merged.fillna(-1, ["dow", "month"]).withColumn("mean_visitors", F.round("mean_visitors", 6))


@query(
    "a11_distance_to_global_max",
    """SELECT store_id, round((SELECT max(latitude) FROM stores) - latitude, 6) AS var_max_lat,
              round((SELECT max(longitude) FROM stores) - longitude, 6) AS var_max_long FROM stores""",
)
def _(t):
    out = profiles.distance_to_max(t.stores(), {"latitude": "var_max_lat", "longitude": "var_max_long"})
    return out.select("store_id", F.round("var_max_lat", 6).alias("var_max_lat"), F.round("var_max_long", 6).alias("var_max_long"))


@query(
    "a12_distinct_counts",
    """SELECT (SELECT count(DISTINCT store_id) FROM visits) AS n_stores,
              (SELECT count(DISTINCT visit_date) FROM visits) AS n_days,
              (SELECT count(DISTINCT genre_name) FROM stores) AS n_genres,
              (SELECT count(DISTINCT area_name) FROM stores) AS n_areas""",
)
def _(t):
    places = t.stores().agg(F.struct(F.countDistinct("genre_name").alias("g"), F.countDistinct("area_name").alias("a")).alias("s"))
    out = t.visits().agg(F.countDistinct("store_id").alias("n_stores"), F.countDistinct("visit_date").alias("n_days"))
    return out.withColumn("s", places.scalar()).select(
        "n_stores", "n_days", F.col("s.g").alias("n_genres"), F.col("s.a").alias("n_areas")
    )


@query(
    "a13_active_stores_per_weekday",
    f"SELECT dow, count(DISTINCT store_id) AS n_entities FROM ({_PARTS}) GROUP BY dow",
)
def _(t):
    return profiles.active_entities(profiles.date_parts(t.visits()), ["dow"])


@query(
    "a13_active_stores_per_month",
    f"SELECT year, month, count(DISTINCT store_id) AS n_entities FROM ({_PARTS}) GROUP BY year, month",
)
def _(t):
    return profiles.active_entities(profiles.date_parts(t.visits()), ["year", "month"])


@query(
    "a14_share_of_total",
    """SELECT store_id, round(sum(visitors) / (SELECT sum(visitors) FROM visits), 6) AS share FROM visits GROUP BY store_id""",
)
def _(t):
    sums = t.visits().groupBy("store_id").agg(F.sum("visitors").alias("share"))
    return profiles.share_of_total(sums, "share").withColumn("share", F.round("share", 6))


# ---- ordering ----


@query("o1_chronological_sort", "SELECT store_id, visit_date, visitors FROM visits ORDER BY visit_date, store_id")
def _(t):
    return t.visits().orderBy("visit_date", "store_id")


@query(
    "o1_chronological_position",
    """SELECT store_id, visit_date, row_number() OVER (ORDER BY visit_date, store_id) - 1 AS position FROM visits""",
)
def _(t):
    return with_position(t.visits().select("store_id", "visit_date"), ["visit_date", "store_id"])


@query(
    "o3_tail_fraction",
    """SELECT store_id, visit_date, visitors FROM (
         SELECT *, row_number() OVER (ORDER BY visit_date, store_id) AS r, count(*) OVER () AS n FROM visits)
       WHERE r > n - floor(n * 0.2e0)""",
)
def _(t):
    return split.head_tail(t.visits(), "visit_date", ["store_id"], 0.2)[1]


@query(
    "o7_stack_frames",
    """SELECT store_id, visit_date, 'history' AS part FROM visits
       UNION ALL SELECT store_id, visit_date, 'target' FROM parsed_targets""",
)
def _(t):
    history = t.visits().select("store_id", "visit_date", F.lit("history").alias("part"))
    return history.unionByName(parse_targets(t.targets()).select("store_id", "visit_date", F.lit("target").alias("part")))


# ---- scalar functions ----


@query(
    "f1_parse_datetime",
    """SELECT o_orderkey, cast(strptime(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS date) AS d
       FROM orders""",
)
def _(t):
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return t.table("orders").select("o_orderkey", C.day(C.parse_timestamp(text)).alias("d"))


@query(
    "f2_f6_date_functions",
    """SELECT o_orderkey, cast(o_orderdate AS date) AS d, cast(isodow(o_orderdate) - 1 AS integer) AS dow,
              cast(year(o_orderdate) AS integer) AS y, cast(month(o_orderdate) AS integer) AS m,
              cast(strftime(o_orderdate, '%Y%m%d') AS integer) AS date_int FROM orders""",
)
def _(t):
    d = C.day("o_orderdate")
    return t.table("orders").select(
        "o_orderkey", d.alias("d"), C.weekday(d).alias("dow"), F.year(d).alias("y"), F.month(d).alias("m"),
        C.date_int(d).alias("date_int"),
    )


@query(
    "f5_lead_days",
    """SELECT l_orderkey, l_linenumber,
              cast(date_diff('day', cast(o_orderdate AS date), cast(l_shipdate AS date)) AS integer) AS lead_days
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _(t):
    joined = t.table("lineitem").join(t.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", C.lead_days("l_shipdate", "o_orderdate").alias("lead_days"))


@query("f7_split_id", "SELECT id, store_id, visit_date FROM parsed_targets")
def _(t):
    return parse_targets(t.targets())


@query("f8_build_id", "SELECT concat(store_id, '_', cast(visit_date AS varchar)) AS id FROM visits")
def _(t):
    return t.visits().select(C.make_id("store_id", "visit_date").alias("id"))


_WORDS = """SELECT store_id, replace(genre_name, '/', ' ') AS genre_name, replace(area_name, '-', ' ') AS area_name FROM stores"""


@query("f9_separate_words", _WORDS)
def _(t):
    return t.stores().select(
        "store_id",
        C.separate_words("genre_name", "/").alias("genre_name"),
        C.separate_words("area_name", "-").alias("area_name"),
    )


_TOKENS = ", ".join(f"split_part(area_name, ' ', {i + 1}) AS area_name{i}" for i in range(10))


@query("f10_tokens", f"SELECT store_id, area_name, {_TOKENS} FROM ({_WORDS})")
def _(t):
    return encode.expand_tokens(t.stores().select("store_id", "area_name"), "area_name", "-")


@query(
    "f11_f15_numeric_functions",
    """SELECT store_id, round(ln(1 + greatest(latitude, 0)), 6) AS log_value,
              round(exp(longitude / 10) - 1, 6) AS exp_value, round(pow(longitude / 25, 5), 6) AS power_value,
              round(least(greatest(latitude / 1000, 0), 6.8e0), 6) AS clipped, cast(longitude AS integer) AS whole,
              round(latitude / 7, 3) AS rounded FROM stores""",
)
def _(t):
    lat, lon = F.col("latitude"), F.col("longitude")
    return t.stores().select(
        "store_id",
        F.round(F.log1p(C.clip(lat, lower=0)), 6).alias("log_value"),
        F.round(F.expm1(lon / 10), 6).alias("exp_value"),
        F.round(F.pow(lon / 25, F.lit(5)), 6).alias("power_value"),
        F.round(C.clip(lat / 1000, 0, 6.8), 6).alias("clipped"),
        lon.cast("int").alias("whole"),
        F.round(lat / 7, 3).alias("rounded"),
    )


# ---- encoders ----


@query(
    "e1_label_codes",
    """SELECT calendar_date, cast(dense_rank() OVER (ORDER BY day_of_week) - 1 AS integer) AS day_of_week,
              holiday_flg FROM calendar""",
)
def _(t):
    return encode.label_encode(t.calendar(), ["day_of_week"])


@query(
    "e2_codes_fit_and_transform",
    """SELECT id, c.code AS store_code FROM parsed_targets
       JOIN (SELECT store_id, cast(dense_rank() OVER (ORDER BY store_id) - 1 AS integer) AS code
             FROM (SELECT DISTINCT store_id FROM visits)) c USING (store_id)""",
)
def _(t):
    codes = encode.fit_label_codes(t.visits(), ["store_id"])
    coded = encode.apply_label_codes(parse_targets(t.targets()), codes, ["store_id"], ["store_code"])
    return coded.select("id", "store_code")


_TOKEN_CODES = ", ".join(
    f"cast(dense_rank() OVER (ORDER BY split_part({c}, ' ', {i + 1})) - 1 AS integer) AS {c}{i}"
    for c in ("genre_name", "area_name")
    for i in range(10)
)
TOKEN_SQL = f"""SELECT store_id, cast(dense_rank() OVER (ORDER BY genre_name) - 1 AS integer) AS genre_name,
  cast(dense_rank() OVER (ORDER BY area_name) - 1 AS integer) AS area_name, {_TOKEN_CODES} FROM ({_WORDS})"""


@query("e3_token_codes", TOKEN_SQL)
def _(t):
    return encode.encode_tokens(
        t.stores().select("store_id", "genre_name", "area_name"), {"genre_name": "/", "area_name": "-"}
    )


@query(
    "e4_min_max_scale",
    """WITH cut AS (SELECT first_day + 1500 AS d FROM span),
       s AS (SELECT min(visitors) AS lo, max(visitors) AS hi FROM visits, cut WHERE visit_date <= d)
       SELECT store_id, visit_date, round((visitors - lo) / (hi - lo), 6) AS visitors,
              cast(0 AS double) AS one FROM visits, s, cut WHERE visit_date > d""",
)
def _(t):
    cut = F.date_add(F.lit(t.last_visit()["first_day"]), 1500)
    rows = t.visits().withColumn("one", F.lit(1.0))
    train, test = rows.filter(F.col("visit_date") <= cut), rows.filter(F.col("visit_date") > cut)
    scaled = encode.min_max_scale(train, test, ["visitors", "one"])
    return scaled.withColumn("visitors", F.round("visitors", 6))


@query(
    "e5_feature_vector",
    f"""SELECT store_id, visit_date, cast(7 AS integer) AS n_features,
               round(dow + year + month + latitude + longitude + genre_name + area_name, 6) AS total
        FROM (SELECT store_id, visit_date, isodow(visit_date) - 1 AS dow, year(visit_date) AS year,
                     month(visit_date) AS month FROM visits)
        JOIN (SELECT store_id, latitude, longitude, dense_rank() OVER (ORDER BY genre_name) - 1 AS genre_name,
                     dense_rank() OVER (ORDER BY area_name) - 1 AS area_name FROM stores) USING (store_id)""",
)
def _(t):
    stores = encode.label_encode(t.stores(), ["genre_name", "area_name"])
    rows = profiles.attach(profiles.date_parts(t.visits()), stores, ["store_id"])
    columns = encode.feature_columns(rows, ["store_id", "visit_date", "visitors"])
    vector = vector_to_array("features")
    return encode.assemble(rows, columns).select(
        "store_id",
        "visit_date",
        F.size(vector).alias("n_features"),
        F.round(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
    )
