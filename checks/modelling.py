"""Feature frames, trained models, and the ensemble. Trained models have no SQL counterpart."""

from pyspark.sql import functions as F

from checks.features import _DOW, _PAIRED, _PLACED, _PROFILE, TOKEN_SQL, profile_sql
from checks.registry import query
from venueflow.functions.columns import make_id
from venueflow.operators import evaluate, models, select
from venueflow.operators.factors import AlternatingFactors
from venueflow.operators.split import chronological_holdout
from venueflow.plans import ensemble
from venueflow.plans.features import feature_frames, model_columns
from venueflow.plans.forecast import baseline_forecast, parse_targets
from venueflow.plans.runs import CATEGORIES
from venueflow.plans.tuning import cross_validated_grid
from venueflow.session import materialize

ROUND = ("mean_visitors", "rs2_a", "rv2_a", "rs2_b", "rv2_b", "total_reserv_mean", "total_reserv_dt_diff_mean",
         "var_max_lat", "var_max_long", "lon_plus_lat")


def frames(t, **options):
    # The visits are an input table of the plan; here they are derived once and written.
    visits = materialize(t.visits(), "visits")
    return feature_frames(
        visits, t.stores(), t.calendar(), t.targets(), t.reservations_a(), t.reservations_b(), t.relation(), **options
    )


def frame_sql(rows: str, join: str) -> str:
    return f"""
WITH bookings AS ({_PAIRED}),
attrs AS (SELECT c.*, s.latitude, s.longitude FROM ({TOKEN_SQL}) c JOIN stores s USING (store_id)),
profiles AS (SELECT store_id, dow, {_PROFILE.format(p='', c='visitors')}
  FROM (SELECT *, {_DOW} AS dow FROM visits) GROUP BY store_id, dow),
days AS (SELECT calendar_date AS visit_date, holiday_flg,
  cast(dense_rank() OVER (ORDER BY day_of_week) - 1 AS integer) AS day_of_week FROM calendar),
codes AS (SELECT store_id, cast(dense_rank() OVER (ORDER BY store_id) - 1 AS integer) AS store_code
  FROM (SELECT DISTINCT store_id FROM visits)),
frame AS (
  SELECT r.*, {_DOW} AS dow, cast(year(visit_date) AS integer) AS year, cast(month(visit_date) AS integer) AS month
  FROM ({rows}) r)
SELECT f.*, d.* EXCLUDE (visit_date), a.* EXCLUDE (store_id), codes.store_code,
  concat(f.store_id, '_', cast(f.visit_date AS varchar)) AS id,
  coalesce(p.min_visitors, -1) AS min_visitors, coalesce(p.mean_visitors, -1) AS mean_visitors,
  coalesce(p.median_visitors, -1) AS median_visitors, coalesce(p.max_visitors, -1) AS max_visitors,
  coalesce(p.count_observations, -1) AS count_observations,
  {", ".join(f"coalesce(b.{m}_{s}, -1) AS {m}_{s}" for s in "ab" for m in ("rs1", "rv1", "rs2", "rv2"))},
  coalesce(b.rv1_a + b.rv1_b, -1) AS total_reserv_sum,
  round(coalesce((b.rv2_a + b.rv2_b) / 2, -1), 5) AS total_reserv_mean,
  round(coalesce((b.rs2_a + b.rs2_b) / 2, -1), 5) AS total_reserv_dt_diff_mean,
  round((SELECT max(latitude) FROM attrs) - a.latitude, 6) AS var_max_lat,
  round((SELECT max(longitude) FROM attrs) - a.longitude, 6) AS var_max_long,
  round(a.longitude + a.latitude, 6) AS lon_plus_lat,
  cast(strftime(f.visit_date, '%Y%m%d') AS integer) AS date_int
FROM frame f LEFT JOIN days d USING (visit_date) {join} JOIN attrs a USING (store_id)
LEFT JOIN profiles p USING (store_id, dow) LEFT JOIN bookings b USING (store_id, visit_date)
LEFT JOIN codes USING (store_id)"""


_FAR_FILTER = "WHERE lead_days > isodow(visit_date) - 1"
ALL_PAIRED = _PAIRED.replace(_FAR_FILTER, "")


def grouped_sql(rows: str, join: str, keys: str) -> str:
    """The frame with area and genre profiles per ``keys``; the profiles take the place names as text, the frame their codes."""
    out = f"SELECT q.*, {', '.join(_group_columns('area_') + _group_columns('genre_'))} FROM ({frame_sql(rows, join)}) q"
    out += f" LEFT JOIN (SELECT store_id, {_PLACE_CODES} FROM stores) pc USING (store_id)"
    for prefix, name in (("area_", "area_code"), ("genre_", "genre_code")):
        source = f"SELECT v.*, {name} FROM ({_PLACED}) v JOIN (SELECT store_id, {_PLACE_CODES} FROM stores) USING (store_id)"
        grain = f"{name}, {keys}"
        out += f" LEFT JOIN ({profile_sql(grain, source, prefix)}) {prefix}p USING ({grain})"
    return out


_PLACE_CODES = "area_name AS area_code, genre_name AS genre_code"


def _group_columns(prefix: str) -> list[str]:
    stats = [f"{x}_visitors" for x in ("min", "mean", "median", "max")] + ["count_observations"]
    return [f"coalesce({prefix}p.{prefix}{c}, -1) AS {prefix}{c}" for c in stats]


def neat(df):
    scale = {c: 5 if c.startswith("total_reserv") else 6 for c in (*ROUND, "area_mean_visitors", "genre_mean_visitors") if c in df.columns}
    return df.withColumns({c: F.round(c, s) for c, s in scale.items()})


@query("j5_train_feature_frame", frame_sql("SELECT store_id, visit_date, visitors FROM visits", ""))
def _(t):
    return neat(frames(t)[0])


@query("j5_test_feature_frame", frame_sql("SELECT store_id, visit_date FROM parsed_targets", "LEFT"))
def _(t):
    return neat(frames(t)[1])


_VISITED = "SELECT store_id, visit_date, visitors FROM visits"


@query("j5_train_frame_all_bookings", frame_sql(_VISITED, "").replace(_PAIRED, ALL_PAIRED))
def _(t):
    return neat(frames(t, far_only=False)[0])


@query("j5_train_frame_weekday_groups", grouped_sql(_VISITED, "", "dow"))
def _(t):
    return neat(frames(t, grouped="weekday")[0])


@query("j5_train_frame_month_groups", grouped_sql(_VISITED, "", "month, dow"))
def _(t):
    return neat(frames(t, grouped="month")[0])


def train_frame(t, **options):
    """The train frame written once, so that iterative fitting reads finished rows."""
    train, test = frames(t, **options)
    return materialize(train, "train"), materialize(test, "test")


def predictions(t, estimator):
    train, test = train_frame(t)
    columns = model_columns(train)
    model = models.fit_log_target(estimator, train, columns)
    out = models.predict_log(model, test, "log_prediction")
    return out.select("id", models.invert_log("log_prediction").alias("visitors"))


SMALL = dict(rounds=10, depth=4)  # smaller than the defaults, to keep the check short
FACTORS = dict(sweeps=1)


@query("ml1_boosted_trees")
def _(t):
    return predictions(t, models.boosted_trees(**SMALL))


@query("ml2_boosted_trees_column_sampling")
def _(t):
    return predictions(t, models.boosted_trees_with_column_sampling(**SMALL))


@query("ml5_random_forest")
def _(t):
    return predictions(t, models.random_forest())


@query("ml6_linear_regression")
def _(t):
    return predictions(t, models.linear())


@query("ml7_lasso")
def _(t):
    return predictions(t, models.lasso())


# One feature gives linear models a closed form that SQL can state.

_ONE = """SELECT store_id, visit_date, visitors, ln(1 + visitors) AS y, avg(visitors) OVER (PARTITION BY store_id) AS x
  FROM visits"""


def one_feature(t):
    means = t.visits().groupBy("store_id").agg(F.avg("visitors").alias("x"))
    return t.visits().join(means, "store_id")


def one_feature_predictions(t, estimator):
    rows = one_feature(t)
    out = models.predict_log(models.fit_log_target(estimator, rows, ["x"]), rows, "p")
    return out.select("store_id", "visit_date", F.round("p", 6).alias("log_prediction"))


@query(
    "ml6_linear_one_feature",
    f"""SELECT store_id, visit_date, round((SELECT regr_intercept(y, x) FROM ({_ONE})) + x * (SELECT regr_slope(y, x)
        FROM ({_ONE})), 6) AS log_prediction FROM ({_ONE})""",
)
def _(t):
    return one_feature_predictions(t, models.linear())


@query(
    "ml7_lasso_one_feature",
    f"""WITH f AS (SELECT avg(x) AS mx, avg(y) AS my, covar_pop(y, x) AS c, var_pop(x) AS v FROM ({_ONE})),
        g AS (SELECT mx, my, sign(c) * greatest(abs(c) - 0.1e0, 0) / v AS b FROM f)
        SELECT store_id, visit_date, round(my + (x - mx) * b, 6) AS log_prediction FROM ({_ONE}), g""",
)
def _(t):
    return one_feature_predictions(t, models.lasso(0.1))


@query(
    "ml9_log_target_predictions",
    f"""SELECT store_id, visit_date, round(greatest(exp((SELECT regr_intercept(y, x) FROM ({_ONE}))
        + x * (SELECT regr_slope(y, x) FROM ({_ONE}))) - 1, 0), 5) AS visitors FROM ({_ONE})""",
)
def _(t):
    rows = one_feature(t)
    out = models.predict_log(models.fit_log_target(models.linear(), rows, ["x"]), rows, "p")
    return out.select("store_id", "visit_date", F.round(models.invert_log("p"), 5).alias("visitors"))


# A two-valued feature makes one split of one tree the means of two groups.

_HALVES = """SELECT store_id, visit_date, ln(1 + visitors) AS y, isodow(visit_date) >= 6 AS x FROM visits"""
_GROUP_MEANS = f"""SELECT store_id, visit_date, round(avg(y) OVER (PARTITION BY x), 6) AS log_prediction FROM ({_HALVES})"""
STUMP = dict(rounds=1, depth=1, rows=1.0)


def halves(t):
    weekend = F.when(F.weekday("visit_date") >= 5, 1.0).otherwise(0.0)
    return materialize(t.visits().withColumn("weekend", weekend), "halves")


def stump_predictions(t, estimator):
    rows = halves(t)
    out = models.predict_log(models.fit_log_target(estimator, rows, ["weekend"]), rows, "p")
    return out.select("store_id", "visit_date", F.round("p", 6).alias("log_prediction"))


@query("ml1_boosted_stump", _GROUP_MEANS)
def _(t):
    return stump_predictions(t, models.boosted_trees(**STUMP))


@query("ml2_boosted_stump_column_sampling", _GROUP_MEANS)
def _(t):
    return stump_predictions(t, models.boosted_trees_with_column_sampling(**STUMP))


@query("ml5_forest_stump", _GROUP_MEANS)
def _(t):
    return stump_predictions(t, models.random_forest(trees=1, depth=1, bootstrap=False))


def stump_importance(t, importance):
    model = models.fit_log_target(models.boosted_trees(**STUMP), halves(t), ["weekend"])
    return importance(model.stages[-1], ["weekend"])


_ONLY_FEATURE = f"SELECT 'weekend' AS feature, 1.0e0 AS score FROM ({_HALVES}) HAVING count(DISTINCT x) = 2"


@query("e7_stump_split_importance", _ONLY_FEATURE)
def _(t):
    return stump_importance(t, select.split_importance)


@query("e7_stump_gain_importance", _ONLY_FEATURE)
def _(t):
    return stump_importance(t, select.gain_importance)


_FITTED = f"SELECT regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM ({_ONE})"


def one_linear_member():
    return [ensemble.spark_ml("linear", 1.0, models.linear())]


@query(
    "v9_linear_holdout_report",
    f"""WITH r AS (SELECT *, row_number() OVER (ORDER BY visit_date, store_id) AS r, count(*) OVER () AS n FROM ({_ONE})),
        f AS (SELECT regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM r WHERE r <= n - floor(n * 0.1e0)),
        p AS (SELECT y, a + b * x AS p FROM r, f WHERE r > n - floor(n * 0.1e0))
        SELECT 'linear' AS model, count(*) AS n_rows, round(sqrt(avg(pow(y - p, 2))), 6) AS rmse FROM p
        UNION ALL SELECT 'blend', count(*), round(sqrt(avg(pow(y - greatest(p, 0), 2))), 6) FROM p""",
)
def _(t):
    train = materialize(one_feature(t).withColumn("id", make_id("store_id", "visit_date")), "one-feature")
    return ensemble.holdout_report(train, ["x"], one_linear_member()).withColumn("rmse", F.round("rmse", 6))


@query(
    "b3_linear_ensemble_forecast",
    f"""SELECT id, round(CASE WHEN level IS DISTINCT FROM 1 THEN model ELSE 0.7 * model + 0.3 * 1.1 * visitors END, 5) AS visitors
        FROM (SELECT id, visitors, level, greatest(exp(a + b * x) - 1, 0) AS model
              FROM forecast JOIN (SELECT DISTINCT store_id, x FROM ({_ONE})) USING (store_id), ({_FITTED}))""",
)
def _(t):
    train = materialize(one_feature(t), "one-feature")
    test = parse_targets(t.targets()).join(train.select("store_id", "x").distinct(), "store_id")
    model = ensemble.fit_and_predict(train, test, ["x"], one_linear_member())
    out = ensemble.final_forecast(model, baseline_forecast(t.visits(), t.calendar(), t.targets(), levels=1))
    return out.withColumn("visitors", F.round("visitors", 5))


_EFFECTS = f"""
  SELECT store_id, visit_date, dow, m + coalesce(s.b, 0) AS p, y - m - s.b AS rest
  FROM r CROSS JOIN (SELECT avg(y) AS m FROM r)
  JOIN (SELECT store_id, sum(y - m) / (count(*) + 2.0e0) AS b FROM r CROSS JOIN (SELECT avg(y) AS m FROM r) GROUP BY store_id) s
  USING (store_id)"""


@query(
    "ml8_additive_sweep",
    f"""WITH r AS (SELECT store_id, visit_date, ln(1 + visitors) AS y, isodow(visit_date) - 1 AS dow FROM visits),
        e AS ({_EFFECTS})
        SELECT store_id, visit_date, round(least(greatest(p + b, 0), 6.8e0), 6) AS log_prediction
        FROM e JOIN (SELECT dow, sum(rest) / (count(*) + 2.0e0) AS b FROM e GROUP BY dow) USING (dow)""",
)
def _(t):
    """One sweep without factors: the mean, then a ridge mean of what is left per store, then per weekday."""
    rows = materialize(t.visits().withColumn("dow", F.weekday("visit_date")), "dow-visits")
    model = AlternatingFactors([], ["store_id", "dow"], factors=0, sweeps=1, ridge=2.0).fit(rows)
    return model.predict_log(rows, "p").select("store_id", "visit_date", F.round("p", 6).alias("log_prediction"))


@query(
    "m2_custom_metric",
    f"""WITH r AS (SELECT *, row_number() OVER (ORDER BY visit_date, store_id) AS r, count(*) OVER () AS n FROM ({_ONE})),
        f AS (SELECT regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM r WHERE r <= n - floor(n * 0.1e0))
        SELECT 'linear' AS model, round(sqrt(avg(pow(y - a - b * x, 2))), 6) AS rmse FROM r, f
        WHERE r > n - floor(n * 0.1e0)""",
)
def _(t):
    flagged = materialize(chronological_holdout(one_feature(t), "visit_date", ["store_id"], 0.1), "flagged")
    model = models.fit_log_target(models.linear(), flagged.filter("not is_validation"), ["x"])
    held = models.predict_log(model, flagged.filter("is_validation"), "prediction")
    score = evaluate.LogRmse().evaluate(held.withColumn(models.LOG_TARGET, F.log1p("visitors")))
    return t.spark.createDataFrame([("linear", round(score, 6))], "model string, rmse double")


@query("ml8_factor_model")
def _(t):
    train, test = train_frame(t)
    member = ensemble.factor("log_prediction", 1.0, CATEGORIES, **FACTORS)
    out = member.fit(train, model_columns(train))(test, "log_prediction")
    return out.select("id", models.invert_log("log_prediction").alias("visitors"))


@query("v5_model_grid")
def _(t):
    train, _ = train_frame(t)
    return cross_validated_grid(
        models.linear(), {"regParam": [0.0, 0.1], "elasticNetParam": [0.0, 1.0]}, train, model_columns(train), "id", 3
    )


@query("e7_split_importance")
def _(t):
    train, _ = train_frame(t)
    columns = model_columns(train)
    model = models.fit_log_target(models.boosted_trees(**SMALL), train, columns)
    return select.split_importance(model.stages[-1], columns)


@query("e7_gain_importance")
def _(t):
    train, _ = train_frame(t)
    columns = model_columns(train)
    model = models.fit_log_target(models.boosted_trees(**SMALL), train, columns)
    return select.gain_importance(model.stages[-1], columns)


def members():
    return [
        ensemble.spark_ml("trees", 0.2, models.boosted_trees(**SMALL)),
        ensemble.spark_ml("sampled_trees", 0.4, models.boosted_trees_with_column_sampling(**SMALL)),
        ensemble.factor("factors", 0.4, CATEGORIES, words=False, **FACTORS),
    ]


@query("v9_holdout_report")
def _(t):
    train, _ = train_frame(t, grouped="month")
    return ensemble.holdout_report(train, model_columns(train), members())


@query("b3_ensemble_forecast")
def _(t):
    train, test = train_frame(t)
    model = ensemble.fit_and_predict(train, test, model_columns(train), members())
    baseline = baseline_forecast(t.visits(), t.calendar(), t.targets(), levels=1)
    return ensemble.final_forecast(model, baseline)


@query("ml3_knn_forecast")
def _(t):
    train, test = train_frame(t)
    member = ensemble.neighbours("log_prediction", 1.0, 4)
    out = member.fit(train, model_columns(train))(test, "log_prediction")
    return out.select("id", models.invert_log("log_prediction").alias("visitors"))
