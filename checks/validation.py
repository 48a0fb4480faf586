"""Validation plans with models that SQL can fit: least squares on one feature, trees on two-valued features."""

from pyspark.sql import functions as F

from checks.modelling import _ONE, one_feature
from checks.registry import query
from venueflow.operators import blend, models
from venueflow.operators.boosting import ColumnSampledBoosting, drawn_columns
from venueflow.operators.split import chronological_holdout
from venueflow.plans import validation
from venueflow.session import materialize

_ONE_SEGMENTS = f"""
  SELECT *, cast(greatest(0, 5 - (n - r) // (n // 6)) AS integer) AS segment
  FROM (SELECT *, row_number() OVER (ORDER BY visit_date, store_id) AS r, count(*) OVER () AS n FROM ({_ONE}))"""
_FOLD_SCORES = f"""
  SELECT 'linear' AS model, cast(fold AS integer) AS fold, any_value(n_train) AS n_train, count(*) AS n_test, sqrt(avg(pow(y - a - b * x, 2))) AS rmsle
  FROM s JOIN (SELECT fold, regr_intercept(y, x) AS a, regr_slope(y, x) AS b, count(*) AS n_train
               FROM s, generate_series(1, 5) AS g(fold) WHERE segment < fold GROUP BY fold) f ON s.segment = f.fold
  GROUP BY fold"""


def linear_folds(t):
    rows = materialize(one_feature(t), "one-feature")
    return validation.expanding_window_scores(rows, "visit_date", ["store_id"], ["x"], {"linear": models.linear()})


@query(
    "v3_expanding_window_scores",
    f"WITH s AS ({_ONE_SEGMENTS}) SELECT * REPLACE (round(rmsle, 6) AS rmsle) FROM ({_FOLD_SCORES})",
)
def _(t):
    return linear_folds(t).withColumn("rmsle", F.round("rmsle", 6))


@query(
    "v3_mean_over_folds",
    f"""WITH s AS ({_ONE_SEGMENTS}) SELECT model, count(*) AS n_folds, round(avg(rmsle), 6) AS mean_rmsle,
        round(sqrt(sum(rmsle * rmsle * n_test) / sum(n_test)), 6) AS pooled_rmsle FROM ({_FOLD_SCORES}) GROUP BY model""",
)
def _(t):
    return validation.mean_over_folds(linear_folds(t)).withColumns({c: F.round(c, 6) for c in ("mean_rmsle", "pooled_rmsle")})


# Two-valued features make a tree of depth 1 the shrunk means of two groups.

BOOST = dict(rounds=2, depth=1, rate=0.2, rows=1.0, columns=0.5, ridge=1.0, seed=3, validation="is_validation")
_FLAGS = ("weekend", "late")
_TREE_1, _TREE_2 = (drawn_columns(_FLAGS, BOOST["columns"], BOOST["seed"], i)[0] for i in (1, 2))
_FLAGGED = f"""
  SELECT store_id, visit_date, ln(1 + visitors) AS y, isodow(visit_date) >= 6 AS weekend, month(visit_date) >= 7 AS late,
         r > n - floor(n * 0.15e0) AS held
  FROM (SELECT *, row_number() OVER (ORDER BY visit_date, store_id) AS r, count(*) OVER () AS n FROM visits)"""
_ROUNDS = f"""
WITH d AS MATERIALIZED ({_FLAGGED}),
f0 AS (SELECT *, (SELECT avg(y) FROM d WHERE NOT held) AS p0 FROM d),
f1 AS (SELECT f0.*, p0 + v AS p1 FROM f0 JOIN
       (SELECT {_TREE_1}, 0.2e0 * sum(y - p0) / (count(*) + 1) AS v FROM f0 WHERE NOT held GROUP BY {_TREE_1}) USING ({_TREE_1})),
f2 AS (SELECT f1.*, p1 + v AS p2 FROM f1 JOIN
       (SELECT {_TREE_2}, 0.2e0 * sum(y - p1) / (count(*) + 1) AS v FROM f1 WHERE NOT held GROUP BY {_TREE_2}) USING ({_TREE_2}))"""


def two_rounds(t):
    weekend = F.when(F.weekday("visit_date") >= 5, 1.0).otherwise(0.0)
    late = F.when(F.month("visit_date") >= 7, 1.0).otherwise(0.0)
    rows = t.visits().withColumns({"weekend": weekend, "late": late})
    rows = materialize(chronological_holdout(rows, "visit_date", ["store_id"], 0.15), "flagged")
    return rows, ColumnSampledBoosting(**BOOST).fit(rows, _FLAGS)


@query("ml2_two_rounds_one_column_each", f"{_ROUNDS} SELECT store_id, visit_date, round(p2, 6) AS log_prediction FROM f2")
def _(t):
    rows, model = two_rounds(t)
    return model.predict_log(rows, "p").select("store_id", "visit_date", F.round("p", 6).alias("log_prediction"))


@query(
    "m2_rmsle_by_round",
    f"""{_ROUNDS} SELECT cast(round AS integer) AS round, round(sqrt(avg(CASE WHEN NOT held THEN pow(y - p, 2) END)), 6) AS train_rmsle,
        round(sqrt(avg(CASE WHEN held THEN pow(y - p, 2) END)), 6) AS validation_rmsle
        FROM (SELECT unnest([0, 1, 2]) AS round, unnest([p0, p1, p2]) AS p, y, held FROM f2) GROUP BY 1""",
)
def _(t):
    rows, model = two_rounds(t)
    scores = model.scores_by_round(rows)
    return scores.select("round", *[F.round(c, 6).alias(c) for c in ("train_rmsle", "validation_rmsle")])


@query(
    "v2_rounds_kept_by_early_stop",
    f"""WITH d AS MATERIALIZED ({_FLAGGED}),
        f0 AS (SELECT *, (SELECT avg(y) FROM d WHERE NOT held) AS p0 FROM d),
        g AS (SELECT weekend, sum(y - p0) AS g, count(*) AS n FROM f0 WHERE NOT held GROUP BY weekend),
        k AS (SELECT unnest(range(0, 7)) AS round),
        e AS (SELECT round, avg(pow(y - p0 - g / n * (1 - pow(1 - 0.9e0 * n / (n + 1), round)), 2)) AS error
              FROM f0 JOIN g USING (weekend), k WHERE held GROUP BY round),
        stop AS (SELECT min(round) AS round FROM (SELECT round, round - arg_min(round, error) OVER (ORDER BY round) AS since FROM e) WHERE since >= 2)
        SELECT arg_min(round, error) AS rounds_kept, max(round) AS rounds_run
        FROM e WHERE round <= coalesce((SELECT round FROM stop), 6)""",
)
def _(t):
    """Repeated splits on one feature shrink its groups' residuals by the same factor; the flagged rows say when to stop."""
    rows, _ = two_rounds(t)
    model = ColumnSampledBoosting(rounds=6, depth=1, rate=0.9, rows=1.0, columns=1.0, validation="is_validation", patience=2).fit(rows, ["weekend"])
    return t.spark.createDataFrame([(len(model.trees), len(model.errors) - 1)], "rounds_kept long, rounds_run long")


@query(
    "e8_backward_elimination",
    f"""WITH d AS MATERIALIZED ({_FLAGGED}),
        g AS (SELECT feature, sum(n * m * m) AS gain FROM (
              SELECT 'weekend' AS feature, count(*) AS n, avg(y) - (SELECT avg(y) FROM d WHERE NOT held) AS m FROM d WHERE NOT held GROUP BY weekend
              UNION ALL SELECT 'late', count(*), avg(y) - (SELECT avg(y) FROM d WHERE NOT held) FROM d WHERE NOT held GROUP BY late) GROUP BY feature),
        b AS (SELECT arg_max(feature, gain) AS used, arg_min(feature, gain) AS unused FROM g),
        x AS (SELECT held, y, CASE WHEN used = 'weekend' THEN weekend ELSE late END AS x FROM d, b),
        e AS (SELECT round(sqrt(avg(pow(y - p, 2))), 6) AS rmsle
              FROM x JOIN (SELECT x, avg(y) AS p FROM x WHERE NOT held GROUP BY x) USING (x) WHERE held)
        SELECT 0 AS step, 2 AS n_columns, '' AS dropped, rmsle FROM e UNION ALL SELECT 1, 1, unused, rmsle FROM e, b""",
)
def _(t):
    """One tree with one split uses the better of two columns; the other goes, and the refit scores the same."""
    rows, _ = two_rounds(t)
    stump = models.boosted_trees(rounds=1, depth=1, rows=1.0)
    out = validation.backward_elimination(rows.filter("not is_validation"), rows.filter("is_validation"), _FLAGS, stump, [1])
    return out.select("step", "n_columns", F.array_join("dropped", ",").alias("dropped"), F.round("rmsle", 6).alias("rmsle"))


@query("v8_successive_halving")
def _(t):
    """Eight drawn penalties, halved three times on growing shares of the visits."""
    rows = materialize(one_feature(t).withColumns({"dow": F.weekday("visit_date").cast("double"), "day": F.dayofmonth("visit_date").cast("double")}), "halving")
    draws = validation.drawn_sets({"regParam": [0.0, 0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0]}, 8, seed=1)
    place = F.pmod(F.xxhash64("store_id", "visit_date"), F.lit(1 << 20)) / float(1 << 20)
    return validation.successive_halving(rows, place, ["x", "dow", "day"], models.linear(), draws)


_MEMBERS = ("by_store", "by_weekday", "overall")
_MEMBER_SQL = """SELECT ln(1 + visitors) AS y, avg(ln(1 + visitors)) OVER (PARTITION BY store_id) AS by_store,
  avg(ln(1 + visitors)) OVER (PARTITION BY isodow(visit_date)) AS by_weekday, avg(ln(1 + visitors)) OVER () AS overall FROM visits"""


def members_of(t):
    rows = t.visits().withColumns({"y": F.log1p("visitors"), "dow": F.weekday("visit_date")})
    rows = materialize(rows, "member-rows")
    by = lambda c, name: rows.groupBy(c).agg(F.avg("y").alias(name))
    overall = rows.agg(F.avg("y")).first()[0]
    return rows.join(by("store_id", "by_store"), "store_id").join(by("dow", "by_weekday"), "dow").withColumn("overall", F.lit(overall))


@query(
    "b1_weight_grid",
    f"""SELECT concat(i, '/', j) AS blend, count(*) AS n_rows,
               round(sqrt(avg(pow(y - (i * by_store + j * by_weekday + (4 - i - j) * overall) / 4.0e0, 2))), 6) AS rmse
        FROM ({_MEMBER_SQL}), generate_series(0, 4) AS a(i), generate_series(0, 4) AS b(j) WHERE i + j <= 4 GROUP BY i, j""",
)
def _(t):
    """Fifteen blends of three members from one aggregation, against one pass each in SQL."""
    blends = {f"{i}/{j}": [i / 4, j / 4, (4 - i - j) / 4] for i in range(5) for j in range(5 - i)}
    out = blend.weight_report(members_of(t), "y", _MEMBERS, blends)
    return out.filter(F.col("blend").contains("/")).select("blend", "n_rows", F.round("rmse", 6).alias("rmse"))


@query(
    "b1_best_weights",
    f"""SELECT count(*) AS n_rows, true AS beats_the_grid FROM ({_MEMBER_SQL})""",
)
def _(t):
    """No blend on a grid of tenths is better than the weights found."""
    gram, n = blend.error_gram(members_of(t), "y", _MEMBERS)
    best = blend.blend_rmse(gram, blend.best_convex_weights(gram))
    grid = [blend.blend_rmse(gram, [i / 10, j / 10, (10 - i - j) / 10]) for i in range(11) for j in range(11 - i)]
    return t.spark.createDataFrame([(n, bool(best <= min(grid) + 1e-12))], "n_rows long, beats_the_grid boolean")
