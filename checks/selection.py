"""Neighbours, grid search, folds, feature scores, metrics and blends."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.registry import query
from venueflow.functions.columns import make_id
from venueflow.operators import approximate, blend, evaluate, knn, select, split
from venueflow.operators.baseline import enrich_with_calendar, lookup_baseline, mean_of_means
from venueflow.plans.forecast import add_baseline_feature, add_prior_baseline, baseline_forecast, fit_baseline, weighted_calendar
from venueflow.plans.tuning import refit_best_neighbours

# ---- neighbours on the vector table ----

_VEC = "SELECT vec_id, cast(embedding AS double[]) AS vec, label FROM embeddings"


def neighbours_sql(k, extra="", cond="TRUE", source=_VEC):
    return f"""SELECT * FROM (
      SELECT q.vec_id AS query_id, t.vec_id AS train_id, t.label, q.label AS truth {extra},
             list_distance(q.vec, t.vec) AS d,
             row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.vec, t.vec), t.vec_id) AS rank
      FROM ({source}) q, ({source}) t WHERE {cond}) WHERE rank <= {k}"""


def sides(t):
    v = t.vectors()
    return v.withColumnRenamed("vec_id", "query_id"), v.withColumnRenamed("vec_id", "train_id")


@query("ml3_knn_neighbours", f"SELECT query_id, train_id, cast(rank AS integer) AS rank, round(d, 6) AS distance, label FROM ({neighbours_sql(4)})")
def _(t):
    return knn.nearest(*sides(t), 4).withColumn("distance", F.round("distance", 6))


@query("ml3_knn_regression", f"SELECT query_id, round(avg(label), 6) AS prediction FROM ({neighbours_sql(4)}) GROUP BY query_id")
def _(t):
    return knn.regress(knn.nearest(*sides(t), 4)).withColumn("prediction", F.round("prediction", 6))


@query("ml3_approximate_neighbours")
def _(t):
    return approximate.nearest_approximate(*sides(t), 4)


def votes_sql(k, weight, cond="TRUE"):
    return f"""SELECT query_id, arg_min(label, [-v, label]) AS prediction FROM (
      SELECT query_id, label, sum({weight}) AS v FROM (
        SELECT *, min(d) OVER (PARTITION BY query_id) AS d0 FROM ({neighbours_sql(k, cond=cond)}))
      GROUP BY query_id, label) GROUP BY query_id"""


_INVERSE = "CASE WHEN d0 = 0 THEN (CASE WHEN d = 0 THEN 1 ELSE 0 END) ELSE 1 / d END"


@query("ml4_knn_vote_uniform", votes_sql(13, "1"))
def _(t):
    return knn.classify(knn.nearest(*sides(t), 13), 13)


@query("ml4_knn_vote_distance", votes_sql(13, _INVERSE))
def _(t):
    return knn.classify(knn.nearest(*sides(t), 13), 13, "distance")


def folded_sql(k):
    return f"SELECT *, cast(ntile({k}) OVER (PARTITION BY label ORDER BY vec_id) AS integer) AS fold FROM ({_VEC})"


@query("v4_stratified_folds", f"SELECT vec_id, label, fold FROM ({folded_sql(5)})")
def _(t):
    return split.stratified_folds(t.vectors().select("vec_id", "label"), "label", ["vec_id"], 5)


def folds(t, k):
    return split.stratified_folds(t.vectors(), "label", ["vec_id"], k)


def grid_sql(n_folds, k=30):
    found = neighbours_sql(k, ", q.fold AS fold", "q.fold <> t.fold", folded_sql(n_folds))
    return f"""
WITH found AS ({found}),
votes AS (
  SELECT p.k AS n_neighbors, w.weights, query_id, fold, truth, label,
         sum(CASE WHEN w.weights = 'uniform' THEN 1 WHEN d0 = 0 THEN (CASE WHEN d = 0 THEN 1 ELSE 0 END) ELSE 1 / d END) AS v
  FROM (SELECT *, min(d) OVER (PARTITION BY query_id) AS d0 FROM found) f
  JOIN generate_series(1, {k}) AS p(k) ON f.rank <= p.k, (VALUES ('uniform'), ('distance')) AS w(weights)
  GROUP BY ALL),
voted AS (
  SELECT n_neighbors, weights, query_id, fold, truth, arg_min(label, [-v, label]) AS prediction
  FROM votes GROUP BY ALL),
scores AS (
  SELECT cast(n_neighbors AS integer) AS n_neighbors, weights, fold,
         count(*) FILTER (prediction = truth) AS n_hits, count(*) AS n_rows
  FROM voted GROUP BY ALL),
means AS (
  SELECT n_neighbors, weights, avg(n_hits / n_rows) AS mean_score, stddev_pop(n_hits / n_rows) AS std_score, sum(n_hits) / sum(n_rows) AS pooled_score
  FROM scores GROUP BY ALL)
"""


@query("v5_grid_scores", grid_sql(5) + "SELECT n_neighbors, weights, fold, n_hits, n_rows FROM scores")
def _(t):
    return knn.grid_scores(folds(t, 5), 30)


PARAMS = ["n_neighbors", "weights"]
# Grid order: fewer neighbours first, then uniform before distance.
ORDER = ["n_neighbors", "-weights"]


@query(
    "v6_mean_scores",
    grid_sql(5) + """SELECT n_neighbors, weights, round(mean_score, 6) AS mean_score, round(std_score, 6) AS std_score,
                            round(pooled_score, 6) AS pooled_score FROM means""",
)
def _(t):
    scored = evaluate.mean_scores(knn.grid_scores(folds(t, 5), 30), PARAMS)
    return scored.withColumns({c: F.round(c, 6) for c in ("mean_score", "std_score", "pooled_score")})


@query(
    "v6_best_params",
    grid_sql(5)
    + """SELECT n_neighbors, weights, round(pooled_score, 6) AS best_score FROM means
         ORDER BY pooled_score DESC, n_neighbors, weights DESC LIMIT 1""",
)
def _(t):
    scored = evaluate.mean_scores(knn.grid_scores(folds(t, 5), 30), PARAMS)
    best = evaluate.best_params(scored, "pooled_score", ORDER)
    return best.select(*PARAMS, F.round("pooled_score", 6).alias("best_score"))


@query(
    "v7_refit_best_and_predict",
    grid_sql(5)
    + f""", best AS (SELECT * FROM means ORDER BY pooled_score DESC, n_neighbors, weights DESC LIMIT 1),
near AS ({neighbours_sql(30)}),
tally AS (
  SELECT query_id, label, sum(CASE WHEN weights = 'uniform' THEN 1 WHEN d0 = 0 THEN (CASE WHEN d = 0 THEN 1 ELSE 0 END)
    ELSE 1 / d END) AS v
  FROM (SELECT *, min(d) OVER (PARTITION BY query_id) AS d0 FROM near), best
  WHERE rank <= best.n_neighbors GROUP BY query_id, label)
SELECT query_id, arg_min(label, [-v, label]) AS prediction FROM tally GROUP BY query_id""",
)
def _(t):
    scored = evaluate.mean_scores(knn.grid_scores(folds(t, 5), 30), PARAMS)
    return refit_best_neighbours(*sides(t), scored, ORDER)


_DRAW = """, drawn AS (
  SELECT *, row_number() OVER (PARTITION BY seed ORDER BY md5(concat(seed, '|', n_neighbors, '|', weights))) AS r
  FROM means, generate_series({a}, {b}) AS g(seed))
"""


@query(
    "v8_random_search",
    grid_sql(10)
    + _DRAW.format(a=5, b=5)
    + "SELECT n_neighbors, weights, round(pooled_score, 6) AS pooled_score FROM drawn WHERE r <= 10",
)
def _(t):
    scored = evaluate.mean_scores(knn.grid_scores(folds(t, 10), 30), PARAMS)
    drawn = evaluate.random_search(scored, PARAMS, 10, [5])
    return drawn.select(*PARAMS, F.round("pooled_score", 6).alias("pooled_score"))


@query(
    "v8_repeated_random_search",
    grid_sql(10)
    + _DRAW.format(a=1, b=20)
    + "SELECT cast(seed AS integer) AS seed, round(max(pooled_score), 3) AS best_score FROM drawn WHERE r <= 10 GROUP BY seed",
)
def _(t):
    scored = evaluate.mean_scores(knn.grid_scores(folds(t, 10), 30), PARAMS)
    drawn = evaluate.random_search(scored, PARAMS, 10, range(1, 21))
    return drawn.groupBy("seed").agg(F.round(F.max("pooled_score"), 3).alias("best_score"))


@query(
    "m3_accuracy",
    f"""SELECT round(avg(CASE WHEN v.prediction = e.label THEN 1.0e0 ELSE 0 END), 6) AS accuracy
        FROM ({votes_sql(13, '1', 'q.vec_id <> t.vec_id')}) v JOIN embeddings e ON v.query_id = e.vec_id""",
)
def _(t):
    # Leave-one-out: one neighbour more, then the row itself is left out.
    found = knn.nearest(*sides(t), 14).filter(F.col("query_id") != F.col("train_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("rank"))
    others = found.withColumn("rank", rank).filter(F.col("rank") <= 13)
    voted = knn.classify(others, 13)
    truth = t.vectors().select(F.col("vec_id").alias("query_id"), "label")
    return evaluate.accuracy(voted.join(truth, "query_id"), "label", "prediction").select(
        F.round("accuracy", 6).alias("accuracy")
    )


# ---- feature scores ----

_ANOVA = """
SELECT feature, (ssb / (k - 1)) / (ssw / (n - k)) AS score FROM (
  SELECT feature, count(*) AS k, sum(n) AS n, sum(s * s / n) - sum(s) * sum(s) / sum(n) AS ssb,
         sum(q) - sum(s * s / n) AS ssw
  FROM (SELECT feature, label, count(*) AS n, sum(x) AS s, sum(x * x) AS q FROM ({cells}) GROUP BY feature, label)
  GROUP BY feature)"""
_DIMS = f"SELECT label, cast(unnest(range(len(vec))) AS integer) AS feature, unnest(vec) AS x FROM ({_VEC})"
_VISIT_CELLS = """
  SELECT visitors AS label, unnest(['latitude', 'longitude', 'dow', 'month']) AS feature,
         unnest([latitude, longitude, isodow(visit_date) - 1.0e0, cast(month(visit_date) AS double)]) AS x
  FROM visits JOIN stores USING (store_id)"""


@query("e6_anova_f_vector", f"SELECT feature, round(score, 6) AS score FROM ({_ANOVA.format(cells=_DIMS)})")
def _(t):
    return select.anova_f_vector(t.vectors(), "vec", "label").withColumn("score", F.round("score", 6))


def visit_scores(t):
    rows = t.visits().join(t.stores(), "store_id").withColumns(
        {"dow": F.weekday("visit_date"), "month": F.month("visit_date")}
    )
    return select.anova_f(rows, ["latitude", "longitude", "dow", "month"], "visitors")


@query("e6_anova_f", f"SELECT feature, round(score, 5) AS score FROM ({_ANOVA.format(cells=_VISIT_CELLS)})")
def _(t):
    return visit_scores(t).withColumn("score", F.round("score", 5))


@query("o2_sorted_scores", f"SELECT feature, round(score, 5) AS score FROM ({_ANOVA.format(cells=_VISIT_CELLS)}) ORDER BY score, feature")
def _(t):
    return visit_scores(t).orderBy("score", "feature").withColumn("score", F.round("score", 5))


@query(
    "o4_drop_lowest_features",
    f"SELECT feature FROM ({_ANOVA.format(cells=_DIMS)}) QUALIFY row_number() OVER (ORDER BY score, feature) > 12",
)
def _(t):
    return select.select_by_rank(select.anova_f_vector(t.vectors(), "vec", "label"), 12).select("feature")


@query(
    "e8_select_by_rank",
    f"SELECT feature FROM ({_ANOVA.format(cells=_DIMS)}) QUALIFY row_number() OVER (ORDER BY score, feature) > 27",
)
def _(t):
    return select.select_by_rank(select.anova_f_vector(t.vectors(), "vec", "label"), 27).select("feature")


# ---- holdouts and folds over time ----

_ORDERED = "SELECT *, row_number() OVER (ORDER BY visit_date, store_id) AS r, count(*) OVER () AS n FROM visits"


@query(
    "v1_chronological_holdout",
    f"SELECT store_id, visit_date, r > n - floor(n * 0.1e0) AS is_validation FROM ({_ORDERED})",
)
def _(t):
    out = split.chronological_holdout(t.visits(), "visit_date", ["store_id"], 0.1)
    return out.select("store_id", "visit_date", "is_validation")


@query(
    "v2_validation_inside_training",
    f"""SELECT store_id, visit_date, r > m - floor(m * 0.15e0) AS is_validation
        FROM (SELECT *, n - floor(n * 0.1e0) AS m FROM ({_ORDERED})) WHERE r <= m""",
)
def _(t):
    train, _ = split.head_tail(t.visits(), "visit_date", ["store_id"], 0.1)
    out = split.chronological_holdout(train, "visit_date", ["store_id"], 0.15)
    return out.select("store_id", "visit_date", "is_validation")


_SEGMENT = f"""SELECT store_id, visit_date, n, cast(greatest(0, 5 - (n - r) // (n // 6)) AS integer) AS segment
  FROM ({_ORDERED})"""


@query("v3_expanding_segments", f"SELECT store_id, visit_date, segment FROM ({_SEGMENT})")
def _(t):
    return split.expanding_folds(t.visits(), "visit_date", ["store_id"], 5).select("store_id", "visit_date", "segment")


@query(
    "v3_expanding_fold_sizes",
    f"""SELECT cast(fold AS integer) AS fold, count(*) FILTER (segment < fold) AS n_train,
               count(*) FILTER (segment = fold) AS n_test
        FROM ({_SEGMENT}), generate_series(1, 5) AS g(fold) GROUP BY fold""",
)
def _(t):
    return split.fold_sizes(split.expanding_folds(t.visits(), "visit_date", ["store_id"], 5), 5)


# ---- metrics and blends: forecasts scored on the held-out visits ----

# The three-level weekday lookup stands for a model, the single-level monthly one for a baseline with gaps.
_PAIR = """
  SELECT id, f.store_id, f.visit_date, f.visitors AS model, m.visitors AS baseline, m.level
  FROM forecast f JOIN month_forecast m USING (id)"""


def pair(t):
    model = baseline_forecast(t.visits(), t.calendar(), t.targets())
    context = ("month", "day_of_week", "holiday_flg")
    monthly = baseline_forecast(t.visits(), t.calendar(), t.targets(), context=context, levels=1)
    return blend.join_forecasts(model, monthly)


_LEVEL1 = "CASE WHEN level = 1 THEN baseline END"


@query("j11_join_forecasts", f"SELECT id, round(model, 6) AS model, round({_LEVEL1}, 6) AS baseline FROM ({_PAIR})")
def _(t):
    return pair(t).withColumns({c: F.round(c, 6) for c in ("model", "baseline")})


@query(
    "b1_log_space_blend",
    f"""SELECT id, round(greatest(exp(0.2 * ln(1 + model) + 0.4 * ln(1 + baseline) + 0.4 * ln(1 + model)) - 1, 0), 6)
        AS visitors FROM (SELECT id, model, {_LEVEL1} AS baseline FROM ({_PAIR})) WHERE baseline IS NOT NULL""",
)
def _(t):
    logs = pair(t).dropna(subset=["baseline"]).withColumns(
        {"m": F.log1p("model"), "b": F.log1p("baseline")}
    )
    out = blend.blend_log_predictions(logs, ["m", "b", "m"], [0.2, 0.4, 0.4])
    return out.select("id", F.round("visitors", 6).alias("visitors"))


@query(
    "b2_model_and_baseline",
    f"SELECT id, round(0.7 * model + 0.3 * 1.1 * {_LEVEL1}, 6) AS visitors FROM ({_PAIR})",
)
def _(t):
    return pair(t).select("id", F.round(blend.mix_with_baseline("model", "baseline"), 6).alias("visitors"))


@query(
    "b3_null_aware_blend",
    f"""SELECT id, round(CASE WHEN level IS DISTINCT FROM 1 THEN model ELSE 0.7 * model + 0.3 * 1.1 * baseline END, 6)
        AS visitors FROM ({_PAIR})""",
)
def _(t):
    return pair(t).select("id", F.round(blend.null_aware_mix("model", "baseline"), 6).alias("visitors"))


@query("b4_half_blend", f"SELECT id, round((model + 1.1 * {_LEVEL1}) / 2, 6) AS visitors FROM ({_PAIR})")
def _(t):
    return pair(t).select("id", F.round(blend.half_blend("model", "baseline"), 6).alias("visitors"))


@query("p11_missing_forecasts", f"SELECT id FROM ({_PAIR}) WHERE level IS DISTINCT FROM 1")
def _(t):
    return blend.missing_forecasts(pair(t), "baseline").select("id")


@query(
    "p13_compare_forecasts",
    f"""SELECT count(*) AS n_rows, count(*) FILTER (model > {_LEVEL1}) AS n_first_higher,
               round(avg(model - {_LEVEL1}), 6) AS mean_difference FROM ({_PAIR})""",
)
def _(t):
    return blend.compare_forecasts(pair(t)).withColumn("mean_difference", F.round("mean_difference", 6))


_SCORED = """
  SELECT v.visitors, exp(b.wmean) - 1 AS keyed, exp(m.wmean) - 1 AS overall
  FROM dated_visits v JOIN baseline b USING (store_id, day_of_week, holiday_flg)
  JOIN (SELECT store_id, avg(wmean) AS wmean FROM baseline GROUP BY store_id) m USING (store_id)"""


def scored(t):
    cal = weighted_calendar(t.calendar())
    means = fit_baseline(t.visits(), cal)
    rows = enrich_with_calendar(t.visits(), cal, "visit_date")
    keyed = lookup_baseline(rows, means, "store_id", ["day_of_week", "holiday_flg"], name="wmean")
    overall = mean_of_means(means, "store_id").withColumnRenamed("wmean", "all_mean")
    return keyed.join(overall, "store_id").select(
        "visitors", F.expm1("wmean").alias("keyed"), F.expm1("all_mean").alias("overall")
    )


@query("m1_rmsle", f"SELECT round(sqrt(avg(pow(ln(1 + visitors) - ln(1 + keyed), 2))), 6) AS rmsle FROM ({_SCORED})")
def _(t):
    return evaluate.rmsle(scored(t), "visitors", "keyed").select(F.round("rmsle", 6).alias("rmsle"))


@query(
    "a15_log_error",
    f"SELECT round(sqrt(avg(pow(ln(1 + visitors) - ln(1 + overall), 2))), 6) AS rmsle FROM ({_SCORED})",
)
def _(t):
    return evaluate.rmsle(scored(t), "visitors", "overall").select(F.round("rmsle", 6).alias("rmsle"))


@query(
    "v9_baseline_score_report",
    f"""SELECT 'keyed' AS model, count(*) AS n_rows, round(sqrt(avg(pow(visitors - keyed, 2))), 6) AS rmse FROM ({_SCORED})
        UNION ALL SELECT 'overall', count(*), round(sqrt(avg(pow(visitors - overall, 2))), 6) FROM ({_SCORED})""",
)
def _(t):
    return evaluate.score_report(scored(t), "visitors", ["keyed", "overall"]).withColumn("rmse", F.round("rmse", 6))


@query(
    "e9_baseline_as_feature",
    """SELECT concat(v.store_id, '_', cast(v.visit_date AS varchar)) AS id, v.visitors,
              round(exp(b.wmean) - 1, 6) AS baseline_feature
       FROM dated_visits v JOIN baseline b USING (store_id, day_of_week, holiday_flg)""",
)
def _(t):
    rows = add_baseline_feature(t.visits(), t.visits(), t.calendar())
    return rows.select(
        make_id("store_id", "visit_date").alias("id"), "visitors", F.round("baseline_feature", 6).alias("baseline_feature")
    )


@query(
    "e9_prior_baseline_as_feature",
    """WITH d AS MATERIALIZED (SELECT store_id, visit_date, visitors, day_of_week, holiday_flg, weight FROM dated_visits),
       p AS MATERIALIZED (SELECT a.store_id, a.visit_date, b.day_of_week, b.holiday_flg, sum(b.weight * ln(1 + b.visitors)) / sum(b.weight) AS wmean
         FROM d a JOIN d b ON a.store_id = b.store_id AND b.visit_date < a.visit_date GROUP BY ALL),
       o AS (SELECT store_id, visit_date, avg(wmean) AS wmean FROM p GROUP BY ALL)
       SELECT d.store_id, d.visit_date, round(exp(coalesce(p1.wmean, p2.wmean, o.wmean)) - 1, 5) AS prior_baseline,
              CASE WHEN p1.wmean IS NOT NULL THEN 1 WHEN p2.wmean IS NOT NULL THEN 2 WHEN o.wmean IS NOT NULL THEN 3 ELSE 0 END AS level
       FROM d LEFT JOIN p p1 ON p1.store_id = d.store_id AND p1.visit_date = d.visit_date AND p1.day_of_week = d.day_of_week
                            AND p1.holiday_flg = d.holiday_flg
       LEFT JOIN p p2 ON p2.store_id = d.store_id AND p2.visit_date = d.visit_date AND p2.day_of_week = d.day_of_week AND p2.holiday_flg = 0
       LEFT JOIN o ON o.store_id = d.store_id AND o.visit_date = d.visit_date""",
)
def _(t):
    rows = add_prior_baseline(t.visits(), t.visits(), t.calendar(), level_name="level")
    return rows.select("store_id", "visit_date", F.round("prior_baseline", 5).alias("prior_baseline"), F.coalesce("level", F.lit(0)).alias("level"))
