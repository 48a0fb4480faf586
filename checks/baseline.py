"""Flagship baseline: weights, weighted log means, fallback lookup."""

from pyspark.sql import functions as F

from checks.registry import query
from venueflow.operators.baseline import enrich_with_calendar, lookup_baseline, mean_of_means, score_exponents
from venueflow.operators.calendar import clear_weekend_holidays, with_recency_weights
from venueflow.plans.forecast import baseline_forecast, fit_baseline, weighted_calendar
from venueflow.plans.runs import baseline_run
from venueflow.session import new_shared_path
from venueflow.sources.tables import read_table, write_csv


@query("p8_weekend_holidays", "SELECT calendar_date, day_of_week, holiday_flg FROM weekday_calendar")
def _(t):
    return clear_weekend_holidays(t.calendar())


@query("o5_recency_weight", "SELECT calendar_date, round(weight, 6) AS weight FROM weighted_calendar")
def _(t):
    return weighted_calendar(t.calendar()).select("calendar_date", F.round("weight", 6).alias("weight"))


@query(
    "j4_visits_with_calendar",
    """SELECT store_id, visit_date, visitors, day_of_week, holiday_flg, round(weight, 6) AS weight FROM dated_visits""",
)
def _(t):
    return enrich_with_calendar(t.visits(), weighted_calendar(t.calendar()), "visit_date").withColumn(
        "weight", F.round("weight", 6)
    )


@query(
    "a8_recency_weighted_mean",
    "SELECT store_id, day_of_week, holiday_flg, round(wmean, 6) AS wmean FROM baseline",
)
def _(t):
    return fit_baseline(t.visits(), weighted_calendar(t.calendar())).withColumn("wmean", F.round("wmean", 6))


@query(
    "a9_monthly_weighted_mean",
    "SELECT store_id, month, day_of_week, holiday_flg, round(wmean, 6) AS wmean FROM month_baseline",
)
def _(t):
    context = ("month", "day_of_week", "holiday_flg")
    return fit_baseline(t.visits(), weighted_calendar(t.calendar()), context=context).withColumn(
        "wmean", F.round("wmean", 6)
    )


@query("a10_mean_of_means", "SELECT store_id, round(avg(wmean), 6) AS wmean FROM baseline GROUP BY store_id")
def _(t):
    means = mean_of_means(fit_baseline(t.visits(), weighted_calendar(t.calendar())), "store_id")
    return means.withColumn("wmean", F.round("wmean", 6))


@query(
    "j9_fallback_forecast",
    "SELECT id, store_id, visit_date, round(visitors, 6) AS visitors, level FROM forecast",
)
def _(t):
    out = baseline_forecast(t.visits(), t.calendar(), t.targets(), level_name="level")
    return out.withColumn("visitors", F.round("visitors", 6))


@query(
    "j9_fallback_forecast_by_month",
    "SELECT id, store_id, visit_date, round(visitors, 6) AS visitors, level FROM month_forecast",
)
def _(t):
    context = ("month", "day_of_week", "holiday_flg")
    out = baseline_forecast(t.visits(), t.calendar(), t.targets(), context=context, level_name="level")
    return out.withColumn("visitors", F.round("visitors", 6))


@query(
    "j10_single_level_lookup",
    """SELECT id, round(coalesce(CASE WHEN level = 1 THEN visitors END, -1), 6) AS visitors FROM month_forecast""",
)
def _(t):
    context = ("month", "day_of_week", "holiday_flg")
    out = baseline_forecast(t.visits(), t.calendar(), t.targets(), context=context, levels=1)
    return out.select("id", F.round(F.coalesce("visitors", F.lit(-1.0)), 6).alias("visitors"))


@query(
    "o6_exponent_sweep",
    """
WITH history AS (
  SELECT v.*, c.day_of_week, c.holiday_flg, c.rk, c.n
  FROM visits v
  LEFT JOIN (SELECT *, cast(row_number() OVER (ORDER BY calendar_date) AS double) AS rk, count(*) OVER () AS n
             FROM weekday_calendar) c ON v.visit_date = c.calendar_date),
means AS (
  SELECT p, store_id, day_of_week, holiday_flg,
         sum(pow(rk / n, p) * ln(1 + visitors)) / sum(pow(rk / n, p)) AS wmean
  FROM history, span, generate_series(1, 5) AS e(p)
  WHERE visit_date <= last_day - INTERVAL 39 DAY GROUP BY ALL)
SELECT cast(p AS integer) AS exponent, count(*) AS n_scored,
       round(sqrt(avg(pow(ln(1 + visitors) - wmean, 2))), 6) AS rmsle
FROM history JOIN means USING (store_id, day_of_week, holiday_flg), span
WHERE visit_date > last_day - INTERVAL 39 DAY
GROUP BY p""",
)
def _(t):
    exponents = (1, 2, 3, 4, 5)
    names = [f"w{p}" for p in exponents]
    cal = with_recency_weights(clear_weekend_holidays(t.calendar()), exponents=exponents, names=names)
    dated = enrich_with_calendar(t.visits(), cal, "visit_date")
    cut = F.date_sub(F.lit(t.last_visit()["last_day"]), 39)
    keys = ["store_id", "day_of_week", "holiday_flg"]
    scores = score_exponents(dated, F.col("visit_date") > cut, keys, dict(zip(exponents, names)))
    return scores.withColumn("rmsle", F.round("rmsle", 6))


@query("s4_baseline_run_from_csv", "SELECT id, printf('%.4f', visitors) AS visitors FROM forecast")
def _(t):
    folder = new_shared_path(t.spark, "inputs")
    write_csv(t.visits().withColumnRenamed("store_id", "air_store_id"), f"{folder}/air_visit_data.csv")
    write_csv(t.calendar(), f"{folder}/date_info.csv")
    write_csv(t.targets(), f"{folder}/sample_submission.csv")
    baseline_run(t.spark, folder, f"{folder}/forecast")
    return read_table(t.spark, f"{folder}/forecast", "id string, visitors string")
