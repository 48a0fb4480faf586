"""Model-free forecast: the recency-weighted baseline from calendar to predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from venueflow.functions.columns import split_date, split_entity
from venueflow.operators.baseline import enrich_with_calendar, lookup_baseline, weighted_log_means
from venueflow.operators.calendar import clear_weekend_holidays, with_recency_weights


def weighted_calendar(calendar: DataFrame, exponent: float = 5.0) -> DataFrame:
    return with_recency_weights(clear_weekend_holidays(calendar), exponents=(exponent,))


def fit_baseline(
    visits: DataFrame,
    calendar: DataFrame,
    entity: str = "store_id",
    date: str = "visit_date",
    measure: str = "visitors",
    context: Sequence[str] = ("day_of_week", "holiday_flg"),
) -> DataFrame:
    """Log-mean per entity and context. ``calendar`` already carries ``weight``."""
    dated = enrich_with_calendar(visits.select(entity, date, measure), calendar, date)
    if "month" in context:
        dated = dated.withColumn("month", F.month(date))
    return weighted_log_means(dated, [entity, *context], measure)


def parse_targets(targets: DataFrame, entity: str = "store_id", date: str = "visit_date") -> DataFrame:
    """Split ``id`` into entity and date; the placeholder measure is dropped."""
    return targets.select("id", split_entity("id").alias(entity), split_date("id").alias(date))


def baseline_forecast(
    visits: DataFrame,
    calendar: DataFrame,
    targets: DataFrame,
    entity: str = "store_id",
    date: str = "visit_date",
    measure: str = "visitors",
    context: Sequence[str] = ("day_of_week", "holiday_flg"),
    exponent: float = 5.0,
    levels: int = 3,
    level_name: str | None = None,
) -> DataFrame:
    """Forecast every target id. Missing forecasts stay null (none with three levels and history)."""
    cal = weighted_calendar(calendar, exponent)
    baseline = fit_baseline(visits, cal, entity, date, measure, context)
    rows = enrich_with_calendar(parse_targets(targets, entity, date), cal.drop("weight"), date)
    if "month" in context:
        rows = rows.withColumn("month", F.month(date))
    filled = lookup_baseline(rows, baseline, entity, context, levels=levels, level_name=level_name)
    out = ["id", entity, date, F.expm1("wmean").alias(measure)]
    return filled.select(*out, *([level_name] if level_name else []))


def add_baseline_feature(
    rows: DataFrame,
    visits: DataFrame,
    calendar: DataFrame,
    entity: str = "store_id",
    date: str = "visit_date",
    measure: str = "visitors",
    context: Sequence[str] = ("day_of_week", "holiday_flg"),
    before=None,
    name: str = "baseline_feature",
) -> DataFrame:
    """Add the baseline forecast as a feature to dated rows of either frame.

    By default the baseline is fitted on all visits, so training rows see their own value. Give
    ``before`` (a date) to fit on earlier visits only.
    """
    cal = weighted_calendar(calendar)
    history = visits if before is None else visits.filter(F.col(date) < F.lit(before))
    baseline = fit_baseline(history, cal, entity, date, measure, context)
    added = [c for c in context if c not in rows.columns]
    dated = enrich_with_calendar(rows, cal.drop("weight"), date)
    if "month" in added:
        dated = dated.withColumn("month", F.month(date))
    filled = lookup_baseline(dated, baseline.withColumnRenamed("wmean", "_log"), entity, context, name="_log")
    extra = [c for c in dated.columns if c not in rows.columns]
    return filled.withColumn(name, F.expm1("_log")).drop("_log", *extra)


def add_prior_baseline(
    rows: DataFrame,
    visits: DataFrame,
    calendar: DataFrame,
    entity: str = "store_id",
    date: str = "visit_date",
    measure: str = "visitors",
    context: Sequence[str] = ("day_of_week", "holiday_flg"),
    holiday: str = "holiday_flg",
    exponent: float = 5.0,
    levels: int = 3,
    name: str = "prior_baseline",
    level_name: str | None = None,
) -> DataFrame:
    """Add to every dated row the baseline forecast that strictly earlier visits give, with the usual fallback levels.

    A visit weighs its date's rank to the power ``exponent``; the rank's scale cancels in a weighted
    mean, so what a date knows are two running sums per entity and context, and one pass serves all
    dates. Visits are first summed per entity and date, so an entity holds at most one row per date
    in the running sums, however many visits it has; its contexts, few-valued columns of the
    calendar, are columns there. The third level is the mean of the means known at that date. Rows
    without entity or date, before an entity's first visit, or on a date the calendar lacks have no
    value. Other columns pass through; ``name`` and ``level_name`` are replaced.
    """
    if levels not in (1, 2, 3):
        raise ValueError("levels must be 1, 2 or 3")
    days = weighted_calendar(calendar, exponent)
    kept = [c for c in rows.columns if c not in (name, level_name)]
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in context])
    bare = F.concat_ws("|", *[F.lit("0") if c == holiday else F.coalesce(F.col(c).cast("string"), F.lit("")) for c in context])
    if "month" in context:
        days = days.withColumn("month", F.month("calendar_date"))
    days = days.select(F.col("calendar_date").alias("_day"), key.alias("_own"), bare.alias("_bare"), F.col("weight").cast("double").alias("_w"))
    names = sorted(r["_own"] for r in days.select("_own").distinct().collect())  # one per weekday, flag and month: bounded by the calendar's columns
    asked = rows.select(F.col(entity).alias("_entity"), F.col(date).alias("_day"), F.lit(None).cast("double").alias("_v")).dropna(subset=["_entity", "_day"])
    seen = visits.select(F.col(entity).alias("_entity"), F.col(date).alias("_day"), F.log1p(F.col(measure)).alias("_v")).dropna()
    daily = seen.union(asked.distinct()).groupBy("_entity", "_day").agg(F.sum("_v").alias("_sum"), F.count("_v").alias("_n"))
    daily = daily.join(days, "_day")
    earlier = Window.partitionBy("_entity").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    here = lambda c, value: F.sum(F.when((F.col("_own") == c) & (F.col("_n") > 0), value)).over(earlier)
    means = F.array(*[here(c, F.col("_w") * F.col("_sum")) / here(c, F.col("_w") * F.col("_n")) for c in names])
    daily = daily.select("_entity", "_day", "_own", "_bare", means.alias("_means"))
    mean_of = lambda c: F.get("_means", F.array_position(F.lit(names), F.col(c)).cast("int") - 1)
    known = F.filter("_means", lambda m: m.isNotNull())
    overall = F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda a, m: a + m) / F.size(known))
    steps = [mean_of("_own"), mean_of("_bare"), overall][:levels]
    level = F.coalesce(*[F.when(s.isNotNull(), F.lit(i)) for i, s in enumerate(steps, start=1)])
    told = daily.select("_entity", "_day", F.expm1(F.coalesce(*steps)).alias("_value"), level.alias("_level"))
    joined = rows.join(told, (rows[entity] == told["_entity"]) & (rows[date] == told["_day"]), "left")
    extra = [F.col("_level").alias(level_name)] if level_name else []
    return joined.select(*[rows[c] for c in kept], F.col("_value").alias(name), *extra)
