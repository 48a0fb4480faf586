"""Recency-weighted log-mean baseline and its hierarchical fallback lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venueflow.functions.columns import rmse, weighted_mean


def enrich_with_calendar(
    facts: DataFrame, calendar: DataFrame, date: str, calendar_date: str = "calendar_date"
) -> DataFrame:
    """Left join calendar columns onto dated rows; the fact's own date column is kept.

    Spark broadcasts the calendar by its size (one row per date). Where both tables have a column of
    the same name, the fact's is kept.
    """
    extra = [c for c in calendar.columns if c != calendar_date and c not in facts.columns]
    side = calendar.select(F.col(calendar_date).alias(date), *extra)
    return facts.join(side, date, "left")


def weighted_log_means(
    facts: DataFrame,
    keys: Sequence[str],
    measure: str = "visitors",
    weight: str = "weight",
    name: str = "wmean",
) -> DataFrame:
    """sum(w*log1p(v))/sum(w) per key combination; rows with a missing key form no group.

    Partial aggregation keeps a hot key from ever reaching one task as rows.
    """
    known = facts.dropna(subset=list(keys))
    return known.groupBy(*keys).agg(weighted_mean(F.log1p(F.col(measure)), weight).alias(name))


def mean_of_means(baseline: DataFrame, entity: str, name: str = "wmean") -> DataFrame:
    """Unweighted mean of an entity's group means (the last fallback level)."""
    return baseline.groupBy(entity).agg(F.avg(name).alias(name))


def sweep_exponents(
    facts: DataFrame, keys: Sequence[str], weights: Sequence[str], measure: str = "visitors"
) -> DataFrame:
    """Weighted log means for several weight columns in a single aggregation."""
    known = facts.dropna(subset=list(keys))
    value = F.log1p(F.col(measure))
    return known.groupBy(*keys).agg(*[weighted_mean(value, w).alias(w) for w in weights])


def score_exponents(
    dated: DataFrame, held: Column, keys: Sequence[str], weights: dict[int, str], measure: str = "visitors"
) -> DataFrame:
    """(exponent, n_scored, rmsle): each exponent's baseline from the rows not held out, scored on the held ones.

    ``weights`` maps exponents to weight columns of ``dated``; all of them share one aggregation and one join.
    """
    means = sweep_exponents(dated.filter(~held), keys, list(weights.values()), measure)
    truth = dated.filter(held).select(*keys, F.log1p(F.col(measure)).alias("_truth"))
    wide = truth.join(means, list(keys)).agg(
        F.count(F.lit(1)).alias("n_scored"), *[rmse("_truth", w).alias(w) for w in weights.values()]
    )
    rows = F.explode(F.array(*[F.struct(F.lit(p).alias("exponent"), F.col(w).alias("rmsle")) for p, w in weights.items()]))
    return wide.select("n_scored", rows.alias("r")).select("r.exponent", "n_scored", "r.rmsle")


def _entity_profile(baseline: DataFrame, entity: str, context: Sequence[str], name: str) -> DataFrame:
    # At most one map entry per context combination (7 weekdays x 2 flags, x12 with months).
    entry = F.struct(F.struct(*context), F.col(name))
    return baseline.groupBy(entity).agg(
        F.map_from_entries(F.collect_list(entry)).alias("_by_context"),
        F.avg(name).alias("_overall"),
    )


def lookup_baseline(
    targets: DataFrame,
    baseline: DataFrame,
    entity: str,
    context: Sequence[str],
    holiday: str = "holiday_flg",
    levels: int = 3,
    name: str = "wmean",
    level_name: str | None = None,
) -> DataFrame:
    """Attach the baseline to target rows, falling back level by level (still in log space).

    1. same entity and context; 2. same context with the holiday flag 0; 3. the entity's mean of
    group means. ``levels=1`` gives the plain lookup. All levels come from one join: the baseline
    is first folded into one row per entity with a map of its contexts, so the context columns must
    be few-valued ones such as weekday, month and flag.
    """
    if levels not in (1, 2, 3):
        raise ValueError("levels must be 1, 2 or 3")
    profile = _entity_profile(baseline, entity, context, name)
    types = dict(baseline.dtypes)

    def key(no_holiday: bool) -> Column:
        parts = [
            (F.lit(0) if no_holiday and c == holiday else F.col(c)).cast(types[c]).alias(c) for c in context
        ]
        return F.struct(*parts)

    steps = [
        F.element_at("_by_context", key(False)),
        F.element_at("_by_context", key(True)),
        F.col("_overall"),
    ][:levels]
    joined = targets.join(profile, entity, "left").withColumn(name, F.coalesce(*steps))
    if level_name is not None:
        level = F.when(steps[0].isNotNull(), F.lit(1))
        for i, step in enumerate(steps[1:], start=2):
            level = level.when(step.isNotNull(), F.lit(i))
        joined = joined.withColumn(level_name, level)
    return joined.drop("_by_context", "_overall")
