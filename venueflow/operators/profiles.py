"""Grouped profiles, reservation features, grids and other table-level features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venueflow.functions.columns import day, lead_days, weekday


def date_parts(df: DataFrame, date: str = "visit_date") -> DataFrame:
    return df.withColumns({"dow": weekday(date), "year": F.year(date), "month": F.month(date)})


def profile(
    df: DataFrame,
    keys: Sequence[str],
    measure: str = "visitors",
    prefix: str = "",
    count_nulls: bool = False,
    median: str = "exact",
    accuracy: int = 1000,
) -> DataFrame:
    """Minimum, mean, median, maximum and count of a measure per key.

    ``median='exact'`` takes one aggregation and keeps a counter per distinct value of a group,
    which suits daily counts. ``'bracketed'`` is exact too, for measures with very many distinct
    values in a group: see ``bracketed_median``. ``'approximate'`` is percentile_approx.
    ``count_nulls`` counts rows instead of values. Rows with a missing key are left out.
    """
    df = df.dropna(subset=list(keys))
    m = F.col(measure)
    median_name = f"{prefix}median_{measure}"
    middle = {
        "exact": F.median(m),
        "approximate": F.percentile_approx(m, 0.5, accuracy).cast("double"),
        "bracketed": F.lit(None).cast("double"),
    }[median]
    out = df.groupBy(*keys).agg(
        F.min(m).alias(f"{prefix}min_{measure}"),
        F.avg(m).alias(f"{prefix}mean_{measure}"),
        middle.alias(median_name),
        F.max(m).alias(f"{prefix}max_{measure}"),
        F.count(F.lit(1) if count_nulls else m).alias(f"{prefix}count_observations"),
    )
    if median != "bracketed":
        return out
    exact = bracketed_median(df, keys, measure, "_median", accuracy)
    return out.join(exact, list(keys), "left").withColumn(median_name, F.col("_median")).drop("_median")


def bracketed_median(
    df: DataFrame, keys: Sequence[str], measure: str, name: str = "median", accuracy: int = 1000
) -> DataFrame:
    """Exact interpolated median per key that never holds a group's values in one task.

    A mergeable sketch brackets the middle, everything below the bracket is only counted, and the
    values inside it (about 4/accuracy of the group) are counted per distinct value and ranked.
    Rows with a missing key are left out.
    """
    rows = df.dropna(subset=[*keys, measure]).select(*keys, F.col(measure).alias("_v"))
    edge = 2.0 / accuracy
    sketch = rows.groupBy(*keys).agg(
        F.count("_v").alias("_n"), F.percentile_approx("_v", [0.5 - edge, 0.5 + edge], accuracy).alias("_b")
    )
    low, high = F.element_at("_b", 1), F.element_at("_b", 2)
    inside = rows.join(sketch, list(keys)).filter(F.col("_v") <= high)
    counts = (
        inside.withColumn("_value", F.when(F.col("_v") >= low, F.col("_v")))
        .groupBy(*keys, "_n", "_value")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    in_order = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_value"))
    before = F.coalesce(F.sum("_c").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("_before", before)

    def holds(rank: Column) -> Column:
        return ((F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_c"))).cast("int")

    hits = holds(F.floor((F.col("_n") - 1) / 2)) + holds(F.floor(F.col("_n") / 2))
    return (
        counts.withColumn("_hits", hits)
        .filter("_hits > 0")
        .groupBy(*keys)
        .agg((F.sum(F.col("_value") * F.col("_hits")) / 2).alias(name))
    )


def profiles_at(
    df: DataFrame,
    grains: Mapping[str, Sequence[str]],
    measure: str = "visitors",
    side: DataFrame | None = None,
    entity: str = "store_id",
    count_nulls: bool = False,
) -> DataFrame:
    """The profiles of several grains from one scan: a row per grain and key.

    Rows are first counted per distinct value of the finest key, and these counts merge upwards into
    every grain, the exact median included. ``side`` holds further keys, one row per ``entity``;
    it joins the counts instead of the rows. Returns (grain, every key, minimum, mean, median,
    maximum, count); keys that a grain does not use are null, rows with a missing key of a grain are
    left out of it. ``count_nulls`` counts rows instead of values. See ``at_grain``.
    """
    keys = list(dict.fromkeys(k for ks in grains.values() for k in ks))
    sets = {frozenset(ks): name for name, ks in grains.items()}
    if len(sets) < len(grains):
        raise ValueError("two grains with the same keys")
    lent = [k for k in keys if side is not None and k in side.columns and k != entity]
    finest = [k for k in keys if k not in lent]
    if lent and entity not in finest:
        finest.append(entity)
    counts = df.groupBy(*finest, F.col(measure).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    if lent:
        counts = counts.join(side.select(entity, *lent), entity, "left")
    v, c = F.col("_v"), F.col("_c")
    valued = F.when(v.isNotNull(), c)
    # Bit by bit from the left, grouping_id tells the keys left out of a grain.
    ids = {name: int("".join("0" if k in ks else "1" for k in keys), 2) for ks, name in sets.items()}
    merged = counts.groupingSets([list(ks) for ks in grains.values()], *keys).agg(
        F.grouping_id().alias("_g"),
        F.min(v).alias(f"min_{measure}"),
        (F.sum(v * c) / F.sum(valued)).alias(f"mean_{measure}"),
        F.percentile(v, 0.5, c).alias(f"median_{measure}"),
        F.max(v).alias(f"max_{measure}"),
        F.coalesce(F.sum(c if count_nulls else valued), F.lit(0)).alias("count_observations"),
    )
    name, held = F.lit(None).cast("string"), F.lit(False)
    for grain, ks in grains.items():
        this = F.col("_g") == ids[grain]
        name = F.when(this, F.lit(grain)).otherwise(name)
        held = held | (this & ~F.greatest(*[F.col(k).isNull() for k in ks], F.lit(False)))
    return merged.filter(held).select(name.alias("grain"), *[x for x in merged.columns if x != "_g"])


def at_grain(merged: DataFrame, grain: str, keys: Sequence[str], measure: str = "visitors", prefix: str = "") -> DataFrame:
    """One grain of ``profiles_at`` with the columns of ``profile``."""
    stats = [*[f"{s}_{measure}" for s in ("min", "mean", "median", "max")], "count_observations"]
    return merged.filter(F.col("grain") == grain).select(*keys, *[F.col(s).alias(prefix + s) for s in stats])


def attach(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join a keyed table; Spark picks broadcast or shuffle from the sizes it measures."""
    return df.join(side, list(keys), how)


def entity_weekday_grid(targets: DataFrame, entity: str = "store_id") -> DataFrame:
    """Every distinct entity on each weekday 0..6."""
    weekdays = F.explode(F.sequence(F.lit(0), F.lit(6)))
    return targets.select(entity).distinct().select(entity, weekdays.alias("dow"))


def only_known(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in another table."""
    return df.join(keys.select(key), key, "left_semi")


def translate_partner_ids(
    reservations: DataFrame, relation: DataFrame, partner: str = "partner_id"
) -> DataFrame:
    """Swap partner ids for own ids; reservations of unmapped partners are dropped."""
    return reservations.join(relation, partner, "inner").drop(partner)


def with_lead(reservations: DataFrame) -> DataFrame:
    """Visit date and days between booking and visit."""
    return reservations.withColumns(
        {"visit_date": day("visit_datetime"), "lead_days": lead_days("visit_datetime", "reserve_datetime")}
    )


def far_reservations(with_leads: DataFrame) -> DataFrame:
    """Keep reservations made in an earlier week than the visit (Monday-based)."""
    return with_leads.filter(F.col("lead_days") > weekday("visit_date"))


def reservation_features(
    reservations: DataFrame, entity: str = "store_id", suffix: str = "", far_only: bool = True
) -> DataFrame:
    """rs1, rv1 (sums) and rs2, rv2 (means) of lead days and party size per entity and visit date."""
    rows = with_lead(reservations)
    if far_only:
        rows = far_reservations(rows)
    return rows.dropna(subset=[entity, "visit_date"]).groupBy(entity, "visit_date").agg(
        F.sum("lead_days").alias(f"rs1{suffix}"),
        F.sum("reserve_visitors").alias(f"rv1{suffix}"),
        F.avg("lead_days").alias(f"rs2{suffix}"),
        F.avg("reserve_visitors").alias(f"rv2{suffix}"),
    )


def paired_reservation_features(
    a: DataFrame, b: DataFrame, entity: str = "store_id", far_only: bool = True
) -> DataFrame:
    """The features of two booking systems side by side (suffixes _a, _b) from one aggregation.

    A system without bookings for a key keeps nulls, as after two outer joins.
    """
    cols = [entity, "visit_datetime", "reserve_datetime", "reserve_visitors"]
    both = a.select(*cols, F.lit("a").alias("_s")).unionByName(b.select(*cols, F.lit("b").alias("_s")))
    rows = with_lead(both)
    if far_only:
        rows = far_reservations(rows)

    def of(system: str, c: str) -> Column:
        return F.when(F.col("_s") == system, F.col(c))

    aggregates = []
    for s in ("a", "b"):
        aggregates += [
            F.sum(of(s, "lead_days")).alias(f"rs1_{s}"),
            F.sum(of(s, "reserve_visitors")).alias(f"rv1_{s}"),
            F.avg(of(s, "lead_days")).alias(f"rs2_{s}"),
            F.avg(of(s, "reserve_visitors")).alias(f"rv2_{s}"),
        ]
    return rows.dropna(subset=[entity, "visit_date"]).groupBy(entity, "visit_date").agg(*aggregates)


def reservation_totals(df: DataFrame) -> DataFrame:
    """Totals over both systems; missing on either side stays missing."""
    return df.withColumns(
        {
            "total_reserv_sum": F.col("rv1_a") + F.col("rv1_b"),
            "total_reserv_mean": (F.col("rv2_a") + F.col("rv2_b")) / 2,
            "total_reserv_dt_diff_mean": (F.col("rs2_a") + F.col("rs2_b")) / 2,
        }
    )


def distance_to_max(df: DataFrame, columns: dict[str, str], over: DataFrame | None = None) -> DataFrame:
    """Add max(column) - column under a new name; the maximum is taken over the given frame.

    ``over`` names a cheaper frame with the same maxima (the attribute table of the entities seen).
    """
    top = (df if over is None else over).agg(F.struct(*[F.max(c).alias(c) for c in columns]).alias("m"))
    marked = df.withColumn("_top", top.scalar())
    return marked.withColumns({n: F.col("_top").getField(c) - F.col(c) for c, n in columns.items()}).drop("_top")


def share_of_total(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    total = df.select(F.sum(column).alias("t")).scalar()
    return df.withColumn(name or column, F.try_divide(F.col(column), total))


def active_entities(df: DataFrame, by: Sequence[str], entity: str = "store_id") -> DataFrame:
    return df.dropna(subset=list(by)).groupBy(*by).agg(F.countDistinct(entity).alias("n_entities"))
