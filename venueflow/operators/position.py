"""Exact row positions and rank cutoffs without sorting a whole table or a hot group in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venueflow.functions.columns import row_hash
from venueflow.session import materialize

_SLOT_BITS = 33  # fixed value: monotonically_increasing_id keeps the row's slot in the low 33 bits


def with_position(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Add the 0-based position of each row in the total order ``order``.

    One range-partitioned sort spreads any hot leading key over tasks (the order columns should be
    unique together). The sorted rows are written once, so partition sizes and rows agree; the
    start of each sort partition is then a running sum over one row per partition.
    """
    sorted_rows = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    rows = materialize(sorted_rows, "sorted").withColumns(
        {
            "_part": F.shiftright("_mid", _SLOT_BITS),
            "_slot": F.col("_mid").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1)),
        }
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("_part")
        .agg((F.max("_slot") + 1).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    # One row per sort partition: at most spark.sql.shuffle.partitions rows.
    placed = rows.join(F.broadcast(starts), "_part")
    return placed.withColumn(name, F.col("_start") + F.col("_slot")).drop("_mid", "_part", "_slot", "_start")


def rank_cutoffs(
    df: DataFrame, date: str, ties: Sequence[str], ranks: Callable[[Column], Column]
) -> DataFrame:
    """Keys (date, *ties) of the rows that hold given 1-based ranks in (date, *ties) order.

    ``ranks`` maps the row count to an array of ranks. Returns one row: ``cutoffs``, a sorted array
    of key structs, and ``skipped``, how many requested ranks are below 1.

    The facts are only counted per date. Rows are ranked inside the few dates that hold a wanted
    rank, and there by a range-partitioned sort, so even a date with most of the rows is split.
    """
    # One row per date, so both windows run on a table bounded by the date range.
    running = Window.orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    days = df.groupBy(date).agg(F.count(F.lit(1)).alias("_rows"))
    days = days.withColumn("_before", F.coalesce(F.sum("_rows").over(running), F.lit(0)))
    days = days.withColumn("_total", F.sum("_rows").over(Window.partitionBy()))
    wanted = ranks(F.col("_total"))
    days = days.withColumn("_skipped", F.size(F.filter(wanted, lambda r: r < 1)))
    here = F.filter(wanted, lambda r: (r > F.col("_before")) & (r <= F.col("_before") + F.col("_rows")))
    hits = materialize(
        days.select(date, "_before", "_skipped", F.explode_outer(here).alias("_rank")), "hits"
    )
    skipped = hits.agg(F.max("_skipped").alias("skipped"))
    hits = hits.filter(F.col("_rank").isNotNull()).select(date, (F.col("_rank") - F.col("_before") - 1).alias("_nth"))

    # hits has one row per wanted rank (a holdout has one, folds have k).
    # A missing date sorts first and is joined as a value of its own.
    hit_days = F.broadcast(hits.select(F.col(date).alias("_hit")).distinct())
    edge_rows = df.select(date, *ties).join(hit_days, F.col(date).eqNullSafe(F.col("_hit")), "left_semi")
    placed = with_position(edge_rows, [date, *ties])
    day_start = placed.groupBy(F.col(date).alias("_day")).agg(F.min("position").alias("_day_start"))
    on_day = hits[date].eqNullSafe(F.col("_day"))
    at = hits.join(F.broadcast(day_start), on_day).select((F.col("_day_start") + F.col("_nth")).alias("position"))
    keys = placed.join(F.broadcast(at), "position").select(F.struct(date, *ties).alias("_key"))
    found = keys.agg(F.sort_array(F.collect_list("_key")).alias("cutoffs"))
    return found.withColumn("skipped", skipped.scalar())


def with_segment(df: DataFrame, date: str, ties: Sequence[str], ranks, name: str = "segment") -> DataFrame:
    """Number of wanted ranks that lie strictly before each row; no shuffle of the rows themselves.

    Rows with equal (date, *ties) are ordered by a hash of all their columns, so that exactly the
    wanted number of rows lies behind a cutoff; only wholly equal rows stay on one side together.
    """
    df, ties = df.withColumn("_own", row_hash(df)), [*ties, "_own"]
    # Read once per query: the cutoffs come back as a scalar of at most len(ranks) keys.
    cut = materialize(rank_cutoffs(df, date, ties, ranks), "cutoffs")
    key = F.struct(date, *ties)
    marked = df.withColumn("_cut", cut.select(F.struct("cutoffs", "skipped")).scalar())
    passed = F.size(F.filter("_cut.cutoffs", lambda c: key > c))
    return marked.withColumn(name, (passed + F.col("_cut.skipped")).cast("int")).drop("_cut", "_own")
