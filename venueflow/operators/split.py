"""Chronological holdout, expanding-window folds and stratified folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venueflow.operators.position import with_position, with_segment
from venueflow.session import materialize


def chronological_holdout(
    df: DataFrame, date: str, ties: Sequence[str], fraction: float, name: str = "is_validation"
) -> DataFrame:
    """Flag the last int(n * fraction) rows in (date, *ties) order."""
    marked = with_segment(
        df, date, ties, lambda n: F.array(n - F.floor(n * F.lit(float(fraction)))), "_segment"
    )
    return marked.withColumn(name, F.col("_segment") == 1).drop("_segment")


def head_tail(df: DataFrame, date: str, ties: Sequence[str], fraction: float) -> tuple[DataFrame, DataFrame]:
    """(training rows, last int(n * fraction) rows)."""
    flagged = chronological_holdout(df, date, ties, fraction, "_tail")
    return flagged.filter(~F.col("_tail")).drop("_tail"), flagged.filter("_tail").drop("_tail")


def expanding_folds(df: DataFrame, date: str, ties: Sequence[str], k: int = 5, name: str = "segment") -> DataFrame:
    """Add the time segment 0..k, each of the last k holding n // (k + 1) rows.

    Fold i (1..k) tests segment i and trains on every earlier segment, so no row is copied.
    """

    def ranks(n):
        size = F.floor(n / F.lit(k + 1))
        return F.array(*[n - F.lit(k - i) * size for i in range(k)])

    return with_segment(df, date, ties, ranks, name)


def fold_frames(folded: DataFrame, fold: int, name: str = "segment") -> tuple[DataFrame, DataFrame]:
    """(train, test) of one expanding fold."""
    return folded.filter(F.col(name) < fold), folded.filter(F.col(name) == fold)


def fold_sizes(folded: DataFrame, k: int, name: str = "segment") -> DataFrame:
    """Rows trained on and tested on per fold, from one count per segment."""
    counts = folded.groupBy(name).agg(F.count(F.lit(1)).alias("_rows"))
    role = F.explode(
        F.transform(
            F.sequence(F.greatest(F.col(name), F.lit(1)), F.lit(k)),
            lambda fold: F.struct(
                fold.alias("fold"),
                F.when(fold == F.col(name), 0).otherwise(F.col("_rows")).alias("n_train"),
                F.when(fold == F.col(name), F.col("_rows")).otherwise(0).alias("n_test"),
            ),
        )
    )
    return (
        counts.select(role.alias("r"))
        .groupBy(F.col("r.fold").alias("fold"))
        .agg(F.sum("r.n_train").alias("n_train"), F.sum("r.n_test").alias("n_test"))
    )


def stratified_folds(df: DataFrame, label: str, order: Sequence[str], k: int, name: str = "fold") -> DataFrame:
    """Assign folds 1..k as contiguous blocks of each class in ``order``; larger blocks come first.

    Equals ntile(k) per class, but a class with a third of the rows is spread over tasks: rows are
    placed by one range-partitioned sort on (label, *order).
    """
    placed = with_position(df, [label, *order], "_position")
    # Written, so that Spark knows its size when it plans the join.
    classes = materialize(
        placed.groupBy(label).agg(F.min("_position").alias("_first"), F.count(F.lit(1)).alias("_size")), "classes"
    )
    rank = F.col("_position") - F.col("_first")
    base = F.floor(F.col("_size") / k)
    longer = F.col("_size") % k
    head = longer * (base + 1)
    fold = F.when(rank < head, F.floor(F.try_divide(rank, base + 1))).otherwise(
        longer + F.floor(F.try_divide(rank - head, base))
    )
    joined = placed.join(classes, label)
    return joined.withColumn(name, (fold + 1).cast("int")).drop("_position", "_first", "_size")
