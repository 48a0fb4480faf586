"""Sorted label codes, token expansion, min-max scaling, sentinels and feature vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venueflow.functions.columns import separate_words, token
from venueflow.operators.position import with_position
from venueflow.session import materialize


def fit_label_codes(df: DataFrame, columns: Sequence[str], missing: str = "nan") -> DataFrame:
    """Vocabulary table (column, label, code): the sorted distinct labels of each column as 0..n-1.

    All columns share one pass. The vocabulary is numbered by a range-partitioned sort, written, and
    never collected.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias("label")) for c in columns]
    )
    distinct = df.select(F.explode(pairs).alias("p")).select("p.column", "p.label").distinct()
    placed = with_position(distinct, ["column", "label"])
    # One row per encoded column.
    first = F.broadcast(placed.groupBy("column").agg(F.min("position").alias("_first")))
    code = (F.col("position") - F.col("_first")).cast("int").alias("code")
    return materialize(placed.join(first, "column").select("column", "label", code), "codes")


def apply_label_codes(
    df: DataFrame,
    codes: DataFrame,
    columns: Sequence[str],
    names: Sequence[str] | None = None,
    unseen: str = "error",
    missing: str = "nan",
) -> DataFrame:
    """Replace (or add under ``names``) columns by their codes.

    The codes are read from files, so Spark knows their size: it broadcasts a small vocabulary and
    shuffles for a large one. ``unseen='error'`` fails the job on a label outside the vocabulary; ``'keep'`` gives it the
    next free code.
    """
    if unseen not in ("error", "keep"):
        raise ValueError("unseen must be 'error' or 'keep'")
    sizes = codes.groupBy("column").agg((F.max("code") + 1).alias("size"))
    out = df
    for c, target in zip(columns, names or columns):
        side = codes.filter(F.col("column") == c).select(
            F.col("label").alias(f"_label_{c}"), F.col("code").alias(f"_code_{c}")
        )
        label = F.coalesce(F.col(c).cast("string"), F.lit(missing))
        out = out.join(side, label == F.col(f"_label_{c}"), "left")
        if unseen == "error":
            fallback = F.raise_error(F.concat(F.lit(f"label not seen when fitting {c}: "), label)).cast("int")
        else:
            fallback = sizes.filter(F.col("column") == c).select(F.max("size")).scalar()
        out = out.withColumn("_new", F.coalesce(F.col(f"_code_{c}"), fallback))
        out = out.drop(f"_label_{c}", f"_code_{c}", *([target] if target in out.columns else []))
        out = out.withColumnRenamed("_new", target)
    return out


def label_encode(df: DataFrame, columns: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """Fit and apply label codes on the same table."""
    return apply_label_codes(df, fit_label_codes(df, columns), columns, names)


def expand_tokens(df: DataFrame, column: str, separator: str, k: int = 10) -> DataFrame:
    """Add <column>0..<column>k-1 with the words of a separated text, empty past the end."""
    words = separate_words(column, separator)
    return df.withColumns({column: words, **{f"{column}{i}": token(words, i) for i in range(k)}})


def encode_tokens(df: DataFrame, separators: dict[str, str], k: int = 10) -> DataFrame:
    """Expand several text columns into word columns and encode all of them and the whole texts.

    ``df`` is an attribute table whose remaining columns identify a row. All codes come from one
    join on (column, label) and one pivot, however many word columns there are.
    """
    keys = feature_columns(df, list(separators))
    for column, separator in separators.items():
        df = expand_tokens(df, column, separator, k)
    names = [n for c in separators for n in [c, *(f"{c}{i}" for i in range(k))]]
    codes = fit_label_codes(df, names)
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("column"), F.col(n).alias("label")) for n in names]))
    long = df.select(*keys, cells.alias("c")).select(*keys, "c.column", "c.label")
    coded = long.join(codes, ["column", "label"])
    return coded.groupBy(*keys).pivot("column", names).agg(F.max("code"))


def column_bounds(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Minimum and maximum of each column: two numbers per column, from one aggregation."""
    row = train.agg(
        F.array(*[F.min(F.col(c).cast("double")) for c in columns]),
        F.array(*[F.max(F.col(c).cast("double")) for c in columns]),
    ).first()
    return dict(zip(columns, zip(*row)))


def scale_by(bounds: dict[str, tuple[float, float]], df: DataFrame) -> DataFrame:
    """Scale columns by fitted bounds, without clipping; a zero range counts as 1."""

    def scaled(c, low, high):
        span = 1.0 if low == high else None if low is None else high - low
        return (F.col(c).cast("double") - F.lit(low)) / F.lit(span)

    return df.withColumns({c: scaled(c, *b) for c, b in bounds.items()})


def min_max_scale(train: DataFrame, other: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale ``other`` by the minimum and range of ``train``."""
    return scale_by(column_bounds(train, columns), other)


def fill_sentinel(df: DataFrame, value: int = -1) -> DataFrame:
    """Fill every missing number and text with the sentinel; dates are left alone."""
    return df.fillna(value).fillna(str(value))


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(exclude)]


def assemble(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    """Collect numeric columns into one vector column."""
    return VectorAssembler(inputCols=list(columns), outputCol=name, handleInvalid="error").transform(df)
