"""Column-returning helpers. Everything here stays a native Spark expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(ts: ColumnLike) -> Column:
    """Truncate a timestamp, date or ISO string to a date."""
    return col(ts).cast("date")


def parse_timestamp(text: ColumnLike, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.to_timestamp(col(text), pattern)


def weekday(d: ColumnLike) -> Column:
    """Monday is 0, Sunday is 6."""
    return F.weekday(col(d))


def lead_days(visit: ColumnLike, reserve: ColumnLike) -> Column:
    """Whole days from booking to visit."""
    return F.datediff(day(visit), day(reserve))


def date_int(d: ColumnLike) -> Column:
    """Date as the integer yyyyMMdd."""
    d = col(d)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def split_entity(target_id: ColumnLike) -> Column:
    """Entity part of ``<entity>_<yyyy-MM-dd>``: everything before the last underscore."""
    target_id = col(target_id)
    return F.regexp_replace(target_id, "_[^_]*$", "")


def split_date(target_id: ColumnLike) -> Column:
    """Date part of ``<entity>_<yyyy-MM-dd>``."""
    return F.substring_index(col(target_id), "_", -1).cast("date")


def make_id(entity: ColumnLike, d: ColumnLike) -> Column:
    """``<entity>_<date>``; null if either is missing."""
    return F.concat(col(entity).cast("string"), F.lit("_"), col(d).cast("string"))


def separate_words(text: ColumnLike, separator: str, missing: str = "nan") -> Column:
    """Put a space where the separator was; a missing text becomes the literal ``missing``."""
    return F.translate(F.coalesce(col(text), F.lit(missing)), separator, " ")


def token(text: ColumnLike, index: int) -> Column:
    """The ``index``-th (from 0) space-separated word, or an empty string past the end."""
    return F.split_part(col(text), F.lit(" "), F.lit(index + 1))


def clip(c: ColumnLike, lower: float | None = None, upper: float | None = None) -> Column:
    """Bound a value; missing values stay missing and NaN stays NaN."""
    c = col(c)
    out = c
    if lower is not None:
        out = F.greatest(out, F.lit(float(lower)))
    if upper is not None:
        out = F.least(out, F.lit(float(upper)))
    return F.when(F.isnan(c.cast("double")), c).when(c.isNotNull(), out)


def weighted_mean(value: ColumnLike, weight: ColumnLike) -> Column:
    """Aggregate sum(w*v)/sum(w); rows with a missing value still count their weight."""
    value, weight = col(value), col(weight)
    return F.try_divide(F.sum(weight * value), F.sum(weight))


def recency_weight(rank: ColumnLike, n: ColumnLike, exponent: float) -> Column:
    """(rank / n) ** exponent with rank running from 1 (oldest) to n (newest)."""
    return F.pow(col(rank) / col(n), F.lit(float(exponent)))


def blend(predictions: Sequence[ColumnLike], weights: Sequence[float]) -> Column:
    """Weighted sum of prediction columns."""
    if len(predictions) != len(weights):
        raise ValueError("one weight per prediction is needed")
    terms = [col(p) * F.lit(float(w)) for p, w in zip(predictions, weights)]
    return sum(terms[1:], terms[0])


def rmse(truth: ColumnLike, prediction: ColumnLike) -> Column:
    """Aggregate root mean squared error; on log1p columns this is the RMSLE."""
    return F.sqrt(F.avg(F.pow(col(truth) - col(prediction), F.lit(2.0))))


def format_floats(schema, scale: int) -> list[Column]:
    """Select list that prints floating columns with a fixed number of decimals; a missing number or NaN is left empty."""
    pattern = f"%.{scale}f"
    return [
        F.when(F.col(f.name).isNotNull() & ~F.isnan(f.name), F.format_string(pattern, F.col(f.name))).alias(f.name)
        if f.dataType.typeName() in ("double", "float")
        else F.col(f.name)
        for f in schema.fields
    ]


def row_hash(df) -> Column:
    """A hash of all columns of ``df``. Maps, which Spark does not hash, count as the list of their entries by key."""
    parts = []
    for field in df.schema.fields:
        kind, value = field.dataType.simpleString(), df[field.name]
        if kind.startswith("map<") and kind.count("map<") == 1:
            value = F.array_sort(F.map_entries(value), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
        elif "map<" in kind:
            value = F.to_json(F.struct(value))
        parts.append(value)
    return F.xxhash64(*parts)
