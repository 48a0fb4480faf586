"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venueflow.functions.columns import row_hash

SPACE = r"[\x20\x09-\x0D]+"  # what separates words, in Spark's and DuckDB's regex dialects


def words(text: Column) -> Column:
    """Words of a text: maximal runs free of blanks, tabs and line ends. Null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The given names, each prefixed until no column of ``df`` has it (case does not matter)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def row_key(df: DataFrame) -> Column:
    """A hash of all columns, so that rows sharing an id can be told apart."""
    return row_hash(df)
