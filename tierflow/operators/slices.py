"""Watermark slices. A watermark is stored as text and always compared in its column's type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def typed(df: DataFrame, column: str, value: str) -> Column:
    return F.lit(value).cast(df.schema[column].dataType)


def newer(df: DataFrame, column: str, last: str | None, including: bool = False) -> Column:
    """Whether a row is newer than the watermark, or at it with ``including``; true when there is none yet."""
    if last is None:
        return F.lit(True)
    edge = typed(df, column, last)
    return F.coalesce(F.col(column) >= edge if including else F.col(column) > edge, F.lit(False))


def after(df: DataFrame, column: str, last: str | None, including: bool = False) -> DataFrame:
    """Rows newer than the watermark; all rows when there is none yet.

    The bare comparison reaches the scan, where it skips files and row groups; it is NULL, and the row
    goes, where there is no watermark value.
    """
    if last is None:
        return df
    edge = typed(df, column, last)
    return df.filter(F.col(column) >= edge if including else F.col(column) > edge)


def between(df: DataFrame, column: str, last: str | None, upper: str) -> DataFrame:
    """The half-open slice ``(last, upper]``. Rows without a watermark value are never in a slice."""
    return after(df, column, last).filter(F.col(column) <= typed(df, column, upper))


def upper_bound(df: DataFrame, column: str, last: str | None = None) -> str | None:
    """Largest value after ``last`` as text, fixed before the slice is processed."""
    return bounds(df, column, last)[0]


def bounds(df: DataFrame, column: str, last: str | None = None) -> tuple[str | None, int]:
    """Upper bound, and the number of rows without a watermark value: no slice will ever contain
    them. One pass over one column."""
    newer = F.col(column) if last is None else F.when(F.col(column) > typed(df, column, last), F.col(column))
    row = df.agg(F.max(newer).cast("string"), F.count_if(F.col(column).isNull())).first()
    return row[0], row[1]


def measures(df: DataFrame, column: str, last: str | None, batch: str) -> dict[str, Column]:
    """What a load wants to know of its rows, to be observed while they are written: the ``upper`` bound after
    ``last``, rows without a watermark value (``unplaced``), rows not after ``last`` (``late``), the ``newest`` batch."""
    fresh = newer(df, column, last)
    return {
        "upper": F.max(F.when(fresh, F.col(column))).cast("string"), "unplaced": F.count_if(F.col(column).isNull()),
        "late": F.count_if(F.col(column).isNotNull() & ~fresh), "newest": F.max(batch),
    }


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` with aggregates that are known once it has been written, without a pass of their own."""
    seen = Observation()
    return df.observe(seen, *[c.alias(name) for name, c in metrics.items()]), seen
