"""Duplicate removal with a defined survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _sortable(dtype: T.DataType) -> bool:
    """Whether Spark orders the type: maps and variants, and what holds one, have no order."""
    if isinstance(dtype, T.ArrayType):
        return _sortable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_sortable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _order_value(field: T.StructField) -> Column:
    """The column itself, or for a type without an order its text, with the entries of maps sorted."""
    column = F.col(f"`{field.name}`")
    if _sortable(field.dataType):
        return column
    if isinstance(field.dataType, T.MapType) and _sortable(field.dataType.keyType) and _sortable(field.dataType.valueType):
        return F.array_sort(F.map_entries(column))
    return F.to_json(column) if not isinstance(field.dataType, T.ArrayType) else F.to_json(F.struct(column))


def survivor_order(df: DataFrame, keys: Sequence[str], latest: Sequence[str]) -> list[Column]:
    """Newest first, then all other columns ascending with NULL last: a total order, nested columns included."""
    rest = [f for f in df.schema.fields if f.name not in {*keys, *latest}]
    return [F.col(f"`{c}`").desc_nulls_last() for c in latest] + [_order_value(f).asc_nulls_last() for f in rest]


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    latest: Sequence[str] = (),
    tie_break: Sequence[Column] | None = None,
) -> DataFrame:
    """One row per key.

    Spark plans ``row_number() = 1`` with a per-task limit before the shuffle, so each task sends
    at most one row per key: a key that holds a third of all rows does not reach one task whole.
    ``tie_break`` replaces the default order over all remaining columns when a cheaper total order
    is known.
    """
    keys, latest = list(keys), list(latest)
    if tie_break is None:
        order = survivor_order(df, keys, latest)
    else:
        order = [F.col(c).desc_nulls_last() for c in latest] + list(tie_break)
    if not order:  # the key is the whole row
        return df.dropDuplicates(keys)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(window)).filter("_row = 1").drop("_row")
