"""Database reads that push the slice to the database."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class SplitBy:
    """Parallel read over a numeric or date column."""

    column: str
    lower: str
    upper: str
    partitions: int


def sql_literal(value: object, quote_text: bool = True) -> str:
    """A number stays a number; text is quoted with its quotes doubled."""
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return repr(value)
    text = str(value)
    return "'" + text.replace("'", "''") + "'" if quote_text else text


def slice_query(
    table: str,
    column: str | None = None,
    last: object | None = None,
    upper: object | None = None,
    quote: str = '"',
    including: bool = False,
) -> str:
    """Subquery for the rows in ``(last, upper]``, or ``[last, upper]`` with ``including``; either bound
    may be missing."""
    conditions = []
    if column is not None:
        name = f"{quote}{column}{quote}"
        if last is not None:
            conditions.append(f"{name} {'>=' if including else '>'} {sql_literal(last)}")
        if upper is not None:
            conditions.append(f"{name} <= {sql_literal(upper)}")
    where = " WHERE " + " AND ".join(conditions) if conditions else ""
    return f"(SELECT * FROM {table}{where}) src"


def max_query(table: str, column: str, quote: str = '"') -> str:
    """Upper bound of a slice, read before the slice itself."""
    return f"(SELECT MAX({quote}{column}{quote}) AS upper_bound FROM {table}) src"


def edges_query(query: str, column: str, parts: int, quote: str = '"', quantile: str | None = None) -> str:
    """Largest key of each of ``parts`` equal shares of the rows of a subquery, found by the database.

    ``NTILE`` sorts all keys, which some databases do in one worker. ``quantile`` is the aggregate of a database that
    has one for large tables, with ``{key}`` and ``{share}`` (0 to 1): then no key is sorted or sent, and shares are
    equal as far as that aggregate is exact. Ranges hold every row in either case, see ``range_predicates``.
    """
    name, parts = f"{quote}{column}{quote}", int(parts)
    if quantile is None:
        shares = f"SELECT {name} AS edge, NTILE({parts}) OVER (ORDER BY {name}) AS part FROM {query} WHERE {name} IS NOT NULL"
        return f"(SELECT part, MAX(edge) AS edge FROM ({shares}) shares GROUP BY part) src"
    inner = [f"{quantile.format(key=name, share=i / parts)} AS edge_{i}" for i in range(1, parts)]
    edges = f"SELECT {', '.join([*inner, f'MAX({name}) AS edge_{parts}'])} FROM {query} WHERE {name} IS NOT NULL"
    each = " ".join(f"WHEN {i} THEN edge_{i}" for i in range(1, parts + 1))
    numbers = ", ".join(f"({i})" for i in range(1, parts + 1))
    return f"(SELECT part, CASE part {each} END AS edge FROM ({edges}) edges CROSS JOIN (VALUES {numbers}) parts(part)) src"


def range_predicates(edges: Sequence[object], column: str, quote: str = '"') -> list[str]:
    """Conditions by which each row is in exactly one range: up to the first edge, between two, beyond the last but one.

    Edges that repeat, as those of a key that many rows have, make one range. Rows without a key are in the last.
    """
    name = f"{quote}{column}{quote}"
    bounds = [None, *sorted({e for e in edges if e is not None})[:-1], None]
    out = []
    for low, high in zip(bounds, bounds[1:]):
        parts = [f"{name} > {sql_literal(low)}"] * (low is not None) + [f"{name} <= {sql_literal(high)}"] * (high is not None)
        text = " AND ".join(parts) or "1 = 1"
        out.append(text if high is not None or not parts else f"({text} OR {name} IS NULL)")
    return out


def read_ranges(spark: SparkSession, url: str, query: str, predicates: list[str], properties: dict[str, str]) -> DataFrame:
    """A connection for each condition of ``range_predicates``."""
    return spark.read.jdbc(url, query, predicates=predicates, properties=properties)


def read_slice(
    spark: SparkSession,
    url: str,
    query: str,
    properties: dict[str, str],
    split: SplitBy | None = None,
) -> DataFrame:
    """One connection, or ``split.partitions`` connections over ranges of the split column.

    The ranges only steer parallelism: rows outside ``lower``..``upper`` fall into the first and
    last range, none is lost.
    """
    if split is None:
        return spark.read.jdbc(url, query, properties=properties)
    return spark.read.jdbc(
        url, query, column=split.column, lowerBound=split.lower, upperBound=split.upper,
        numPartitions=split.partitions, properties=properties,
    )
