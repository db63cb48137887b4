"""Nested documents to flat rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten(df: DataFrame, mapping: Sequence[tuple[str, str]]) -> DataFrame:
    """Select ``(path, name)`` pairs in order.

    A path or a name that occurs again is skipped: the first mapping wins. Only the named leaves
    are read from a columnar source.
    """
    paths: set[str] = set()
    names: set[str] = set()
    chosen = []
    for path, name in mapping:
        if path in paths or name in names:
            continue
        paths.add(path)
        names.add(name)
        chosen.append(F.col(path).alias(name))
    return df.select(*chosen)
