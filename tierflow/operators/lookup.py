"""Joins against keyed tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tierflow.session import scratch_dir


#: Unknown keys of a dimension up to which they are sent to every task; more are joined by a shuffle.
SENT_KEYS = 100_000


def unknown_keys(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> tuple[DataFrame, dict[str, int]]:
    """``_dimension``, ``_key``: keys of the fact that their dimension does not contain; and how many each has.

    Keys are compared as text in the type of the dimension's column. All key columns are read in one pass and made
    distinct in the tasks that read them, so what is shuffled is distinct keys, not rows. The result is written to the
    scratch folder, as its size decides how it is used.
    """
    spark = fact.sparkSession
    kinds = {key: dim.schema[key].dataType for key, dim in dimensions.items()}
    used = fact.select(F.inline(F.array(*[
        F.struct(F.lit(key).alias("_dimension"), F.col(key).cast(kinds[key]).cast("string").alias("_key")) for key in dimensions
    ]))).where("_key is not null").distinct()
    known = reduce(DataFrame.union, [
        dim.select(F.lit(key).alias("_dimension"), F.col(key).cast("string").alias("_key")) for key, dim in dimensions.items()])
    found = Observation()
    counts = [F.count_if(F.col("_dimension") == key).alias(key) for key in dimensions]
    path = scratch_dir(spark, "unknown-keys")
    used.join(known, ["_dimension", "_key"], "left_anti").observe(found, *counts).write.parquet(path)
    return spark.read.schema("_dimension string, _key string").parquet(path), found.get


def keep_or_default(fact: DataFrame, dimensions: Mapping[str, DataFrame], default: Column, sent_keys: int = SENT_KEYS) -> DataFrame:
    """Replace every key that its dimension does not contain (or that is NULL) by ``default``.

    Only the key column of a dimension is read. The unknown keys are found first; where they are at most
    ``sent_keys`` they go to every task, so fact rows are looked up where they are read, in one narrow step for all
    dimensions. A dimension with more unknown keys is joined by a shuffle, in which adaptive execution splits a key
    that holds many rows.
    """
    if not dimensions:
        return fact
    unknown, counts = unknown_keys(fact, dimensions)
    out = fact
    for key, dim in dimensions.items():
        kind = dim.schema[key].dataType
        if not counts[key]:
            out = out.withColumn(key, F.coalesce(F.col(key).cast(kind), default))
            continue
        missing = unknown.where(F.col("_dimension") == key).select(F.col("_key").cast(kind).alias("_unknown"))
        missing = F.broadcast(missing) if counts[key] <= sent_keys else missing
        out = out.join(missing, F.col(key).cast(kind) == F.col("_unknown"), "left").withColumn(
            key, F.when(F.col("_unknown").isNull(), F.coalesce(F.col(key).cast(kind), default)).otherwise(default)).drop("_unknown")
    return out


def with_group_count(df: DataFrame, key: str, name: str) -> DataFrame:
    """Number of rows sharing the key, on every row.

    Counted with map-side aggregation and joined back: no task has to hold a whole group, as a
    window over the key would. Rows with a NULL key form one group.
    """
    counts = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias(name))
    return df.join(counts, df[key].eqNullSafe(counts["_key"]), "left").drop("_key")
