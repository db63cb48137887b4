"""File writers. Each returns the number of rows it wrote, taken from the write itself."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F

from tierflow.session import scratch_dir
from tierflow.sources.files import CSV_NULL

#: How tables are written. Numbers without a dictionary, such as sorted keys, are stored as differences.
PARQUET = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}


def write_counted(
    df: DataFrame, save: Callable[[DataFrameWriter], None], **metrics: Column
) -> dict[str, object]:
    """Run one write and return ``rows`` and further aggregates measured during it."""
    seen = Observation()
    counted = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in metrics.items()]
    )
    save(counted.write)
    return seen.get


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    return write_counted(df, lambda w: w.mode(mode).options(**PARQUET).parquet(path))["rows"]


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> int:
    """One folder per key value. The rebalance keeps files near the advisory size: small values
    are merged into one task and a value that holds much of the data is split over several."""
    spread = df.hint("rebalance", *by)
    return write_counted(spread, lambda w: w.mode("overwrite").partitionBy(*by).parquet(path))["rows"]


def write_csv(df: DataFrame, path: str, quote_all: bool = True, compressed_rows: int | None = None) -> int:
    """Quoted text with a header row in every part file. Blanks around a text are part of it, an empty
    text and a missing one are told apart, and line breaks stay (to be read with ``multi_line``).

    With ``compressed_rows`` files are compressed and hold at most that many rows each: one task reads a whole one.
    """
    packed = {"compression": "gzip", "maxRecordsPerFile": compressed_rows} if compressed_rows else {}
    return write_counted(df, lambda w: w.mode("overwrite").options(**packed).csv(
        path, header=True, quoteAll=quote_all, escape="\\", nullValue=CSV_NULL,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ))["rows"]


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    return write_counted(df, lambda w: w.mode(mode).json(path, ignoreNullFields=False))["rows"]


def insert_rows(df: DataFrame, path: str, key: str, required: Sequence[str] = ()) -> int:
    """Append rows to a folder as a table with a primary key would take them: all, or none.

    An error names the columns in ``required`` that lack a value, and a key that comes twice or is in the table
    already. The rows are written once aside, where missing values are counted, and then appended.
    """
    spark = df.sparkSession
    stage = scratch_dir(spark, "insert")
    missing = {f"missing_{i}": F.count_if(F.col(c).isNull()) for i, c in enumerate(required)}
    seen = write_counted(df, lambda w: w.parquet(stage), **missing)
    rows = spark.read.schema(df.schema).parquet(stage)
    lacking = [c for i, c in enumerate(required) if seen[f"missing_{i}"]]
    if lacking:
        raise ValueError(f"no value in {', '.join(lacking)}")
    keys = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_times"))
    if has_files(spark, path):
        held = spark.read.parquet(path).select(F.col(key), F.lit(1).alias("_held"))
        keys = keys.join(held, key, "left").where("_times > 1 or _held is not null")
    else:
        keys = keys.where("_times > 1")
    twice = keys.select(key).first()
    if twice is not None:
        raise ValueError(f"key {twice[0]} of {key} is there already")
    rows.write.mode("append").parquet(path)
    return seen["rows"]


def has_files(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def insert_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Insert-only database sink; the first error stops the job."""
    df.write.jdbc(url, table, mode="append", properties=properties)
