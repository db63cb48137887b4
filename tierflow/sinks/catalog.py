"""Schemas, views and tables registered in the session catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def create_schemas(spark: SparkSession, names: Sequence[str]) -> None:
    for name in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def create_external(spark: SparkSession, name: str, columns: str, path: str, partitioned_by: Sequence[str] = ()) -> DataFrame:
    """Table with declared columns over existing Parquet files."""
    parts = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts} LOCATION '{path}'")
    if partitioned_by:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def _writer(df: DataFrame, mode: str, path: str | None):
    writer = df.write.format("parquet").mode(mode)
    return writer if path is None else writer.option("path", path)


def create_if_absent(df: DataFrame, name: str, path: str | None = None) -> bool:
    """Write the table only when it does not exist; True when it was written."""
    if df.sparkSession.catalog.tableExists(name):
        return False
    _writer(df, "ignore", path).saveAsTable(name)
    return True


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create or replace from a query that does not read the same table."""
    _writer(df, "overwrite", path).saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    _writer(df, "append", None).saveAsTable(name)


def replace_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
