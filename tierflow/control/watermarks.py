"""Last processed value per table, stored as text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow import fixed_values as fx
from tierflow.sinks.records import Records

SCHEMA = "table_id int, last_watermark_value string, last_updated_at timestamp, last_run_id bigint"


class Watermarks:
    def __init__(self, spark: SparkSession, path: str):
        self.rows = Records(spark, path, SCHEMA, ["table_id"])

    def read(self) -> DataFrame:
        return self.rows.read()

    def seed(self, table_ids: list[int], now: datetime, value: str = fx.FIRST_WATERMARK) -> None:
        for table_id in table_ids:
            self._put(table_id, value, now, None)

    def get(self, table_id: int) -> str | None:
        row = self.rows.get(table_id)
        return row["last_watermark_value"] if row else None

    def last_run(self, table_id: int) -> int | None:
        """The run that moved the watermark; older batches hold nothing newer."""
        row = self.rows.get(table_id)
        return row["last_run_id"] if row else None

    def advance(self, table_id: int, value: str | None, now: datetime, run_id: int) -> bool:
        """Nothing happens when the slice was empty and has no largest value."""
        if value is None:
            return False
        self._put(table_id, value, now, run_id)
        return True

    def _put(self, table_id: int, value: str, now: datetime, run_id: int | None) -> None:
        self.rows.put({"table_id": table_id, "last_watermark_value": value, "last_updated_at": now,
                       "last_run_id": run_id})


def set_last_value(control: DataFrame, schema: str, table: str, value: str) -> DataFrame:
    """Control rows with a new last value for one source table."""
    hit = (F.col("source_schema") == schema) & (F.col("source_table") == table)
    return control.withColumn("last_load_value", F.when(hit, F.lit(value)).otherwise(F.col("last_load_value")))
