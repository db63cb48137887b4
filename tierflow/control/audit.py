"""One row per run and table, and the report made from it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow import fixed_values as fx
from tierflow.control.registry import required
from tierflow.sinks.records import Records

SCHEMA = (
    "run_id bigint, table_id int, layer string, start_time timestamp, end_time timestamp, "
    "status string, number_of_records bigint, error_message string"
)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Audit:
    """Rows are written as data, so error texts need no quoting."""

    def __init__(self, spark: SparkSession, path: str, clock: Callable[[], datetime] = utc_now):
        self.clock = clock
        self.rows = Records(spark, path, SCHEMA, ["run_id", "table_id"])

    def read(self) -> DataFrame:
        return self.rows.read()

    def _put(self, *values: object) -> None:
        self.rows.put(dict(zip(self.rows.schema.names, values)))

    def run(self, run_id: int, table_id: int, layer: str, job: Callable[[], int]) -> int:
        """Mark the start, run the job, record its outcome. A failure is recorded and raised again."""
        required(run_id=run_id, table_id=table_id, layer=layer)
        started = self.clock()
        self._put(run_id, table_id, layer, started, None, fx.IN_PROGRESS, None, None)
        try:
            rows = int(job())
        except Exception as error:
            self._put(run_id, table_id, layer, started, self.clock(), fx.FAILED, None, str(error))
            raise
        self._put(run_id, table_id, layer, started, self.clock(), fx.SUCCESS, rows, None)
        return rows


def run_report(audit: DataFrame, registry: DataFrame, run_id: int | None = None) -> DataFrame:
    """Outcome per table with its name; tables the registry does not know stay in."""
    rows = audit if run_id is None else audit.filter(F.col("run_id") == run_id)
    names = registry.select("table_id", "table_name")
    return rows.join(names, "table_id", "left").select(
        "run_id", "table_id", "table_name", "layer", "start_time", "end_time", "status",
        "number_of_records", "error_message",
    ).orderBy("run_id", "table_id")


def run_status(audit: DataFrame) -> DataFrame:
    """A run failed when any of its tables did not succeed, also when one is still in progress."""
    bad = F.count_if(F.col("status") != fx.SUCCESS)
    return audit.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total_tables"),
        bad.alias("failed_tables"),
        F.when(bad > 0, fx.FAILED).otherwise(fx.SUCCESS).alias("overall_status"),
    )


def runs_newest_first(audit: DataFrame) -> DataFrame:
    return audit.orderBy(F.col("start_time").desc_nulls_last(), "run_id", "table_id")
