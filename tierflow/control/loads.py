"""Source to bronze, bronze to silver and silver to gold for one registered table."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tierflow import fixed_values as fx
from tierflow.control.audit import Audit
from tierflow.control.registry import TableSpec
from tierflow.control.watermarks import Watermarks
from tierflow.operators import slices
from tierflow.sinks.files import write_counted
from tierflow.sinks.snapshot import Snapshot

BATCH = "batch_id"
log = logging.getLogger(__name__)


# --- bronze -------------------------------------------------------------------------------

def land_bronze(source: DataFrame, path: str, run_id: int, now: datetime) -> int:
    """Append one batch. Its folder belongs to the run, so a repeated run replaces only its own rows."""
    stamped = source.withColumn("insert_timestamp", F.lit(now))
    return write_counted(stamped, lambda w: w.mode("overwrite").parquet(f"{path}/{BATCH}={run_id}"))["rows"]


def batches(spark: SparkSession, path: str) -> list[int]:
    """Runs that landed a batch, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BATCH}="))


def read_bronze(
    spark: SparkSession, path: str, schema: StructType | None = None, since: int | None = None
) -> DataFrame:
    """The batches of run ``since`` and later, or all. Run ids grow, so an incremental load passes
    the run of its watermark and older folders are not even listed. With a declared schema no file
    footers are compared; otherwise the columns of these batches are merged."""
    reader = spark.read.option("basePath", path)
    reader = reader.option("mergeSchema", "true") if schema is None else reader.schema(
        StructType(schema.fields + [StructField(BATCH, LongType())]))
    chosen = [f"{path}/{BATCH}={b}" for b in batches(spark, path) if since is None or b >= since]
    return reader.parquet(*(chosen or [path])).withColumn(BATCH, F.col(BATCH).cast("bigint"))


def new_source_rows(source: DataFrame, spec: TableSpec, watermarks: Watermarks) -> DataFrame:
    """Only rows after the watermark for an incremental table, all rows otherwise. A merged table also
    gets the rows at the watermark again: some may have come late, and its keys take out the others.
    Rows without a watermark value are after no watermark: a source extract has no way to find them."""
    if not spec.incremental:
        return source
    return slices.after(source, spec.watermark_column, watermarks.get(spec.table_id), spec.load_type == fx.MERGE)


def latest_batch(bronze: DataFrame, newest: int | None = None) -> DataFrame:
    """Rows of the newest batch. With its number from the folder listing no other folder is read."""
    if newest is None:
        newest = bronze.select(F.max(BATCH)).scalar()
    return bronze.filter(F.col(BATCH) == newest)


def unread_batches(bronze: DataFrame, spec: TableSpec, last_run: int | None, last: str | None) -> DataFrame:
    """Rows of every batch that silver has not had, whatever their watermark says: some come late, or
    have none. Of the last batch it had, only rows newer than the watermark: a repeat of that run
    landed them."""
    if last_run is None:
        return bronze
    newer = slices.newer(bronze, spec.watermark_column, last)
    return bronze.filter((F.col(BATCH) > last_run) | ((F.col(BATCH) == last_run) & newer))


# --- silver -------------------------------------------------------------------------------

def _stamp(df: DataFrame, now: datetime) -> DataFrame:
    return df.withColumn("insert_timestamp", F.lit(now)).withColumn("update_timestamp", F.lit(now))


def _full(silver: Snapshot, rows: DataFrame, spec: TableSpec, token: str) -> int:
    return silver.overwrite(rows, token)["rows"]


def _append(silver: Snapshot, rows: DataFrame, spec: TableSpec, token: str) -> int:
    return silver.append(rows, token)["rows"]


def _merge(silver: Snapshot, rows: DataFrame, spec: TableSpec, token: str) -> int:
    latest = [c for c in (spec.watermark_column, BATCH) if c and c in rows.columns]
    seen = silver.upsert(rows, token, preserve=["insert_timestamp"], latest=latest,
                         not_before=spec.watermark_column if spec.incremental else None)
    if seen["refused"]:
        log.warning("%s: %d rows without a key were refused", spec.table_name, seen["refused"])
    return seen["rows"]


STRATEGIES: Mapping[str, Callable[[Snapshot, DataFrame, TableSpec, str], int]] = {
    fx.FULL: _full, fx.APPEND: _append, fx.MERGE: _merge,
}


def load_silver(
    bronze: DataFrame, silver: Snapshot, spec: TableSpec, watermarks: Watermarks, run_id: int, now: datetime,
    newest: int | None = None,
) -> int:
    """Apply one load: the newest batch for a full load (``newest``, if the caller has listed it), all
    batches silver has not had otherwise. The watermark, and with it the number of the last batch,
    moves after the data is in place, to the bound of the rows that were written, observed in that write.

    A load that stopped between data and watermark is repeated from the version before it: run and
    lower bound together identify it. Once the watermark has moved, the same run builds on its own
    result.
    """
    spec.check()
    if spec.load_type == fx.FULL:
        return STRATEGIES[fx.FULL](silver, _stamp(latest_batch(bronze, newest), now), spec, str(run_id))
    if not spec.incremental:
        return STRATEGIES[spec.load_type](silver, _stamp(bronze, now), spec, str(run_id))
    last, last_run = watermarks.get(spec.table_id), watermarks.last_run(spec.table_id)
    if BATCH not in bronze.columns:  # rows without batches are those of this run
        bronze = bronze.withColumn(BATCH, F.lit(run_id).cast("bigint"))
    rows = unread_batches(bronze, spec, last_run, last)
    if silver.exists() and rows.isEmpty():
        return 0
    column = spec.watermark_column
    rows, seen = slices.observed(rows, **slices.measures(rows, column, last, BATCH))
    written = STRATEGIES[spec.load_type](silver, _stamp(rows, now), spec, f"{run_id} after {last_run} {last}")
    found = seen.get
    if found["unplaced"] or found["late"]:
        log.warning("%s: %d rows have no %s and %d are not after %s; they are loaded with their batch",
                    spec.table_name, found["unplaced"], column, found["late"], last)
    if found["newest"] is not None:
        watermarks.advance(spec.table_id, last if found["upper"] is None else found["upper"], now, found["newest"])
    return written


def audited_silver(
    bronze: DataFrame, silver: Snapshot, spec: TableSpec, watermarks: Watermarks, audit: Audit,
    run_id: int, now: datetime, newest: int | None = None,
) -> int:
    return audit.run(run_id, spec.table_id, "Silver",
                     lambda: load_silver(bronze, silver, spec, watermarks, run_id, now, newest))


def bounded_extracts(
    sources: Mapping[str, DataFrame], controls: Sequence[tuple[str, str, str | None]],
    land: Callable[[str, DataFrame], None],
) -> dict[str, str | None]:
    """For each control row ``(table, column, last value)`` in turn: hand the rows after the last value to
    ``land``, and return the new last values: the largest of the rows that were landed, observed in that write.

    A source is read once, after a look at whether it has any new row; ``land`` has to write what it gets. Rows
    without a value are in no slice.
    """
    result: dict[str, str | None] = {}
    for table, column, last in controls:
        new = slices.after(sources[table], column, last).filter(F.col(column).isNotNull())
        result[table] = last
        if not new.isEmpty():
            rows, seen = slices.observed(new, upper=F.max(column).cast("string"))
            land(table, rows)
            result[table] = seen.get["upper"]
    return result


# --- gold ---------------------------------------------------------------------------------

def publish_gold(
    name: str, builders: Mapping[str, Callable[[], DataFrame]], root: str, spark: SparkSession,
    audit: Audit, run_id: int, table_id: int,
) -> int:
    """Build the gold table registered under ``name`` and replace its current version."""
    if name not in builders:
        raise ValueError(f"no gold table {name!r}")
    table = Snapshot(spark, f"{root}/{name}")
    return audit.run(run_id, table_id, "Gold", lambda: table.overwrite(builders[name](), run_id)["rows"])
