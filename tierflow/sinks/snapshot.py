"""Named tables on plain Parquet that can be replaced, appended to and merged into.

Parquet tables have no MERGE and cannot be overwritten while they are read. A ``Snapshot`` is a
folder whose data folders never change once written, plus one small JSON file per version that
lists the data folders of that version. The highest version is the current one, so a job that
fails leaves readers on the version before. One writer per table at a time.

A keyed table is split into hash buckets of its key. A merge reads and rewrites only the buckets
its source touches; all other buckets are carried over by name. Every version records its keys and
its number of buckets: appends use the recorded number, a merge that asks for another number
rewrites the whole table in it, and other keys than the recorded ones are refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.operators.dedup import keep_latest
from tierflow.sinks.files import PARQUET, write_counted

BUCKET = "_bucket"


class Snapshot:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (), buckets: int = 1):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.buckets = buckets if self.keys else 1
        jvm = spark._jvm
        self._new_path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._new_path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # --- versions ---------------------------------------------------------------------

    def _versions(self) -> list[int]:
        folder = self._new_path(f"{self.path}/versions")
        if not self._fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def _manifest(self, version: int) -> dict:
        stream = self._fs.open(self._new_path(f"{self.path}/versions/{version:08d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _current(self) -> dict | None:
        versions = self._versions()
        return self._manifest(versions[-1]) if versions else None

    def _base(self, run_id: object) -> tuple[int, dict | None]:
        """Version to write and manifest to build on. A repeated run builds on what it found first."""
        current = self._current()
        if current is None:
            return 1, None
        base = current
        if run_id is not None and current["run_id"] == str(run_id):
            base = self._manifest(current["base"]) if current["base"] else None
        return current["version"] + 1, base

    def _layout(self, base: dict | None) -> int:
        """Buckets the version has; other keys than its own would look in the wrong ones."""
        if base is None:
            return self.buckets
        if self.keys and base["keys"] and self.keys != base["keys"]:
            raise ValueError(f"{self.path} is keyed by {base['keys']}, not by {self.keys}")
        return base["buckets"] if self.keys else 1

    def _publish(self, version: int, base: dict | None, run_id: object, schema: T.StructType,
                 folders: dict[str, list[str]], buckets: int) -> None:
        body = json.dumps({
            "keys": self.keys,
            "buckets": buckets,
            "version": version,
            "base": base["version"] if base else 0,
            "run_id": None if run_id is None else str(run_id),
            "schema": schema.json(),
            "folders": folders,
        })
        hidden = self._new_path(f"{self.path}/versions/.{uuid.uuid4().hex}")
        out = self._fs.create(hidden, False)
        out.write(bytearray(body, "utf-8"))
        out.close()
        final = self._new_path(f"{self.path}/versions/{version:08d}.json")
        if self._fs.exists(final) or not self._fs.rename(hidden, final):
            raise RuntimeError(f"version {version} of {self.path} was written by somebody else")

    # --- reading ----------------------------------------------------------------------

    def exists(self) -> bool:
        return bool(self._versions())

    def version(self) -> int:
        versions = self._versions()
        return versions[-1] if versions else 0

    def read(self) -> DataFrame:
        current = self._current()
        if current is None:
            raise FileNotFoundError(f"no version of {self.path}")
        return self._read(current)

    def _read(self, manifest: dict, only: set[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(manifest["schema"]))
        paths = [f"{self.path}/data/{folder}"
                 for bucket, folders in manifest["folders"].items() if only is None or bucket in only
                 for folder in folders]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    # --- writing ----------------------------------------------------------------------

    def _bucket_of(self, schema: T.StructType, buckets: int) -> Column:
        # hashed in the table's own key types: int 1 and bigint 1 have different hashes
        keys = [F.col(k).cast(schema[k].dataType) for k in self.keys]
        return F.pmod(F.xxhash64(*keys), F.lit(buckets))

    def _write_data(self, df: DataFrame, buckets: int, **metrics: Column) -> tuple[dict[str, list[str]], dict]:
        """Write new data folders; returns them per bucket with the measured metrics."""
        folder = uuid.uuid4().hex
        target = f"{self.path}/data/{folder}"
        if buckets == 1:
            seen = write_counted(df, lambda w: w.mode("error").options(**PARQUET).parquet(target), **metrics)
            return {"0": [folder]}, seen
        seen = write_counted(df, lambda w: w.mode("error").options(**PARQUET).partitionBy(BUCKET).parquet(target), **metrics)
        names = [s.getPath().getName() for s in self._fs.listStatus(self._new_path(target))]
        found = sorted(n for n in names if n.startswith(f"{BUCKET}="))
        return {n.split("=")[1]: [f"{folder}/{n}"] for n in found}, seen

    def _bucketed(self, df: DataFrame, schema: T.StructType, buckets: int) -> DataFrame:
        """Rows of a bucket side by side, in as many tasks as the size of the bucket asks for."""
        if buckets == 1:
            return df
        return df.withColumn(BUCKET, self._bucket_of(schema, buckets)).hint("rebalance", BUCKET)

    def overwrite(
        self, df: DataFrame, run_id: object = None, merge_schema: bool = False, **metrics: Column
    ) -> dict:
        """Replace all rows, and the schema too unless ``merge_schema`` keeps its old columns."""
        version, base = self._base(run_id)
        if merge_schema and base is not None:
            df = align(df, self._joint_schema(base, df.schema))
        folders, seen = self._write_data(self._bucketed(df, df.schema, self.buckets), self.buckets, **metrics)
        self._publish(version, base, run_id, df.schema, folders, self.buckets)
        return seen

    def append(self, df: DataFrame, run_id: object = None, **metrics: Column) -> dict:
        """Add rows. Columns that are new or missing are NULL on the other side."""
        version, base = self._base(run_id)
        buckets = self._layout(base)
        if base is None:
            folders, seen = self._write_data(self._bucketed(df, df.schema, buckets), buckets, **metrics)
            self._publish(version, base, run_id, df.schema, folders, buckets)
            return seen
        schema = self._joint_schema(base, df.schema)
        aligned = align(df, schema)
        added, seen = self._write_data(self._bucketed(aligned, schema, buckets), buckets, **metrics)
        folders = {b: list(f) for b, f in base["folders"].items()}
        for bucket, new in added.items():
            folders.setdefault(bucket, []).extend(new)
        self._publish(version, base, run_id, schema, folders, buckets)
        return seen

    def vacuum(self, keep: int = 2) -> int:
        """Delete data that none of the last ``keep`` versions lists; returns the folders deleted."""
        used = {f.split("/")[0] for v in self._versions()[-keep:]
                for folders in self._manifest(v)["folders"].values() for f in folders}
        gone = 0
        for name, live in (("data", used), ("stage", set())):
            folder = self._new_path(f"{self.path}/{name}")
            for status in self._fs.listStatus(folder) if self._fs.exists(folder) else []:
                if status.getPath().getName() not in live:
                    gone += bool(self._fs.delete(status.getPath(), True))
        return gone

    def _joint_schema(self, base: dict, incoming: T.StructType) -> T.StructType:
        known = T.StructType.fromJson(json.loads(base["schema"]))
        extra = [T.StructField(f.name, f.dataType) for f in incoming.fields if f.name not in known.names]
        return T.StructType(known.fields + extra)

    def upsert(
        self,
        source: DataFrame,
        run_id: object = None,
        preserve: Sequence[str] = (),
        latest: Sequence[str] = (),
        tie_break: Sequence[Column] | None = None,
        not_before: str | None = None,
    ) -> dict:
        """Update all columns of rows with a known key, insert the others.

        One source row per key is used: the newest by ``latest``. Source rows without a key are
        refused and counted. ``preserve`` names columns that keep their old value on an update, as
        do columns the source does not have. With ``not_before`` a source row that is older by that
        column than the stored row, or has no value where that has one, changes nothing: a late row
        does not undo a newer one. Returns ``rows`` staged and ``refused``.
        """
        if not self.keys:
            raise ValueError("a merge needs key columns")
        version, base = self._base(run_id)
        stored = self._layout(base)
        schema = source.schema if base is None else self._joint_schema(base, source.schema)
        no_key = F.expr(" OR ".join(f"`{k}` IS NULL" for k in self.keys))
        checked = Observation()
        keyed = source.observe(checked, F.count_if(no_key).alias("refused")).dropna(subset=self.keys)
        for k in self.keys:
            keyed = keyed.withColumn(k, F.col(k).cast(schema[k].dataType))
        chosen = keep_latest(keyed, self.keys, latest, tie_break)

        if base is None:
            folders, seen = self._write_data(self._bucketed(chosen, schema, stored), stored)
            self._publish(version, base, run_id, schema, folders, stored)
            return {"rows": seen["rows"], "refused": checked.get["refused"]}

        # The chosen rows are written once and used three times; their file size tells the planner
        # whether they can be broadcast to the target or have to be shuffled to it.
        stage = f"{self.path}/stage/{uuid.uuid4().hex}"
        bucket = self._bucket_of(schema, stored).cast("string")
        written = write_counted(
            chosen.withColumn(BUCKET, bucket), lambda w: w.mode("error").parquet(stage),
            touched=F.collect_set(BUCKET),  # at most one value per bucket
        )
        touched = set(written["touched"])
        seen = {"rows": written["rows"], "refused": checked.get["refused"]}
        if stored != self.buckets:
            touched = None  # every bucket is written anew
        elif not touched:
            self._publish(version, base, run_id, schema, base["folders"], stored)
            return seen
        staged = self.spark.read.schema(
            T.StructType(chosen.schema.fields + [T.StructField(BUCKET, T.StringType())])
        ).parquet(stage)
        fresh = staged.drop(BUCKET)

        target = self._read(base, touched)
        if not_before is not None and not_before in target.columns:
            stored_at = target.select(*self.keys, F.col(not_before).alias("_stored_at")).join(
                fresh.select(*self.keys), self.keys, "left_semi")
            fresh = fresh.join(stored_at, self.keys, "left").filter(
                F.col("_stored_at").isNull() | F.coalesce(F.col(not_before) >= F.col("_stored_at"), F.lit(False))
            ).drop("_stored_at")
        kept, updates = merge_parts(target, fresh, self.keys, preserve, schema)
        merged = self._bucketed(kept.unionByName(updates), schema, self.buckets)
        written, _ = self._write_data(merged, self.buckets)
        folders = {} if touched is None else {b: f for b, f in base["folders"].items() if b not in touched}
        folders.update(written)
        self._publish(version, base, run_id, schema, folders, self.buckets)
        return seen


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], preserve: Sequence[str] = ()) -> DataFrame:
    """The merged table as one DataFrame; ``source`` has one row per key."""
    extra = [T.StructField(f.name, f.dataType) for f in source.schema.fields if f.name not in target.columns]
    kept, updates = merge_parts(target, source, keys, preserve, T.StructType(target.schema.fields + extra))
    return kept.unionByName(updates)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in schema order and type; missing ones are NULL."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def merge_parts(
    target: DataFrame, source: DataFrame, keys: Sequence[str], preserve: Sequence[str], schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """Target rows without a match, and every source row as it will be stored.

    Both joins only need the source keys, so a small source is broadcast and the target is not
    shuffled at all. Kept columns of matched rows come from a narrow read of the target.
    """
    keys = list(keys)
    source_keys = source.select(*keys)
    kept = target.join(source_keys, keys, "left_anti")
    held = [c for c in target.columns if c not in keys and (c in set(preserve) or c not in source.columns)]
    updates = source
    if held:
        old = target.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in held]).join(
            source_keys, keys, "left_semi"
        ).withColumn("_matched", F.lit(True))
        updates = source.join(old, keys, "left")
        for c in held:
            new = F.col(c) if c in source.columns else F.lit(None)
            updates = updates.withColumn(c, F.when(F.col("_matched"), F.col(f"_old_{c}")).otherwise(new))
    return align(kept, schema), align(updates, schema)
