"""The hospital run: control rows to bounded extracts, landed CSV to silver, silver to published gold."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.control import loads
from tierflow.control.watermarks import set_last_value
from tierflow.plans import hospital
from tierflow.sinks.files import write_csv
from tierflow.sinks.records import Records
from tierflow.sinks.snapshot import Snapshot
from tierflow.sources.files import landing_path

CONTROL = "source_schema string, source_table string, folder_name string, watermark_column string, last_load_value string"
OUTCOME = ("run string, table_name string, read bigint, no_key bigint, unreadable_key bigint, repeated bigint, "
           "written bigint")
#: Keys of the gold tables that are merged; the encounters are replaced.
GOLD_KEYS: Mapping[str, tuple[str, ...]] = {
    "patients_demographics": ("patient_id",),
    "departments_directory": ("department_id", "hospital_id"),
    "hospitals_directory": ("hospital_id",),
    "physicians_directory": ("provider_id",),
}


@dataclass
class HospitalRun:
    """One run over the control rows. ``sources`` holds each source table by its name in the control rows."""

    spark: SparkSession
    root: str
    now: datetime
    buckets: int = 16
    #: Rows of a landed file, which is compressed.
    file_rows: int = 500_000

    @property
    def outcomes(self) -> Records:
        """What each run read, refused and wrote for each silver table."""
        return Records(self.spark, f"{self.root}/control/silver", OUTCOME, ["run", "table_name"])

    def extract(self, sources: Mapping[str, DataFrame], control: DataFrame) -> DataFrame:
        """Land the new rows of every control row in the slot of this run; the control rows, moved on."""
        slot = f"{self.now:%Y/%m/%d/%H/%M}"
        rows = control.collect()  # one row for each source table
        moved = loads.bounded_extracts(
            sources, [(r.source_table, r.watermark_column, r.last_load_value) for r in rows],
            lambda table, part: write_csv(
                part, landing_path(f"{self.root}/landing", table, slot, table), compressed_rows=self.file_rows),
        )
        for r in rows:
            if moved[r.source_table] != r.last_load_value:
                control = set_last_value(control, r.source_schema, r.source_table, moved[r.source_table])
        return control

    def clean(self) -> dict[str, DataFrame]:
        """Silver tables of what this run landed; a table without new rows stays as it was."""
        slot = f"{self.now:%Y/%m/%d/%H/%M}"
        for table in hospital.SILVER.values():
            outcome = hospital.silver_outcome(self.spark, table, f"{self.root}/landing", slot, f"{self.root}/silver", self.now)
            if outcome is not None:
                self.outcomes.put({"run": f"{self.now:%Y%m%d%H%M}", "table_name": table.name, **outcome})
        return {name: self.spark.read.parquet(f"{self.root}/silver/{name}") for name in hospital.SILVER}

    def publish(self, silver: Mapping[str, DataFrame]) -> None:
        """Encounters are replaced, with the columns of older versions; the directories are merged by key."""
        as_of = F.lit(self.now.date())
        gold = {
            "encounters_summary": hospital.encounters_summary(silver["encounters"]),
            "patients_demographics": hospital.patients_demographics(silver["patients"], as_of),
            "departments_directory": hospital.departments_directory(silver["departments"]),
            "hospitals_directory": hospital.hospitals_directory(silver["hospitals"]),
            "physicians_directory": hospital.physicians_directory(silver["physicians"], silver["encounters"]),
        }
        for name, rows in gold.items():
            stamped = rows.withColumn("gold_processed_at", F.lit(self.now))
            if name in GOLD_KEYS:
                self.gold(name).upsert(stamped)
            else:
                self.gold(name).overwrite(stamped, merge_schema=True)

    def gold(self, name: str) -> Snapshot:
        return Snapshot(self.spark, f"{self.root}/gold/{name}", GOLD_KEYS.get(name, ()), self.buckets)

    def run(self, sources: Mapping[str, DataFrame], control: DataFrame) -> DataFrame:
        moved = self.extract(sources, control)
        self.publish(self.clean())
        return moved
