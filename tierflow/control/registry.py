"""Which tables to load and how."""

from __future__ import annotations

import ast
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow import fixed_values as fx

REGISTRY_SCHEMA = (
    "table_id int, table_name string, source_system string, source_schema string, "
    "source_table string, target_layer string, load_order int, source_path string"
)
PARAMETER_SCHEMA = "table_id int, parameter_name string, parameter_value string"
PARAMETERS = ("load_type", "primary_key", "watermark_column")


@dataclass(frozen=True)
class TableSpec:
    """One table to load. ``primary_key`` may name several columns separated by commas."""

    table_id: int
    table_name: str
    load_type: str
    primary_key: str | None = None
    watermark_column: str | None = None
    source_system: str | None = None
    source_schema: str | None = None
    source_table: str | None = None
    source_path: str | None = None

    @property
    def keys(self) -> list[str]:
        return [k.strip() for k in (self.primary_key or "").split(",") if k.strip()]

    @property
    def incremental(self) -> bool:
        return self.load_type in (fx.APPEND, fx.MERGE) and bool(self.watermark_column)

    def check(self) -> "TableSpec":
        """Before anything is read or written, also on the first load."""
        if self.load_type not in (fx.FULL, fx.APPEND, fx.MERGE):
            raise ValueError(f"unknown load type {self.load_type!r} for {self.table_name}")
        if self.load_type == fx.MERGE and not self.keys:
            raise ValueError(f"{self.table_name}: a merge needs a primary key")
        return self


def required(**values: object) -> None:
    """Every named value must be given."""
    missing = [name for name, value in values.items() if value is None or value == ""]
    if missing:
        raise ValueError(f"missing: {', '.join(missing)}")


def spec_from_text(metadata: str, parameters: str) -> TableSpec:
    """A spec from the two dictionaries a caller passes as text, with single or double quotes."""
    required(table_metadata=metadata, table_parameters=parameters)
    table, settings = ast.literal_eval(metadata), ast.literal_eval(parameters)
    required(table_id=table.get("table_id"), table_name=table.get("table_name"))
    text = {k: (None if v in ("", None) else str(v)) for k, v in {**table, **settings}.items()}
    return TableSpec(
        int(table["table_id"]), text["table_name"], text.get("load_type") or "",
        *[text.get(k) for k in ("primary_key", "watermark_column", "source_system", "source_schema",
                                "source_table", "source_path")],
    )


def seed_registry(spark: SparkSession, landing: str = "") -> DataFrame:
    """The banking tables with their layers; all active. Files land below ``landing``."""
    rows = [(*r, f"{landing.rstrip('/')}/{r[1]}" if r[2] == "blob" else None) for r in fx.REGISTRY_ROWS]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA).withColumn("active_flag", F.lit(True))


def seed_parameters(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fx.PARAMETER_ROWS, PARAMETER_SCHEMA)


def active_tables(registry: DataFrame, source_system: str) -> DataFrame:
    """Active tables of one source system, whatever its spelling, in load order."""
    required(source_system=source_system)
    wanted = F.lower(F.col("source_system")) == source_system.lower()
    return registry.filter(F.col("active_flag") & wanted).orderBy("load_order", "table_id")


def parameters_wide(
    parameters: DataFrame, key: str = "table_id", names: tuple[str, ...] = PARAMETERS
) -> DataFrame:
    """One row per table with a column per parameter; a repeated parameter keeps its largest value.

    The names are known, so this is one partial aggregation and no list is collected per table.
    """
    return parameters.groupBy(key).agg(*[
        F.max(F.when(F.col("parameter_name") == n, F.col("parameter_value"))).alias(n) for n in names
    ])


def load_types(registry: DataFrame, parameters: DataFrame) -> DataFrame:
    """Load type per table name."""
    chosen = parameters.filter(F.col("parameter_name") == "load_type")
    return registry.join(chosen, "table_id").select("table_name", F.col("parameter_value").alias("load_type"))


def specs(registry: DataFrame, parameters: DataFrame, source_system: str) -> list[TableSpec]:
    """The tables to load, in order. The registry is configuration: a few rows per table."""
    wide = parameters_wide(parameters)
    rows = active_tables(registry, source_system).join(wide, "table_id", "left").orderBy("load_order", "table_id")
    return [
        TableSpec(r["table_id"], r["table_name"], r["load_type"], r["primary_key"], r["watermark_column"],
                  r["source_system"], r["source_schema"], r["source_table"], r["source_path"])
        for r in rows.collect()
    ]
