"""The banking run: source to bronze, bronze to silver, silver to gold, report."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tierflow.control import loads
from tierflow.control.audit import Audit, run_report
from tierflow.control.registry import TableSpec, specs
from tierflow.control.watermarks import Watermarks
from tierflow.operators.cleanse import Rule, apply_rules
from tierflow.plans import banking
from tierflow.sinks.snapshot import Snapshot
from tierflow.sources.files import text_schema
from tierflow.sources.jdbc import edges_query, range_predicates, slice_query
from tierflow.streaming.ingest import STREAM_BATCH, csv_stream, drain


@dataclass
class BankingRun:
    """One run over the registered tables.

    ``read_query`` runs a pushed subquery on the source database and returns its rows. Files are
    all text; ``file_rules`` types them before silver compares watermarks.
    """

    spark: SparkSession
    root: str
    run_id: int
    now: datetime
    read_query: Callable[[str], DataFrame]
    file_rules: Mapping[str, tuple[Rule, ...]]
    quote: str = '"'
    buckets: int = 64
    parallel: int = 4
    #: Columns by whose ranges tables are extracted over several connections, how many, and the read by conditions.
    split_by: Mapping[str, str] = field(default_factory=dict)
    connections: int = 8
    read_ranges: Callable[[str, list[str]], DataFrame] | None = None
    #: The source database's aggregate that finds shares of a large table, see ``edges_query``.
    quantile: str | None = None

    def __post_init__(self) -> None:
        self.audit = Audit(self.spark, f"{self.root}/control/runs")
        self.marks = Watermarks(self.spark, f"{self.root}/control/watermarks")

    def silver(self, spec: TableSpec) -> Snapshot:
        keyed = spec.load_type == "MERGE"
        return Snapshot(self.spark, f"{self.root}/silver/{spec.table_name}", spec.keys,
                        self.buckets if keyed else 1)

    def bronze_path(self, spec: TableSpec) -> str:
        return f"{self.root}/bronze/{spec.table_name}"

    def source_to_bronze(self, spec: TableSpec) -> int:
        """Append the new rows of one source. A database gets the watermark pushed down; a folder of
        files is read by a stream that remembers its files."""
        spec.check()
        system = (spec.source_system or "").lower()
        if system == "sqlserver":
            return self.audit.run(self.run_id, spec.table_id, "Bronze", lambda: self._land_query(spec))
        if system == "blob":
            return self.audit.run(self.run_id, spec.table_id, "Bronze", lambda: self._land_files(spec))
        raise ValueError(f"unsupported source system {spec.source_system!r}")

    def _land_query(self, spec: TableSpec) -> int:
        last = self.marks.get(spec.table_id) if spec.incremental else None
        column = spec.watermark_column if spec.incremental else None
        query = slice_query(f"{spec.source_schema}.{spec.source_table}", column, last, quote=self.quote,
                            including=spec.load_type == "MERGE")
        rows = self._extract(query, self.split_by.get(spec.table_name))
        return loads.land_bronze(rows, self.bronze_path(spec), self.run_id, self.now)

    def _extract(self, query: str, split: str | None) -> DataFrame:
        """One connection, or one for each of the equal shares of the rows that the database finds by ``split``."""
        if split is None or self.read_ranges is None:
            return self.read_query(query)
        edges = self.read_query(edges_query(query, split, self.connections, self.quote, self.quantile))
        return self.read_ranges(query, range_predicates([r.edge for r in edges.collect()], split, self.quote))

    def _file_columns(self, spec: TableSpec) -> list[str]:
        return [r.source or r.target for r in self.file_rules[spec.table_name]]

    def _land_files(self, spec: TableSpec) -> int:
        rows = csv_stream(self.spark, spec.source_path, self._file_columns(spec)).withColumns(
            {"insert_timestamp": F.lit(self.now), loads.BATCH: F.lit(self.run_id).cast("bigint")})
        return drain(rows, self.bronze_path(spec), f"{self.root}/checkpoints/{spec.table_name}", [loads.BATCH])

    def bronze_to_silver(self, spec: TableSpec) -> int:
        """Only batches since the last one silver had are read; a full load reads the newest."""
        since = self.marks.last_run(spec.table_id) if spec.incremental else None
        newest = None
        if spec.table_name in self.file_rules:
            schema = text_schema(self._file_columns(spec)).add(loads.BATCH, LongType())
            raw = self.spark.read.schema(schema).parquet(self.bronze_path(spec)).drop(STREAM_BATCH)
            recent = raw if since is None else raw.filter(F.col(loads.BATCH) >= since)
            bronze = apply_rules(recent, (*self.file_rules[spec.table_name], Rule(loads.BATCH, "bigint")))
        else:
            if spec.load_type == "FULL":
                since = newest = max(loads.batches(self.spark, self.bronze_path(spec)))
            bronze = loads.read_bronze(self.spark, self.bronze_path(spec), since=since)
        return loads.audited_silver(bronze, self.silver(spec), spec, self.marks, self.audit, self.run_id,
                                    self.now, newest)

    def gold_builders(self, tables: Mapping[str, TableSpec]) -> dict[str, Callable[[], DataFrame]]:
        def t(name: str) -> DataFrame:
            return self.silver(tables[name]).read()

        return {
            "customer_360": lambda: banking.customer_360(
                t("customers"), t("accounts"), t("transactions"), t("branches"), t("credit_bureau_reports")),
            "branch_performance": lambda: banking.branch_performance(
                t("branches"), t("customers"), t("accounts"), t("transactions")),
            "transaction_channel_summary": lambda: banking.transaction_channel_summary(
                t("transactions"), t("payment_gateway_logs")),
            "daily_bank_kpi": lambda: banking.daily_bank_kpi(
                t("transactions"), t("customers"), t("accounts"), t("credit_bureau_reports")),
            "risk_customer_summary": lambda: banking.risk_customer_summary(t("credit_bureau_reports")),
        }

    def run(self, registry: DataFrame, parameters: DataFrame) -> DataFrame:
        """Every active table of every layer; returns the report of the run.

        Tables do not depend on each other within a layer: they start in load order and up to
        ``parallel`` of them share the cluster, so the last tasks of one do not keep it idle. A
        failed table is recorded with its error, the others of its layer still load, and gold is not
        built on it: the report says so, and ``run_status`` counts the run as failed.
        """
        sources = specs(registry, parameters, "sqlserver") + specs(registry, parameters, "blob")
        builders = self.gold_builders({s.table_name: s for s in sources})

        def load(spec: TableSpec) -> None:
            self.source_to_bronze(spec)
            self.bronze_to_silver(spec)

        def publish(spec: TableSpec) -> None:
            loads.publish_gold(spec.table_name, builders, f"{self.root}/gold", self.spark, self.audit,
                               self.run_id, spec.table_id)

        def failures(job: Callable[[TableSpec], None], tables: list[TableSpec]) -> list[BaseException]:
            with ThreadPoolExecutor(self.parallel) as pool:
                found = [f.exception() for f in [pool.submit(job, table) for table in tables]]
            return [e for e in found if e is not None]

        errors = failures(load, sources) or failures(publish, specs(registry, parameters, "silver"))
        report = run_report(self.audit.read(), registry, self.run_id)
        if errors and report.filter("status = 'FAILED'").isEmpty():
            raise errors[0]  # it failed before its audit row
        return report

    def gold(self, name: str) -> DataFrame:
        return Snapshot(self.spark, f"{self.root}/gold/{name}").read()
