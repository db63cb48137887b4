"""Registration of queries and their expected-result SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.catalog.views import EXPECTED, SCHEMAS, VIEWS
from tierflow.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Base tables and the views on them as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = str(folder).rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in SCHEMAS:
            return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")
        if name in VIEWS:
            return self.sql(VIEWS[name])
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        """Spark SQL with ``{table}`` placeholders."""
        used = set(re.findall(r"\{(\w+)\}", text))
        return self.spark.sql(text, **{name: getattr(self, name) for name in used})

    @cached_property
    def scratch(self) -> str:
        return scratch_dir(self.spark, "query")


def comparable(df: DataFrame) -> DataFrame:
    """Types that both engines print alike: whole numbers as bigint, decimals as double, dates and
    timestamps as text."""
    def cell(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")  # with its fraction of a second
        return c.alias(f.name)

    return df.select(*[cell(f) for f in df.schema.fields])


def with_views(sql: str) -> str:
    """Prefix the views and expected tables a statement mentions, in dependency order."""
    known = {**VIEWS, **EXPECTED}
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in ordered and re.search(rf"\b(?:from|join)\s+\{{?{name}\b", text, re.IGNORECASE):
                visit(known[name])
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    ctes = ", ".join(f"{name} AS ({known[name]})" for name in ordered)
    text = f"WITH {ctes} {sql}" if ctes else sql
    return re.sub(r"\{(\w+)\}", r"\1", text).strip()


def query(name: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under a name, with its expected-result SQL."""
    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: comparable(build(Tables(spark, folder)))
        if sql:
            ORACLES[name] = with_views(sql)
        return build
    return register
