"""File readers with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.sources.split import csv_records, json_elements

Schema = T.StructType | str


def text_schema(columns: Sequence[str]) -> T.StructType:
    """All columns as text, to be typed by rules later."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_parquet(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    """A file, a directory or a glob such as ``trips_2026-*.parquet``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


#: How CSV files write a missing value; an empty text is written as quotes without content.
CSV_NULL = "\\N"
CSV_OPTIONS = {"sep": ",", "quote": '"', "escape": "\\", "nullValue": CSV_NULL}


def csv_header(spark: SparkSession, path: str, recursive: bool = False, **options: str) -> list[str]:
    """Column names in the first line of one of the files."""
    return spark.read.csv(path, header=True, recursiveFileLookup=recursive, **{**CSV_OPTIONS, **options}).columns


def by_header(schema: T.StructType, names: Sequence[str], rescue: str | None = None) -> tuple[T.StructType, list[Column]]:
    """The schema of files with the header ``names``, and the columns of ``schema`` taken from them by name.

    A column the files lack, and one nobody asked for, is an error; with ``rescue`` the first is NULL and
    the others go as a JSON text into the column of that name.
    """
    missing = [f for f in schema.names if f not in names]
    extra = [n for n in names if n not in schema.names]
    if rescue is None and (missing or extra):
        raise ValueError(f"the header has no {missing} and {extra} nobody asked for")
    found = T.StructType([schema[n] if n in schema.names else T.StructField(n, T.StringType()) for n in names])
    columns = [(F.lit(None).cast(f.dataType) if f.name in missing else F.col(f"`{f.name}`")).alias(f.name) for f in schema.fields]
    if rescue is not None:
        rest = F.map_filter(F.create_map(*[x for n in extra for x in (F.lit(n), F.col(f"`{n}`"))]), lambda _, v: v.isNotNull()) if extra else None
        columns.append((F.lit(None).cast("string") if rest is None else F.when(F.size(rest) > 0, F.to_json(rest))).alias(rescue))
    return found, columns


def read_csv(
    spark: SparkSession,
    path: str,
    schema: Schema,
    header: bool = True,
    recursive: bool = False,
    multi_line: bool = False,
    rescue: str | None = None,
    **options: str,
) -> DataFrame:
    """Comma separated, ``"`` quotes, ``\\`` escapes; columns by the names of the header, see ``by_header``.

    No inference pass over the data: one line tells the header, and a file with another one is an error.
    Without a header columns are taken by position. ``multi_line`` reads line breaks within quotes; a file is
    still read by several tasks, see ``split``. An empty text in quotes is an empty text, nothing at all is NULL.
    """
    settings = {**CSV_OPTIONS, **options}
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    found, columns = by_header(wanted, csv_header(spark, path, recursive, **options), rescue) if header else (wanted, [])
    if multi_line:
        rows = _parsed_records(csv_records(spark, path, recursive), found, header, settings)
    elif header:
        rows = spark.read.schema(found).csv(path, header=True, enforceSchema=False, recursiveFileLookup=recursive, **settings)
    else:
        rows = spark.read.schema(wanted).csv(path, recursiveFileLookup=recursive, **settings)
    return rows if not header or (found == wanted and rescue is None) else rows.select(*columns)


def _parsed_records(records: DataFrame, schema: T.StructType, header: bool, settings: dict[str, str]) -> DataFrame:
    """Columns of CSV records; the first of each file has to be the header."""
    def parsed(kinds: T.StructType) -> Column:
        return F.from_csv("record", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds.fields), settings)

    rows = records.where(F.trim("record") != "")
    if header:
        names = F.array(*[F.lit(n) for n in schema.names])
        found = parsed(T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema) + 1)]))
        given = F.filter(F.array(*[found.getField(f"c{i}") for i in range(len(schema) + 1)]), lambda x: x.isNotNull())
        wrong = F.raise_error(F.concat(F.lit("another header in "), F.col("file"))).cast("boolean")
        rows = rows.where(F.when(F.col("number") > 0, F.lit(True)).when(given == names, F.lit(False)).otherwise(wrong))
    return rows.select(parsed(schema).alias("row")).select("row.*")


def read_json(
    spark: SparkSession, path: str, schema: Schema, multi_line: bool = False, limit: int | None = None
) -> DataFrame:
    """JSON lines, or with ``multi_line`` documents that hold one array of objects each, which are split over tasks."""
    if multi_line:
        df = json_elements(spark, path).select(F.from_json("record", schema).alias("row")).select("row.*")
    else:
        df = spark.read.schema(schema).json(path)
    return df if limit is None else df.limit(limit)


def load(spark: SparkSession, fmt: str, path: str, schema: Schema | None = None, **options: str) -> DataFrame:
    """Any installed format by name."""
    reader = spark.read.format(fmt).options(**options)
    return (reader if schema is None else reader.schema(schema)).load(path)


def query_path(
    spark: SparkSession, fmt: str, path: str, where: str | None = None, limit: int | None = None
) -> DataFrame:
    """``SELECT * FROM format.`path` `` with an optional filter and preview limit."""
    df = spark.sql(f"SELECT * FROM {fmt}.`{path}`")
    if where:
        df = df.filter(where)
    return df if limit is None else df.limit(limit)


def landing_path(root: str, folder: str, slot: str, table: str) -> str:
    """``root/folder/yyyy/MM/dd/HH/mm/Table.csv``; the slot may end in a slash."""
    return "/".join([root.rstrip("/"), folder.strip("/"), slot.strip("/"), f"{table}.csv"])


def landing_slot(when: Column) -> Column:
    """Slot text of a timestamp."""
    return F.date_format(when, "yyyy/MM/dd/HH/mm")


def slot_of_file(path: Column) -> Column:
    """Recover the slot from the file path of a row."""
    return F.regexp_extract(path, r"(\d{4}/\d{2}/\d{2}/\d{2}/\d{2})/", 1)


def has_bytes(spark: SparkSession, path: str) -> bool:
    """False for a missing path and for files or folders without any byte."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(target) or []
    return any(fs.getContentSummary(status.getPath()).getLength() > 0 for status in found)


def read_csv_if_filled(spark: SparkSession, path: str, schema: Schema, **options: str) -> DataFrame | None:
    """None for a missing, empty or header-only input, so the caller leaves its target alone."""
    if not has_bytes(spark, path):
        return None
    df = read_csv(spark, path, schema, **options)
    return None if df.isEmpty() else df
