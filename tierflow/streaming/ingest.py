"""Each landed file is read once; what does not fit the schema is kept."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.sinks.files import write_counted
from tierflow.sources.files import CSV_OPTIONS, by_header, csv_header, text_schema

STREAM_BATCH = "stream_batch"
RESCUED = "_rescued_data"


# --- schema kept between runs -------------------------------------------------------------

class SchemaState:
    """Schema of a stream, kept as numbered JSON files: the one with the highest number holds."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.location = spark, location.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.location).getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        folder = self._path(self.location)
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json"))

    def read(self) -> T.StructType | None:
        numbers = self._numbers()
        if not numbers:
            return None
        stream = self._fs.open(self._path(f"{self.location}/{numbers[-1]}.json"))
        try:
            return T.StructType.fromJson(
                json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def write(self, schema: T.StructType) -> T.StructType:
        out = self._fs.create(self._path(f"{self.location}/{max(self._numbers(), default=-1) + 1}.json"), False)
        out.write(bytearray(schema.json(), "utf-8"))
        out.close()
        return schema

    def widened(self, found: T.StructType) -> T.StructType:
        """The kept schema with the fields of ``found`` it lacks, at its end. Types that were kept stay."""
        kept = self.read()
        new = [f for f in found.fields if kept is None or f.name not in kept.names]
        if kept is not None and not new:
            return kept
        return self.write(T.StructType([*(kept.fields if kept else []), *new]))


def inferred(spark: SparkSession, paths: str | list[str], sample_ratio: float = 1.0) -> T.StructType:
    """Schema of JSON lines; lines that are no JSON objects say nothing."""
    return spark.read.option("samplingRatio", sample_ratio).option("mode", "DROPMALFORMED").json(paths).schema


def stored_schema(spark: SparkSession, landing: str, location: str, sample_ratio: float = 1.0) -> T.StructType:
    """Schema of the JSON lines in ``landing``: inferred on the first run, read back on later ones."""
    state = SchemaState(spark, location)
    return state.read() or state.write(inferred(spark, landing, sample_ratio))


# --- rescue -------------------------------------------------------------------------------

def parse_with_rescue(lines: DataFrame, schema: T.StructType, line: str = "_line") -> DataFrame:
    """Add the typed fields of a JSON line and the rescued rest as text.

    Rescued are fields the schema does not know and given values that do not fit their type, as a
    JSON object, and a line that is not a JSON object as it stands. A JSON null is not rescued.
    Each line is parsed once as text values and once as typed values, in steps of their own: the
    results are used several times and would otherwise be parsed again for each use.
    """
    text_values = T.MapType(T.StringType(), T.StringType())
    parsed = lines.withColumn("_raw", F.from_json(line, text_values))
    parsed = parsed.withColumn("_typed", F.when(F.col("_raw").isNotNull(), F.from_json(line, schema)))

    def lost(name: Column, value: Column) -> Column:
        misfit = F.lit(False)
        for field in schema.names:
            misfit = misfit | ((name == field) & F.col("_typed").getField(field).isNull())
        return value.isNotNull() & (~name.isin(*schema.names) | misfit)

    parsed = parsed.withColumn("_rest", F.map_filter("_raw", lost))
    rescued = F.when(F.col("_raw").isNull(), F.col(line)).when(F.size("_rest") > 0, F.to_json("_rest"))
    return parsed.select(
        *[c for c in lines.columns],
        *[F.col("_typed").getField(name).alias(name) for name in schema.names],
        rescued.alias(RESCUED),
    )


def with_file(lines: DataFrame) -> DataFrame:
    """Lines that are not blank, with the file they come from."""
    return lines.filter(F.trim("value") != "").select(
        F.col("value").alias("_line"), F.col("_metadata.file_path").alias("_file"))


def json_rows(lines: DataFrame, schema: T.StructType, lineage: bool = True) -> DataFrame:
    """Rows of JSON lines with rescue and lineage columns; blank lines are no rows."""
    return _typed_rows(with_file(lines), schema, lineage)


def _typed_rows(base: DataFrame, schema: T.StructType, lineage: bool = True) -> DataFrame:
    extra = [F.current_timestamp().alias("ingested_at"), F.col("_file").alias("source_file")]
    return parse_with_rescue(base, schema).select(*schema.names, RESCUED, *(extra if lineage else []))


# --- streams ------------------------------------------------------------------------------

def json_stream(spark: SparkSession, landing: str, schema: T.StructType, lineage: bool = True,
                max_files: int | None = None) -> DataFrame:
    """Unbounded rows of a folder of JSON lines."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return json_rows(reader.text(landing), schema, lineage)


def csv_stream(
    spark: SparkSession, landing: str, columns: Sequence[str], max_files: int | None = None, rescue: bool = False
) -> DataFrame:
    """Unbounded rows of a folder of CSV files, every column as text, by the names of the header.

    The files there at the start tell the header; a file with another one stops the stream. Columns nobody
    asked for are an error, or go to the rescue column with ``rescue``.
    """
    found, chosen = by_header(text_schema(columns), csv_header(spark, landing), RESCUED if rescue else None)
    reader = spark.readStream.schema(found)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(landing, header=True, enforceSchema=False, **CSV_OPTIONS).select(*chosen)


class BatchFolders:
    """A ``foreachBatch`` sink: each batch of a stream is a folder, so a batch that is repeated replaces itself.

    ``rows`` holds the rows of each batch written so far, counted in the write. Folders carry the id of the
    stream, which lives in its checkpoint: a stream that starts anew does not touch what an earlier one wrote.
    What a stopped attempt left of a batch is removed first, also under another value of ``partition_by``.
    """

    def __init__(self, target: str, checkpoint: str, partition_by: Sequence[str] = (),
                 shape: Callable[[DataFrame], DataFrame] = lambda batch: batch):
        self.target, self.checkpoint = target.rstrip("/"), checkpoint.rstrip("/")
        self.partition_by, self.shape = list(partition_by), shape
        self.rows: dict[int, int] = {}
        self._stream = None

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if self._stream is None:
            self._stream = json.loads(spark.read.text(f"{self.checkpoint}/metadata").first()[0])["id"][:8]
        name = f"{self._stream}-{number}"
        path = spark._jvm.org.apache.hadoop.fs.Path("/".join(
            [self.target, *(f"{c}=*" for c in self.partition_by), f"{STREAM_BATCH}={name}"]))
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for left in fs.globStatus(path) or []:
            fs.delete(left.getPath(), True)
        stamped = self.shape(batch).withColumn(STREAM_BATCH, F.lit(name))
        self.rows[number] = write_counted(stamped, lambda w: w.mode("append").partitionBy(
            *self.partition_by, STREAM_BATCH).parquet(self.target))["rows"]


def _start(rows: DataFrame, sink: BatchFolders, **trigger: bool):
    writer = rows.writeStream.option("checkpointLocation", sink.checkpoint).foreachBatch(sink)
    return (writer.trigger(**trigger) if trigger else writer).start()


def drain(rows: DataFrame, target: str, checkpoint: str, partition_by: Sequence[str] = ()) -> int:
    """Append everything that has not been read yet and stop; returns the rows this run wrote.

    The checkpoint makes each input file count once, also when the run is repeated after a failure.
    The rows are counted where they are written: lines that are no rows do not count.
    """
    sink = BatchFolders(target, checkpoint, partition_by)
    _start(rows, sink, availableNow=True).awaitTermination()
    return sum(sink.rows.values())


def follow(rows: DataFrame, target: str, checkpoint: str):
    """Append continuously; the caller stops the returned query."""
    return _start(rows, BatchFolders(target, checkpoint))


def drain_json(spark: SparkSession, landing: str, target: str, checkpoint: str, location: str,
               max_files: int | None = None) -> int:
    """JSON lines not read yet, as rows of the schema kept at ``location``; returns the rows this run wrote.

    The first batch tells the schema. A later batch with fields that are not in it widens it before the batch is
    written; rows from before have NULL there. Values that do not fit the kept type are rescued, as are lines that
    are no objects. A batch repeated after a failure finds the schema it widened itself, and gives the same rows.
    """
    state = SchemaState(spark, location)

    def shape(batch: DataFrame) -> DataFrame:
        files = [r[0] for r in batch.select("_file").distinct().collect()]  # of one batch; see max_files
        return _typed_rows(batch, state.widened(inferred(spark, files)) if files else state.read() or T.StructType([]))

    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    sink = BatchFolders(target, checkpoint, shape=shape)
    _start(with_file(reader.text(landing)), sink, availableNow=True).awaitTermination()
    return sum(sink.rows.values())


def landed(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    """What streams wrote to ``target``; with a widened ``schema``, such as that of a ``SchemaState``, also its lineage columns."""
    if schema is None:
        return spark.read.parquet(target).drop(STREAM_BATCH)
    whole = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType()),
                          T.StructField("ingested_at", T.TimestampType()), T.StructField("source_file", T.StringType())])
    return spark.read.schema(whole).parquet(target).drop(STREAM_BATCH)
