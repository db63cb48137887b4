"""Records of large text files that are not one to a line, read by several tasks.

A file is read in ranges, as any text is, and cut at a mark: the line break of a CSV file, the closing brace of a
JSON document. Whether a mark ends a record depends on what stands before it: an odd number of quotes, or open braces.
So each range is cut into chunks of at most 256 pieces, each chunk is summed up first (its quotes, then its braces and
ends), the sums of the chunks before are added, of which there is one row for each chunk, and then each piece knows its
state and the number of its record. A task gets chunks, not a whole range. Pieces that are whole records are passed on as
they are; others are joined by file and number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.session import scratch_dir

_CHUNK = ["file", "range", "chunk"]
_CHUNK_BITS = 8


def _pieces(spark: SparkSession, path: str, mark: str, recursive: bool) -> DataFrame:
    return spark.read.text(path, lineSep=mark, recursiveFileLookup=recursive).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("at")  # rising within a range
    ).withColumn("chunk", F.shiftright("at", _CHUNK_BITS))


def _carried(pieces: DataFrame, column: str, name: str) -> DataFrame:
    """``pieces`` with the sum of ``column`` over all pieces of the file before, as ``name``."""
    def before(window, c: str) -> Column:
        return F.coalesce(F.sum(c).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    sums = pieces.groupBy(*_CHUNK).agg(F.sum(column).alias("_sum"))
    chunks = sums.withColumn("_before", before(Window.partitionBy("file").orderBy("range", "chunk"), "_sum")).drop("_sum")
    within = before(Window.partitionBy(*_CHUNK).orderBy("at"), column)
    return pieces.join(chunks, _CHUNK).withColumn(name, F.col("_before") + within).drop("_before")


def _staged(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _joined(pieces: DataFrame, begins: Column, ends: Column, mark: str) -> DataFrame:
    """``file``, ``number``, ``record``: the pieces of each record joined by ``mark``."""
    numbered = _staged(_carried(pieces.withColumn("_ends", ends.cast("int")), "_ends", "number").select(
        "file", "number", "range", "at", "value", (begins & ends).alias("whole")), "pieces")
    whole = numbered.where("whole").select("file", "number", F.col("value").alias("record"))
    parts = numbered.where("not whole").groupBy("file", "number").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("range", "at", "value"))), lambda p: p["value"]), mark).alias("record"))
    return whole.union(parts)


def csv_records(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """``file``, ``number`` (from 0) and ``record``: CSV records with the line breaks that stand within quotes.

    ``"`` quotes, and ``\\`` or a second quote escapes. A quote that is never closed takes the rest of its file into
    its record, as in any reader. Line ends may be those of Windows.
    """
    lines = _pieces(spark, path, "\n", recursive)
    bare = F.regexp_replace("value", r"\\.", "")
    odd = (F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))) % 2
    lines = _carried(lines.withColumn("_odd", odd), "_odd", "_quotes")
    inside = F.col("_quotes") % 2 == 1
    out = _joined(lines, ~inside, (F.col("_quotes") + F.col("_odd")) % 2 == 0, "\n")
    return out.withColumn("record", F.regexp_replace("record", r"\r$", ""))


def json_elements(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """``file``, ``number`` (from 0) and ``record``: the objects of JSON documents that each hold one array of them.

    A document may hold a single object, too, and start with a byte-order mark. What stands between objects is left
    out, and so are elements of the array that are no objects.
    """
    pieces = _pieces(spark, path, "}", recursive)
    segments = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')
    pieces = pieces.withColumn("_segments", segments).withColumn("_odd", (F.size("_segments") - 1) % 2)
    pieces = _staged(_carried(pieces, "_odd", "_quotes"), "pieces")
    # Segments between quotes are by turns outside and inside of texts; the brace that ends the piece follows the last.
    first_outside = F.col("_quotes") % 2
    opened = F.aggregate(
        F.filter("_segments", lambda x, i: (i + first_outside) % 2 == 0), F.lit(0),
        lambda n, x: n + F.length(x) - F.length(F.replace(x, F.lit("{"), F.lit(""))))
    closes = (F.col("_quotes") + F.col("_odd")) % 2 == 0
    pieces = pieces.withColumn("_deeper", opened - closes.cast("int")).drop("_segments")
    pieces = _carried(pieces, "_deeper", "_depth")
    out = _joined(pieces, F.col("_depth") == 0, closes & (F.col("_depth") + F.col("_deeper") == 0), "}")
    record = F.concat(F.regexp_replace("record", r"(?s)^[^{]*", ""), F.lit("}"))
    # The text after the last object has no brace to end it.
    return out.withColumn("record", record).where(F.startswith("record", F.lit("{")))
