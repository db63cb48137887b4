"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.session import scratch_dir


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    This cuts the lineage with a copy that does not live on an executor, so that a lost executor
    costs only the tasks it was running.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the columns an operator reads: ``doc_id`` (long) and ``text`` (null: empty)."""
    return df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def remainder(id_column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; -1 where the id is null."""
    return F.coalesce(F.crc32(id_column.cast("string")) % modulus, F.lit(-1))


def bytes_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a text column; null gives empty bytes."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def appended(df: DataFrame, fields: list[T.StructField], columns: Callable[..., list[pa.Array]],
             inputs: list[str]) -> DataFrame:
    """All columns of ``df`` and ``fields``, computed batch by batch by ``columns(*inputs)``.

    No shuffle. Names in ``fields`` must not be taken; see ``free_name``.
    """
    schema = T.StructType([*df.schema.fields, *fields])
    at = [df.columns.index(c) for c in inputs]
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = columns(*(batch.column(i) for i in at))
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=names)

    return df.mapInArrow(run, schema)


def hash_share(column: Column, share: float, seed: int = 0) -> Column:
    """Whether a row falls into a fixed ``share`` of the hash range; does not depend on partitions."""
    steps = 1 << 24
    return F.pmod(F.xxhash64(F.lit(seed), column), F.lit(steps)) < F.lit(int(share * steps) if share < 1 else steps)
