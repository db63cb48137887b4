"""Control rows: a few small rows that are inserted or replaced by key, one at a time.

Each row is one JSON file named after its key, so writing it needs no Spark job and replacing it is
one atomic rename. Spark reads the folder as a table. Not for data: see ``Snapshot``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class Records:
    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str]):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema: T.StructType = T.StructType.fromDDL(schema)
        self.keys = list(keys)
        self._hadoop = spark._jvm.org.apache.hadoop
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._hadoop.fs.Path(self.path).getFileSystem(self._conf)

    def _file(self, *key: object):
        return self._hadoop.fs.Path(f"{self.path}/{'-'.join(str(k) for k in key)}.json")

    def put(self, row: Mapping[str, object]) -> None:
        """Insert the row or replace the row with the same key."""
        plain = {k: v.isoformat() if isinstance(v, (date, datetime)) else v for k, v in row.items()}
        hidden = self._hadoop.fs.Path(f"{self.path}/.{uuid.uuid4().hex}")
        out = self._fs.create(hidden, False)
        out.write(bytearray(json.dumps(plain), "utf-8"))
        out.close()
        rename = self._hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        target = self._fs.makeQualified(self._file(*[row[k] for k in self.keys]))
        self._hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf).rename(
            self._fs.makeQualified(hidden), target, options)

    def get(self, *key: object) -> dict | None:
        """One row as written, times as text; None when there is no such key."""
        path = self._file(*key)
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self) -> DataFrame:
        if not self._fs.exists(self._hadoop.fs.Path(self.path)):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).json(self.path)
