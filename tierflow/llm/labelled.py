"""Bounded samples of labelled documents, and tasks that fit a model on one."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import bytes_of


def drawn(docs: DataFrame, labels: DataFrame, label: str, keep: Column, bound: int, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``text``, ``label`` of at most ``bound`` labelled ids among those that ``keep`` admits.

    The ids are the first by hash, so the sample does not depend on partitions; only they and their labels
    are broadcast. Several labels of one id count as the highest; a null label is none.
    """
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
    known = known.where("doc_id is not null and label is not null").where(keep).groupBy("doc_id").agg(F.max("label").alias("label"))
    first = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return rows.join(F.broadcast(first), "doc_id").select("text", "label")


def fitted(sample: DataFrame, fit: Callable[[list[bytes], np.ndarray], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """The named arrays that ``fit`` makes of the sample's texts and labels, in one task.

    The rows are sorted first, so the result does not depend on how they arrive. Empty without rows.
    """
    def run(batches):
        texts, labels = [], []
        for batch in batches:
            texts += bytes_of(batch.column(0))
            labels += batch.column(1).to_pylist()
        if texts:
            found = {k: np.ascontiguousarray(v) for k, v in fit(texts, np.array(labels)).items()}
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array([v.dtype.str for v in found.values()], pa.string()),
                 pa.array([v.tobytes() for v in found.values()], pa.binary())], names=["name", "kind", "data"])

    one = sample.repartition(1).sortWithinPartitions(F.xxhash64("text"), "text", "label")
    return {r["name"]: np.frombuffer(r["data"], r["kind"]) for r in one.mapInArrow(run, "name string, kind string, data binary").collect()}


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, float)))


def calibration(margins: np.ndarray, labels: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Slope and offset that turn margins into probabilities (Platt's method, damped Newton steps)."""
    positive = labels.sum()
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (len(labels) - positive + 2))
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    w = np.zeros(2)

    def loss(w):
        z = x @ w
        return float(np.sum(np.logaddexp(0, z) - target * z)) + 1e-6 * float(w @ w)

    for _ in range(rounds):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target) + 2e-6 * w)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
    return w
