"""Toxicity by logistic regression on hashed n-grams, learned with FTRL-proximal.

Features are the words of a text, pairs of neighbours and pairs with one word between them, each by hash
and once for each text. FTRL-proximal keeps a rate for each coordinate; its L1 term holds all weights at
zero whose evidence is small, so the model is a short list of hashes that every task gets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import bytes_of, remainder, texts
from tierflow.llm.labelled import drawn, fitted, sigmoid

#: Labelled documents learned from, at most.
SAMPLE = 12_000
SLOTS_BITS = 20
ALPHA, BETA, L1, L2, EPOCHS = 5.0, 1.0, 5.0, 0.01, 5

_WORD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
_PAIR, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_MIX, _SHIFT = np.uint64(0xBF58476D1CE4E5B9), np.uint64(64 - SLOTS_BITS)


def slots(text: bytes) -> np.ndarray:
    """The slot of every word, pair and skip pair of ``text``, repeats included."""
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    words = text.translate(_WORD).split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    out = np.concatenate([h, h[:-1] * _PAIR + h[1:], h[:-2] * _SKIP + h[2:]])
    out ^= out >> np.uint64(31)
    return ((out * _MIX) >> _SHIFT).astype(np.int64)


class Ftrl:
    """FTRL-proximal logistic regression over ``1 << SLOTS_BITS`` coordinates and a bias without L1."""

    def __init__(self, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << SLOTS_BITS) + 1), np.zeros((1 << SLOTS_BITS) + 1)

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        l1 = np.where(np.asarray(at) == len(self.z) - 1, 0.0, self.l1)
        pull = np.sign(z) * l1 - z
        return np.where(np.abs(z) <= l1, 0.0, pull / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, label: int) -> float:
        """One step on a text with distinct coordinates ``at``; its probability before the step."""
        at = np.append(at, len(self.z) - 1)
        w = self.weights(at)
        p = float(sigmoid(np.clip(w.sum(), -35, 35)))
        g = p - label
        root = np.sqrt(self.n[at])
        self.z[at] += g - (np.sqrt(self.n[at] + g * g) - root) / self.alpha * w
        self.n[at] += g * g
        return p


def fit(texts: list[bytes], labels: np.ndarray) -> dict[str, np.ndarray]:
    """Slots with a weight, their weights, and the bias as the last pair."""
    model = Ftrl()
    data = [np.unique(slots(t)) for t in texts]
    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(data)).tolist():
            model.learn(data[i], int(labels[i] > 0))
    w = model.weights(np.arange(len(model.z)))
    w[-1] = model.weights(np.array([len(model.z) - 1]))[0]
    at = np.append(np.nonzero(w[:-1])[0], len(w) - 1)
    return {"slot": at.astype(np.int64), "weight": w[at]}


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          folds: int = 5, held: int = 0, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Learns from at most ``sample`` labelled ids outside fold ``held``; only texts and labels are used. A text
    without words, null or empty, scores by the bias alone. Without any labels every score is 0.5. Repeated
    rows and null ids are kept, texts are read whole, nothing is shuffled but labels; an empty table gives
    an empty result.
    """
    keep = remainder(F.col("doc_id"), folds) != held
    model = fitted(drawn(docs, labels, label_col, keep, sample, id_col, text_col), fit)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = texts(docs, id_col, text_col).withColumn("held_out", remainder(F.col("doc_id"), folds) == held)

    def run(batches):
        table = np.zeros((1 << SLOTS_BITS) + 1)
        if sent.value:
            table[sent.value["slot"]] = sent.value["weight"]
        some = table != 0
        for batch in batches:
            margins = []
            for first in range(0, batch.num_rows, 500):
                for text in bytes_of(batch.column(1).slice(first, 500)):
                    at = slots(text)
                    margins.append(table[np.unique(at[some[at]])].sum() + table[-1])
            p = sigmoid(np.clip(np.array(margins, float), -35, 35))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
