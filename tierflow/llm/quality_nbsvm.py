"""Text quality by a linear support vector machine on n-gram indicators scaled by naive Bayes.

Indicators are the words and word pairs of a text, and n-grams of token shapes (case, punctuation, length,
whether the token repeats the one before). As one odd shape says little and a text full of them much, a
shape n-gram has an indicator for each power of two that its share of the text reaches. Each indicator is
scaled by the log ratio of its smoothed counts in the two classes, and a hinge-loss model is fitted by dual
coordinate descent. Margins become probabilities by a logistic curve fitted on texts kept out of the fit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import remainder, texts
from tierflow.llm.labelled import calibration, drawn, fitted, sigmoid

#: Labelled documents learned from, at most; the share of them kept out for the calibration.
SAMPLE, CALIBRATION = 6_000, 0.25
SLOTS_BITS = 18
#: Counts added to each indicator; cost of a margin violation; passes at most, and when to stop.
SMOOTH, COST, PASSES, ENOUGH = 1.0, 0.1, 60, 1e-3
#: Shares of a text are told apart down to this power of one half.
SHARE_STEPS = 6
CACHE_TOKENS = 400_000
THRESHOLD = 0.7

_A, _B, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xBF58476D1CE4E5B9)
_SHIFT = np.uint64(64 - SLOTS_BITS)
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def shape(token: str) -> int:
    """A small number for a token's case, final and first punctuation, and length."""
    core = token.strip(_MARKS)
    tail = token[len(token.rstrip(_MARKS)):] if core else token
    if not core:
        case = 0
    elif core.islower():
        case = 1
    elif core.isupper() and len(core) > 1:
        case = 3
    elif core[:1].isupper() and (len(core) == 1 or core[1:].islower()):
        case = 2
    else:
        case = 4 if core.isalpha() else 5
    if not tail:
        end = 0
    elif len(tail) == 1:
        end = 1 if tail in ".,;:?!" else 2
    else:
        end = 3 if len(set(tail)) == 1 else 4
    return case + 6 * (end + 5 * (2 * min(len(core) // 4, 3) + (token[:1] in _MARKS)))


class Features:
    """Indicators of texts; remembers tokens."""

    def __init__(self):
        self.known: dict[str, tuple[int, int]] = {}

    def of(self, text: str) -> np.ndarray:
        """Distinct slots of the indicators of ``text``."""
        tokens = text.split()
        if not tokens:
            return np.empty(0, np.int64)
        distinct = set(tokens)
        if len(self.known) + len(distinct) > CACHE_TOKENS:
            self.known = {}
        known = self.known
        for t in [t for t in distinct if t not in known]:
            known[t] = (xxhash.xxh3_64_intdigest(t.strip(_MARKS).lower().encode("utf-8", "replace")), shape(t))
        pairs = np.array([known[t] for t in tokens], np.uint64)
        word, form = pairs[:, 0], pairs[:, 1]
        form = form * np.uint64(2)
        form[1:] += (word[1:] == word[:-1]).astype(np.uint64)
        parts = [word * _A, word[:-1] * _B + word[1:]]
        for n in (1, 2, 3):
            if len(form) >= n:
                gram = np.zeros(len(form) - n + 1, np.uint64)
                for k in range(n):
                    gram = gram * np.uint64(1024) + form[k:len(form) - n + 1 + k]
                kinds, counts = np.unique(gram, return_counts=True)
                deep = np.minimum(np.floor(-np.log2(counts / len(gram))).astype(np.int64), SHARE_STEPS)
                for step in range(SHARE_STEPS + 1):
                    parts.append((kinds[deep <= step] * np.uint64(64) + np.uint64(8 * n + step)) * _A + np.uint64(1))
        out = np.concatenate(parts)
        out ^= out >> np.uint64(31)
        return np.unique((out * _MIX) >> _SHIFT).astype(np.int64)


def ratios(data: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Log ratio of each indicator's smoothed share of counts, class 1 over class 0."""
    size = 1 << SLOTS_BITS
    one, zero = (np.full(size, SMOOTH) for _ in range(2))
    for at, y in zip(data, labels.tolist()):
        (one if y == 1 else zero)[at] += 1
    return np.log(one / one.sum()) - np.log(zero / zero.sum())


def descend(data: list[np.ndarray], scale: np.ndarray, labels: np.ndarray, cost: float = COST, passes: int = PASSES,
            enough: float = ENOUGH) -> np.ndarray:
    """Weights (the last is the bias) of the linear machine with hinge loss, by dual coordinate descent.

    Violations weigh more in the rarer class, in proportion.
    """
    sign = np.where(labels == 1, 1.0, -1.0)
    share = np.clip(np.array([(labels != 1).mean(), (labels == 1).mean()]), 1e-3, 1)
    top = np.where(labels == 1, cost * 0.5 / share[1], cost * 0.5 / share[0])
    w, bias, alpha = np.zeros(len(scale)), 0.0, np.zeros(len(data))
    values = [scale[at] / max(np.linalg.norm(scale[at]), 1e-9) for at in data]
    square = np.array([float(v @ v) + 1.0 for v in values])
    every = np.arange(len(data))
    active = every  # those that moved last time; all again once these are settled, and in the last pass
    for number in range(passes):
        worst, moved = 0.0, []
        active = every if number == passes - 1 else active
        for i in np.random.default_rng(number).permutation(active).tolist():
            at, v = data[i], values[i]
            slope = sign[i] * (w[at] @ v + bias) - 1
            bound = min(slope, 0) if alpha[i] <= 0 else max(slope, 0) if alpha[i] >= top[i] else slope
            if bound:
                worst = max(worst, abs(bound))
                moved.append(i)
                new = min(max(alpha[i] - slope / square[i], 0.0), top[i])
                move = (new - alpha[i]) * sign[i]
                alpha[i] = new
                w[at] += move * v
                bias += move
        settled = worst < enough
        if settled and len(active) == len(data):
            break
        active = every if settled else np.array(moved)
    return np.append(w, bias)


def margin(at: np.ndarray, scale: np.ndarray, w: np.ndarray) -> float:
    v = scale[at]
    return float(w[at] @ v) / max(float(np.linalg.norm(v)), 1e-9) + float(w[-1])


def fit(texts: list[bytes], labels: np.ndarray) -> dict[str, np.ndarray]:
    features = Features()
    data = [features.of(t.decode("utf-8", "replace")) for t in texts]
    labels = (labels > 0).astype(int)
    kept_out = np.random.default_rng(1).permutation(len(data)) < CALIBRATION * len(data)
    if len(set(labels[~kept_out])) < 2 or not kept_out.any():
        kept_out[:] = False
    train = np.nonzero(~kept_out)[0]
    scale = ratios([data[i] for i in train], labels[train])
    w = descend([data[i] for i in train], scale, labels[train])
    rest = np.nonzero(kept_out)[0] if kept_out.any() else train
    curve = calibration(np.array([margin(data[i], scale, w) for i in rest]), labels[rest])
    return {"scale": scale, "weights": w, "curve": curve}


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          folds: int = 4, held: int = 2, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
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
        features, model = Features(), sent.value
        for batch in batches:
            margins = []
            for first in range(0, batch.num_rows, 500):
                for text in batch.column(1).slice(first, 500).to_pylist():
                    margins.append(margin(features.of(text), model["scale"], model["weights"]) if model else 0.0)
            a, b = model["curve"] if model else (0.0, 0.0)
            p = sigmoid(a * np.array(margins, float) + b)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
