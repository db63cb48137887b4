import random
import zlib

import numpy as np
import pytest

from tierflow.llm import labelled, quality_nbsvm as qn, toxicity_ftrl as tf


def texts(n, seed, marked):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randint(5, 80))]
        label = int(i % 4 == 0)
        out.append((marked(rng, words) if label else " ".join(words), label))
    return out


def rude(rng, words):
    words[rng.randrange(len(words))] = rng.choice(["Bad!", "awful", "nasty,"])
    return " ".join(words)


def messy(rng, words):
    return rng.choice([lambda: " ".join(w.upper() + "!!" for w in words), lambda: " ".join(w for w in words for _ in range(5)),
                       lambda: " | ".join(words)])()


def tables(spark, docs, rows, column):
    frame = docs([(i, t) for i, (t, _) in enumerate(rows)] + [(None, "awful"), (9001, None), (9002, ""), (9001, None)], 3)
    labels = [(i, y, 5) for i, (_, y) in enumerate(rows)] + [(None, 1, 5), (9002, None, 5), (7, rows[7][1], 5)]
    return frame, spark.createDataFrame(labels, f"doc_id long, {column} int, score int")


@pytest.mark.parametrize("module,marked,column,folds,held,cut", [(tf, rude, "toxic", 5, 0, 0.5), (qn, messy, "quality", 4, 2, 0.7)])
def test_held_out_accuracy_and_edges(spark, docs, module, marked, column, folds, held, cut):
    rows = texts(1200, 1, marked)
    frame, labels = tables(spark, docs, rows, column)
    got = module.score(frame, labels).collect()
    assert len(got) == len(rows) + 4
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % folds == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= cut)
    unseen = [r for r in got if r.held_out and r.doc_id < 1200]
    assert len(unseen) > 100 and sum(r.predicted == rows[r.doc_id][1] for r in unseen) > 0.97 * len(unseen)
    blank = {r.score for r in got if r.doc_id in (9001, 9002)}
    assert len(blank) == 1
    if module is tf:
        assert next(r for r in got if r.doc_id is None).predicted == 1


@pytest.mark.parametrize("module,column", [(tf, "toxic"), (qn, "quality")])
def test_without_labels_or_rows(spark, docs, module, column):
    labels = spark.createDataFrame([], f"doc_id long, {column} int")
    assert [r.score for r in module.score(docs([(1, "a b"), (2, None)]), labels).collect()] == [0.5, 0.5]
    assert module.score(docs([(1, "x")]).limit(0), labels).count() == 0


def test_sample_is_bounded_and_fixed(spark, docs):
    rows = texts(200, 2, rude)
    frame, labels = tables(spark, docs, rows, "toxic")
    from pyspark.sql import functions as F
    draw = lambda f: sorted(map(tuple, labelled.drawn(f, labels, "toxic", F.lit(True), 50).collect()))
    assert len(draw(frame)) == 50 and draw(frame) == draw(frame.repartition(7))


def test_ftrl_weights_follow_the_closed_form():
    model = tf.Ftrl(alpha=0.5, beta=1.0, l1=0.2, l2=0.3)
    at = np.array([3, 8])
    z, n, w = np.zeros(3), np.zeros(3), np.zeros(3)
    for label in (1, 1, 0, 1):
        p = 1 / (1 + np.exp(-w.sum()))
        assert model.learn(at, label) == pytest.approx(p)
        g = p - label
        z += g - (np.sqrt(n + g * g) - np.sqrt(n)) / 0.5 * w
        n += g * g
        l1 = np.array([0.2, 0.2, 0.0])
        w = np.where(abs(z) <= l1, 0, -(z - np.sign(z) * l1) / ((1 + np.sqrt(n)) / 0.5 + 0.3))
    assert model.weights(np.array([3, 8, len(model.z) - 1])) == pytest.approx(w)


def test_dual_descent_reaches_the_optimum():
    rng = np.random.default_rng(3)
    scale = np.zeros(1 << qn.SLOTS_BITS)
    scale[:12] = rng.standard_normal(12)
    data = [np.sort(rng.choice(12, rng.integers(2, 8), replace=False)) for _ in range(60)]
    labels = np.array([int(scale[d].sum() + rng.normal(0, 0.5) > 0) for d in data])
    w = qn.descend(data, scale, labels, cost=0.5, passes=5000, enough=1e-6)
    x = np.zeros((60, 13))
    for i, d in enumerate(data):
        x[i, d] = scale[d] / np.linalg.norm(scale[d])
        x[i, 12] = 1
    y = np.where(labels == 1, 1, -1)
    top = np.where(labels == 1, 0.25 / labels.mean(), 0.25 / (1 - labels.mean()))

    def loss(v):
        return 0.5 * v @ v + (top * np.maximum(0, 1 - y * (x @ v))).sum()
    own = np.append(w[:12], w[-1])
    best = loss(own)
    for _ in range(400):
        assert loss(own + rng.normal(0, 0.01, 13)) >= best - 1e-3


def test_log_count_ratios():
    data, labels = [np.array([1, 2]), np.array([2]), np.array([2, 3])], np.array([1, 1, 0])
    r, size = qn.ratios(data, labels), 1 << qn.SLOTS_BITS
    want = {1: (2, 1), 2: (3, 2), 3: (1, 2), 4: (1, 1)}
    for slot, (one, zero) in want.items():
        assert r[slot] == pytest.approx(np.log(one / (size + 3)) - np.log(zero / (size + 2)))
