import hashlib
import random

import numpy as np
import pytest

from tierflow.llm import prefix_free as pf


def plain(texts, length):
    """Every window of every text in one dictionary."""
    data = [(t or "").encode() for t in texts]
    met = {}
    for t in data:
        for i in range(len(t) - length + 1):
            met[t[i:i + length]] = met.get(t[i:i + length], 0) + 1
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if met[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n=40):
    rng = random.Random(seed)
    vocab = ["é", "ab", "über", "the", "of", "x" * 9, "\0", "1234"] + [f"w{i}" for i in range(60)]
    words = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    passages = [words(rng.randint(5, 60)) for _ in range(5)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(words(rng.randint(0, 30)) if rng.random() < 0.5 else rng.choice(passages))
        texts.append(" ".join(parts))
    base = words(80)
    for _ in range(8):
        w = base.split(" ")
        w[rng.randrange(len(w))] = "EDIT" + words(1)
        texts.append(" ".join(w))
    return texts + [texts[0], texts[1], None, "", "a" * 500, "ab" * 300, "ab" * 300 + "c", "a" * 99, base, base]


@pytest.mark.parametrize("seed,length,window,limit,block", [
    (1, 100, 32, 20000, 1 << 20), (2, 60, 20, 20000, 150), (3, 80, 64, 3, 1 << 20), (4, 40, 16, 1, 64),
])
def test_against_all_windows(docs, seed, length, window, limit, block):
    texts = corpus(seed)
    got = pf.remove_repeats(docs(enumerate(texts), 5), length=length, window=window, limit=limit, block=block)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()}
    want = plain(texts, length)
    assert [got[i] for i in range(len(texts))] == want


def test_triggers_depend_on_the_window_alone():
    rng = np.random.default_rng(2)
    inner = rng.integers(0, 4, 900).astype(np.uint8).tobytes()
    found = []
    for head, tail in ((b"", b""), (b"xyz" * 77, b"end" * 40)):
        lo, n, before, key, klass = (np.concatenate(x) for x in list(zip(*pf.text_runs([head + inner + tail])))[1:])
        at = {}
        for s, count, b in zip(lo.tolist(), n.tolist(), before.tolist()):
            at |= {s + o - len(head): b - o for o in range(count)}
        found.append(at)
    assert all(found[0][i] == found[1][i] for i in found[0])


def test_a_hot_key_in_many_contexts(docs):
    """A passage that most texts hold, each after and before other words, and parts of its contexts shared by two."""
    rng = random.Random(5)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(40))
    texts = []
    for i in range(120):
        head, tail = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randint(0, 12))) for _ in "ht")
        texts.append(f"{head} {passage} {tail}")
        if i % 9 == 0:
            texts.append(f"{head[len(head) // 2:]} {passage} {tail[:len(tail) // 2]}")
    for limit in (10, 2_000):
        got = pf.remove_repeats(docs(enumerate(texts), 6), length=150, window=48, limit=limit)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()}
        assert [got[i] for i in range(len(texts))] == plain(texts, 150)


def test_a_very_long_text(docs):
    rng = random.Random(6)
    long = " ".join(f"w{rng.randrange(10**7)}" for _ in range(150_000))
    part = long[500_000:500_900]
    got = pf.remove_repeats(docs([(1, long), (2, "x" + part + "y"), (3, long[:399])], 2)).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in got}
    assert got == {1: (len(long), 900, 1), 2: (902, 900, 1), 3: (399, 0, 0)}


def test_edge_rows(docs):
    rows = [(None, "q" * 450), (5, "r" * 399), (5, "r" * 399), (7, None), (8, "")]
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in pf.remove_repeats(docs(rows)).collect()), key=repr)
    assert got == [(5, 399, 0, 0), (5, 399, 0, 0), (7, 0, 0, 0), (8, 0, 0, 0), (None, 450, 450, 1)]
    assert pf.remove_repeats(docs([(1, "x")]).limit(0)).count() == 0


def test_a_text_of_many_copies_is_split(docs, spark, monkeypatch):
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4000", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4000", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in limits}
    rng, plans, written = random.Random(3), {}, pf.staged
    words = lambda k: " ".join(f"{rng.randrange(1 << 30):x}" for _ in range(k))
    passage, copied = words(20), words(80)
    texts = [f"{words(20)} {passage} {words(20)}" if i % 8 == 0 else copied for i in range(1600)]

    def recorded(df, label):
        out = written(df, label)
        if label == "texts-with-runs":
            df.collect()
            plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return out

    monkeypatch.setattr(pf, "staged", recorded)
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        removed = pf.remove_repeats(docs(enumerate(texts), 8), length=100, window=32).select("doc_id", "n_removed", "n_bytes")
        rows = removed.collect()
        assert "skew=true" in plans["texts-with-runs"]
        assert "skew=true" in removed._jdf.queryExecution().executedPlan().toString()
        want = plain(texts, 100)
        assert sorted((r.doc_id, r.n_bytes, r.n_removed) for r in rows) == [(i, w[0], w[1]) for i, w in enumerate(want)]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
