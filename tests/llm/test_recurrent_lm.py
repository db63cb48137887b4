import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tierflow.llm import recurrent_lm as lm


def small():
    vocab = lm.Vocabulary([(b"a", 9), (b"b", 5), (b"c", 4), (b"d", 2), (b"e", 1)], classes=3, endings=4)
    return vocab, {k: v.astype(np.float64) for k, v in lm.fresh_weights(vocab, embed=3, hidden=4).items()}


def test_gradient_matches_differences():
    vocab, w = small()
    ids = np.random.default_rng(1).integers(0, vocab.size, (6, 3))
    ids[2, 1] = vocab.end
    h0 = np.random.default_rng(2).standard_normal((3, 4))
    _, grads, _ = lm.window_gradient(w, vocab, ids, h0)
    rng = np.random.default_rng(3)
    for name, value in w.items():
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in value.shape)
            keep, diff = value[at], []
            for move in (1e-5, -1e-5):
                value[at] = keep + move
                diff.append(lm.window_gradient(w, vocab, ids, h0)[0])
            value[at] = keep
            assert grads[name][at] == pytest.approx((diff[0] - diff[1]) / 2e-5, abs=1e-5), name


def test_next_token_probabilities_sum_to_one():
    vocab, w = small()
    h = np.random.default_rng(4).standard_normal((1, 4))
    ids = np.array([*range(len(vocab.words)), len(vocab.words), vocab.end])  # words, any other word, the end
    logs, _ = lm.outputs(w, vocab, np.repeat(h, len(ids), axis=0), ids)
    assert np.exp(logs).sum() == pytest.approx(1.0)


@pytest.mark.parametrize("window", [1, 3, 100])
def test_state_is_carried_through_documents(window):
    vocab, w = small()
    rng = random.Random(5)
    docs = [[rng.randrange(vocab.size - 1) for _ in range(rng.choice([0, 1, 5, 17]))] + [vocab.end] for _ in range(9)]
    got = lm.document_logs(w, vocab, np.concatenate(docs), np.array([len(d) for d in docs]), window)
    for doc, total in zip(docs, got):
        h, want = np.zeros((1, 4)), 0.0
        for token in doc:
            want += lm.outputs(w, vocab, h, np.array([token]))[0][0]
            h = lm.step(w, w["embed"][[token]] @ w["input"] + w["bias"], h)[0]
        assert total == pytest.approx(want, rel=1e-5)


def rows(n=90):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["The", "the", "of", "and", f"w{rng.randrange(40)}", "é"]) for _ in range(rng.randint(0, 60)))
             for _ in range(n)]
    texts += [None, "", " \t\n", "zq\x0bzq", texts[0], "A" * 5000]
    return list(enumerate(texts)) + [(0, texts[0]), (None, "the of")]


@pytest.mark.parametrize("frequent", [0, 6, 200_000])
def test_counts_and_baseline(docs, frequent):
    data = rows()
    got = lm.score(docs(data, 4), frequent=frequent, network=8).collect()
    assert len(got) == len(data)
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in data}
    tokens = {i: [*lm.words_of((t or "").encode()), "end"] for i, t in data}
    train = Counter(w for i, t in data if not held[i] for w in tokens[i])
    total, distinct = sum(train.values()), len(train)
    for r in got:
        mine = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(mine), total)
        assert r.n_known == sum(w in train for w in mine)
        want = sum(math.log10((train[w] + 1) / (total + distinct + 1)) for w in mine)
        assert r.base_score == pytest.approx(want, rel=1e-9)
        assert r.score < 0 and math.isfinite(r.score)


@pytest.fixture
def learned(monkeypatch):
    """Vocabulary and weights as ``score`` learned them."""
    learn, seen = lm.learn, []

    def noted(coded, vocab, weights, shards):
        weights = learn(coded, vocab, weights, shards)
        seen.append((vocab, weights, shards, coded))
        return weights

    monkeypatch.setattr(lm, "learn", noted)
    return seen


@pytest.mark.parametrize("frequent", [9, 200_000])
def test_scores_equal_a_plain_version(docs, learned, frequent):
    data = rows()
    got = lm.score(docs(data, 4), frequent=frequent, network=8).collect()
    vocab, w, _, _ = learned[0]
    train = Counter(x for i, t in data if i is None or zlib.crc32(str(i).encode()) % 7 != 2 for x in lm.words_of((t or "").encode()))
    assert sorted(vocab.words) == sorted(x for x, _ in sorted(train.items(), key=lambda x: (-x[1], lm.word_hash(x[0])))[:8])
    rare = {x: n for x, n in train.items() if x not in vocab.ids}
    total = sum(n + 1 for n in rare.values()) + 1
    texts = dict(data)
    for r in got:
        h, want = np.zeros((1, lm.HIDDEN)), 0.0
        for word in [*lm.words_of((texts[r.doc_id] or "").encode()), None]:
            token = vocab.end if word is None else vocab.id_of(word)
            want += lm.outputs(w, vocab, h, np.array([token]))[0][0] / math.log(10)
            if word is not None and word not in vocab.ids:
                want += math.log10((rare.get(word, 0) + 1) / total)
            h = lm.step(w, w["embed"][[token]] @ w["input"] + w["bias"], h)[0]
        assert r.score == pytest.approx(want, rel=1e-4)
    assert vocab.words and rare


def test_untrained_words_have_their_shares():
    vocab = lm.Vocabulary([(b"a", 40), (b"b", 30), (b"c", 10), (b"d", 5)], classes=2, endings=2)
    w = lm.fresh_weights(vocab, others=10, ends=5)
    logs, _ = lm.outputs(w, vocab, np.zeros((6, lm.HIDDEN), np.float32), np.array([0, 1, 2, 3, 4, vocab.end]))
    assert np.exp(logs) == pytest.approx([0.4, 0.3, 0.1, 0.05, 0.1, 0.05], rel=1e-5)


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_held_out_documents_score_above_the_baseline(spark, folder):
    table = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
    got = lm.score(table).where("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_training_beats_the_baseline_on_ordered_text(docs):
    rng = random.Random(7)
    texts = [" ".join(f"{rng.choice('xy')}{j % 5}" for j in range(200)) for _ in range(300)]
    got = lm.score(docs(enumerate(texts), 3)).where("held_out").collect()
    assert sum(r.score for r in got) > 0.7 * sum(r.base_score for r in got)


def test_every_training_document_is_learned_from(docs, learned, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(f"{rng.choice('xy')}{j % 5}" for j in range(200)) + f" rare{i}" for i in range(900)]
    monkeypatch.setattr(lm, "SHARD_TOKENS", 10_000)  # more shards than the least number
    got = lm.score(docs(enumerate(texts), 3), network=10).where("held_out").collect()
    assert sum(r.score for r in got) > 0.7 * sum(r.base_score for r in got)
    vocab, _, shards, coded = learned[0]
    assert shards > lm.SHARDS
    train = [i for i in range(900) if zlib.crc32(str(i).encode()) % 7 != 2]
    dealt = coded.select("doc_id", "part", "shard").collect()
    assert sorted(r.doc_id for r in dealt) == train and {r.part for r in dealt} == set(range(lm.ROUNDS))
    assert {r.shard for r in dealt} == set(range(shards))


def test_no_rows_and_nothing_to_learn(docs):
    assert lm.score(docs([(1, "x")]).limit(0)).count() == 0
    held = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = lm.score(docs([(held, "a b")])).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0) and r.score < 0
