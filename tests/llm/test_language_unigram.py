import random

import numpy as np
import public_tokenizers
import pytest

from tierflow.llm import language_unigram as lu

VOCAB = lu.pieces(public_tokenizers.path("piece_bpe_32k.model"))
EN = "the house and of with there that was this from have not which their would been other about".split()
DE = "der und die nicht ist sich auch werden eine über straße schön haben zwischen können durch".split()


def plain_word(word, prob):
    """Every segmentation, one by one."""
    if not word:
        return 1.0
    return sum(prob(word[:k]) * plain_word(word[k:], prob) for k in range(1, len(word) + 1))


def by_text():
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return {m.id_to_piece(i) for i in range(m.get_piece_size())
            if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i))}


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(1)
    probs = rng.random((VOCAB.count, 2))
    probs /= probs.sum(axis=0)
    known = by_text()
    words = ["▁the", "▁straße", "▁a", "▁x\U0001F600y", "▁日本", "▁ünd"]

    def prob(lang):
        def of(piece):
            found = int(VOCAB.lookup(np.array([VOCAB._hash([np.uint64(ord(c)) for c in piece])], np.uint64))[0])
            assert (found >= 0) == (piece in known and piece == piece.lower())
            if found < 0:
                return probs[-1, lang] if len(piece) == 1 else 0.0
            return probs[found, lang]
        return of
    got = np.exp(lu.log_scores(words, probs, VOCAB))
    for w, g in zip(words, got):
        assert g == pytest.approx([plain_word(w, prob(0)), plain_word(w, prob(1))], rel=1e-9)


def log_forward(word, probs):
    """Log probability of a word of any length, position by position."""
    ids, total = VOCAB.ids([word], len(word)), [0.0]
    for j in range(1, len(word) + 1):
        parts = [total[j - k] + np.log(probs[ids[k - 1][0, j - k]]) for k in range(1, min(j, len(ids)) + 1) if ids[k - 1][0, j - k] >= 0]
        total.append(np.logaddexp.reduce(parts))
    return total[-1]


def test_long_pieces_and_whole_words():
    assert VOCAB.longest > 8 and VOCAB.lookup(np.array([VOCAB._hash(np.array([ord(c) for c in "▁different"], np.uint64))], np.uint64))[0] >= 0
    rng = np.random.default_rng(5)
    probs = rng.random((VOCAB.count, 1)) ** 8
    probs /= probs.sum(axis=0)
    compound = "differentformationtranslation" * 9
    for word in ("different", compound, "aa" * 400, "日本語中文한국어" * 60, "ünd日" * 30, "x\U0001F600" * 40):
        marked, parts = "▁" + word, VOCAB.parts_of(word.encode())
        assert "".join(parts) == marked
        whole = log_forward(marked, probs[:, 0])
        assert lu.log_scores([marked], probs, VOCAB)[0, 0] == pytest.approx(whole, rel=1e-9)
        assert lu.log_scores(parts, probs, VOCAB).sum() == pytest.approx(whole, rel=1e-9)
    assert len(VOCAB.parts_of(("日本語中文" * 60).encode())) > 50 and VOCAB.parts_of(b"short") == ["▁short"]


def test_expected_counts_of_long_words():
    probs = np.random.default_rng(6).random((VOCAB.count, 2)) ** 4
    word = "▁differentformationtranslationandsomemore"
    assert len(word) > lu.LONG_PART
    counts = lu.expected_counts([word, "▁then"], np.array([1, 0]), np.array([2.0, 3.0]), probs, VOCAB)
    lengths = np.zeros(VOCAB.count)
    for k, row in enumerate(VOCAB.ids([word], len(word)), 1):
        lengths[row[row >= 0]] = k
    assert (counts[:, 1] * lengths).sum() == pytest.approx(2.0 * len(word))
    # d log p / d log probs is the expected count
    eps, at = 1e-6, next(i for row in VOCAB.ids([word], len(word))[3:] for i in row[0].tolist() if i >= 0)
    moved = probs.copy()
    moved[at, 1] *= 1 + eps
    slope = (lu.log_scores([word], moved, VOCAB) - lu.log_scores([word], probs, VOCAB))[0, 1] / eps
    assert counts[at, 1] == pytest.approx(2 * slope, rel=1e-3)


def test_expected_counts_match_segmentations():
    probs = np.random.default_rng(2).random((VOCAB.count, 1))
    word = "▁then"
    counts = lu.expected_counts([word], np.array([0]), np.array([3.0]), probs, VOCAB)
    lengths = np.zeros(VOCAB.count)
    for k, row in enumerate(VOCAB.ids([word], len(word)), 1):
        lengths[row[row >= 0]] = k
    assert (counts[:, 0] * lengths).sum() == pytest.approx(3.0 * len(word))


def build(spark, n=120):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice((EN, DE)[i % 2]) for _ in range(rng.randint(3, 60))), ("en", "de")[i % 2], "en", i)
            for i in range(n)]
    odd = [(900, None, "en", "x", 1), (901, "", "en", "x", 1), (902, "12 -- 34 😀", "de", "x", 1), (None, "the and of", "en", "x", 1),
           (903, "the house", None, "x", 1), (903, "the house", None, "x", 1), (904, "ß" * 3000, "de", "x", 1)]
    return spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, lang_pred string, score int").repartition(3)


def test_held_out_texts_and_edges(spark):
    docs = build(spark)
    got = lu.identify(docs).collect()
    assert len(got) == 127
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert len(held) > 20 and all(r.lang_pred == truth[r.doc_id] for r in held)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    assert by_id[903].lang_pred == "en" and by_id[904].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in got)
    kept = lu.recognised(docs)
    assert kept.columns == docs.columns and kept.count() == 124


def test_nothing_to_learn_from(spark):
    docs = build(spark, 2)
    assert {r.lang_pred for r in lu.identify(docs.withColumn("lang", docs.lang_pred).where("false")).collect()} == set()
    alone = spark.createDataFrame([(1, "the", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in lu.identify(alone).collect()] == [("und", 0.0)]


def test_unsure_documents_stay(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(EN) for _ in range(3)), ("en", "de", "fr", "es")[i % 4]) for i in range(80)] + [(80, "12 --", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    assert any(0 < r.score < 0.5 for r in lu.identify(docs).collect())  # four languages with the same words
    assert sorted(r.doc_id for r in lu.recognised(docs).collect()) == list(range(80))
