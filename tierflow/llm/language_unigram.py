"""Language identification by unigram piece models, summed over all segmentations.

The pieces are those of a public vocabulary; only their probabilities differ by language. The probability
of a word is the sum over all ways to cut it into pieces of any length, computed by the forward algorithm; a
text's is the product over its words. A long word, such as a text without spaces, is first cut where no piece of
several characters reaches across, which leaves the sum as it is. The piece probabilities are learned by expectation-maximisation with the
forward-backward algorithm on word counts of a bounded sample of documents for each language.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import appended, bytes_of, free_name, hash_share, remainder, staged

UNKNOWN = "und"
#: Documents learned from, for each language, on average over hash draws.
SAMPLE_DOCS = 3000
ROUNDS = 3
#: Words of more characters are cut where every segmentation has a cut; parts of more are summed in logarithms.
LONG_WORD, LONG_PART = 24, 32
#: Characters of words handled at once.
BLOCK_CHARS = 400_000
#: Words whose scores a worker remembers.
CACHE_WORDS = 300_000
#: Weight added to each piece in each language.
SMOOTHING = 0.05
VOCABULARY = "piece_bpe_32k.model"

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 97 <= b <= 122 else 32 for b in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MARK = "▁"


def words_of(text: bytes) -> list[bytes]:
    """Lower-case words: runs of ASCII letters and of non-ASCII characters; none if no character is a letter."""
    if text.isascii():
        return text.translate(_LETTERS).split()
    string = text.decode("utf-8", "replace")
    words = string.lower().encode().translate(_LETTERS).split()
    if all(w[0] > 127 for w in words) and not any(c.isalpha() for c in string):
        return []
    return words


class Pieces:
    """The vocabulary's lower-case pieces, found by the hash of their characters. The last id is for the rest."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = (i for i in range(model.get_piece_size())
               if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
        # Words hold one mark, at their start.
        found = sorted({p for p in map(model.id_to_piece, ids) if p == p.lower() and _MARK not in p[1:]})
        self.count = len(found) + 1
        self.longest = max(map(len, found))
        hashes = np.array([self._hash(np.array([ord(c) for c in p], np.uint64)) for p in found], np.uint64)
        self.slots = np.full(1 << 18, -1, np.int32)
        self.owners = np.zeros(1 << 18, np.uint64)
        self.reach = 1
        for number, h in enumerate(hashes.tolist()):
            slot, tries = h >> 46, 1
            while self.slots[slot & 0x3FFFF] >= 0:
                slot, tries = slot + 1, tries + 1
            self.slots[slot & 0x3FFFF], self.owners[slot & 0x3FFFF] = number, h
            self.reach = max(self.reach, tries)

    @staticmethod
    def _hash(codes: np.ndarray) -> int:
        h = np.zeros(1, np.uint64)
        for c in codes:
            h = (h + c + np.uint64(1)) * _BASE
            h ^= h >> np.uint64(31)
        return int(h[0])

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Piece ids, -1 where there is no such piece."""
        out = np.full(len(hashes), -1, np.int32)
        open_ = np.arange(len(hashes))
        slot = (hashes >> np.uint64(46)).astype(np.int64)
        for _ in range(self.reach):
            at = slot[open_] & 0x3FFFF
            got = self.slots[at]
            same = (self.owners[at] == hashes[open_]) & (got >= 0)
            out[open_[same]] = got[same]
            open_ = open_[~same & (got >= 0)]
            slot[open_] += 1
            if not len(open_):
                break
        return out

    def ids(self, words: list[str], length: int) -> list[np.ndarray]:
        """For words of one length: ``ids[k - 1][w, s]`` is the piece of ``k`` characters at ``s``, or -1."""
        codes = np.array([list(map(ord, w)) for w in words], np.uint64).reshape(len(words), length)
        h = np.zeros_like(codes)
        out = []
        for k in range(1, min(self.longest, length) + 1):
            h = h[:, :length - k + 1]
            h = (h + codes[:, k - 1:] + np.uint64(1)) * _BASE
            h ^= h >> np.uint64(31)
            found = self.lookup(h.ravel()).reshape(h.shape)
            if k == 1:
                found = np.where(found < 0, self.count - 1, found)
            out.append(found)
        return out


    def parts_of(self, word: bytes) -> list[str]:
        """``word`` with the mark of a word's start; a long one in parts between which no piece reaches across."""
        marked = _MARK + word.decode("utf-8", "replace")
        if len(marked) <= LONG_WORD:
            return [marked]
        reaching = np.zeros(len(marked) + 1, np.int64)
        for k, found in enumerate(self.ids([marked], len(marked))[1:], 2):
            at = np.nonzero(found[0] >= 0)[0]
            reaching += np.bincount(at + 1, minlength=len(reaching)) - np.bincount(at + k, minlength=len(reaching))
        cuts = [0, *(np.nonzero(np.cumsum(reaching)[1:-1] == 0)[0] + 1).tolist(), len(marked)]
        return [marked[i:j] for i, j in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _by_length(words: list[str]):
    lengths = np.array([len(w) for w in words])
    for n in np.unique(lengths).tolist():
        at = np.nonzero(lengths == n)[0]
        for block in np.array_split(at, -(-len(at) * n // BLOCK_CHARS)):
            yield n, block


def _summed(terms: list[np.ndarray], logs: bool) -> np.ndarray:
    """Sum of products of two factors each; factors and sum as logarithms with ``logs``."""
    if not logs:
        return sum(a * b for a, b in terms)
    return np.logaddexp.reduce([a + b for a, b in terms])


def log_scores(words: list[str], probs: np.ndarray, vocabulary: Pieces) -> np.ndarray:
    """Log probability of each word in each language; ``probs`` is (pieces, languages)."""
    out = np.empty((len(words), probs.shape[1]))
    table = np.vstack([probs, np.zeros(probs.shape[1])])  # id -1: no piece
    with np.errstate(divide="ignore"):
        log_table = np.log(table)
    for n, block in _by_length(words):
        ids = vocabulary.ids([words[i] for i in block], n)
        logs = n > LONG_PART
        p = log_table if logs else table
        alpha = [np.full((len(block), probs.shape[1]), 0.0 if logs else 1.0)]  # of the last positions, newest last
        for j in range(1, n + 1):
            alpha.append(_summed([(alpha[-k], p[ids[k - 1][:, j - k]]) for k in range(1, len(alpha) + 1)], logs))
            del alpha[:-vocabulary.longest]
        out[block] = alpha[-1] if logs else np.log(alpha[-1])
    return out


def expected_counts(words: list[str], langs: np.ndarray, weights: np.ndarray, probs: np.ndarray,
                    vocabulary: Pieces) -> np.ndarray:
    """Expected uses of each piece in each language, over all segmentations of the weighted words."""
    width = probs.shape[1]
    out = np.zeros(probs.size)
    table = np.vstack([probs, np.zeros(width)]).ravel()
    for n, block in _by_length(words):
        ids = vocabulary.ids([words[i] for i in block], n)
        lang = langs[block][:, None]
        logs = n > LONG_PART
        p = [table[np.where(i < 0, vocabulary.count, i) * width + lang] for i in ids]
        if logs:
            with np.errstate(divide="ignore"):
                p = [np.log(x) for x in p]
        top = len(ids)
        alpha = np.full((n + 1, len(block)), 0.0 if logs else 1.0)  # by position, first for the start
        beta = alpha.copy()  # by position, last for the end
        for j in range(1, n + 1):
            reach = range(1, min(top, j) + 1)
            alpha[j] = _summed([(alpha[j - k], p[k - 1][:, j - k]) for k in reach], logs)
            beta[n - j] = _summed([(beta[n - j + k], p[k - 1][:, n - j]) for k in reach], logs)
        for k in range(1, top + 1):
            left, right = alpha[:n - k + 1].T, beta[k:].T
            if logs:
                use = weights[block][:, None] * np.exp(left + p[k - 1] + right - alpha[n][:, None])
            else:
                use = (weights[block] / alpha[n])[:, None] * left * p[k - 1] * right
            some = ids[k - 1] >= 0
            at = (ids[k - 1].astype(np.int64) * width + lang)[some]
            out += np.bincount(at, use[some], len(out))
    return out.reshape(probs.shape)


class Model:
    """Languages, their piece probabilities, and the path of the vocabulary."""

    def __init__(self, langs: list[str], probs: np.ndarray, path: str):
        self.langs, self.probs, self.path = langs, probs, path


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_docs: int = SAMPLE_DOCS,
          rounds: int = ROUNDS, vocabulary: str | None = None) -> Model:
    """Piece probabilities for each non-null language of ``docs``.

    Learns from about ``sample_docs`` documents of each language, drawn by the hash of id and text, in full.
    The driver holds one number for each piece and language.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
                       F.col(f"`{id_col}`").alias("doc_id"))
    rows = rows.where("text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.ones((1, 0)), path)
    drawn = F.lit(False)
    for share, group in _shares(sizes, sample_docs):
        drawn = drawn | (F.col("lang").isin(group) & hash_share(F.xxhash64("doc_id", "text"), share, 7))

    def count(batches):
        for batch in batches:
            met: dict[str, Counter] = {}
            for text, lang in zip(bytes_of(batch.column(0)), batch.column(1).to_pylist()):
                met.setdefault(lang, Counter()).update(words_of(text))
            for lang, words in met.items():
                total = Counter()
                for word, n in words.items():
                    for part in pieces(path).parts_of(word):
                        total[part] += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array([langs.index(lang)] * len(total), pa.int32()), pa.array(list(total), pa.string()),
                     pa.array(list(total.values()), pa.int64())], names=["lang", "word", "n"])

    counted = rows.where(drawn).select("text", "lang").mapInArrow(count, "lang int, word string, n long")
    counted = staged(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    vocab = pieces(path)
    probs = np.full((vocab.count, len(langs)), 1.0 / vocab.count)
    for _ in range(rounds):
        uses = np.zeros_like(probs)
        for r in _expected(counted, probs, path).collect():
            uses[r.piece, r.lang] = r.uses
        probs = (uses + SMOOTHING) / (uses + SMOOTHING).sum(axis=0)
    return Model(langs, probs, path)


def _shares(sizes: dict[str, int], wanted: int) -> list[tuple[float, list[str]]]:
    groups: dict[float, list[str]] = {}
    for lang, n in sorted(sizes.items()):
        groups.setdefault(min(1.0, wanted / n), []).append(lang)
    return list(groups.items())


def _expected(counted: DataFrame, probs: np.ndarray, path: str) -> DataFrame:
    sent = counted.sparkSession.sparkContext.broadcast(probs)

    def run(batches):
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            got = expected_counts(batch.column(1).to_pylist(), batch.column(0).to_numpy(),
                                  batch.column(2).to_numpy().astype(float), sent.value, pieces(path))
            total = got if total is None else total + got
        if total is not None:
            piece, lang = np.nonzero(total)
            for at in np.array_split(np.arange(len(piece)), max(1, len(piece) // 50_000)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(piece[at].astype(np.int32)), pa.array(lang[at].astype(np.int32)),
                     pa.array(total[piece[at], lang[at]])], names=["piece", "lang", "uses"])

    found = counted.mapInArrow(run, "piece int, lang int, uses double")
    return found.groupBy("piece", "lang").agg(F.sum("uses").alias("uses"))


class Scorer:
    """Scores of words, remembered in one table for each worker."""

    def __init__(self, model: Model):
        self.model, self.vocabulary = model, pieces(model.path)
        self._forget()

    def _forget(self):
        self.place: dict[bytes, int] = {}
        self.table = np.empty((0, len(self.model.langs)))

    def _add(self, words: list[bytes]) -> None:
        parts = [self.vocabulary.parts_of(w) for w in words]
        flat = log_scores([p for ps in parts for p in ps], self.model.probs, self.vocabulary)
        starts = np.cumsum([0, *map(len, parts[:-1])])
        start = len(self.place)
        if start + len(words) > len(self.table):
            grown = np.empty((max(2 * len(self.table), start + len(words), 1024), flat.shape[1]))
            grown[:start] = self.table[:start]
            self.table = grown
        self.table[start:start + len(words)] = np.add.reduceat(flat, starts, axis=0)
        self.place.update(zip(words, range(start, start + len(words))))

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        """Language and its posterior probability among equally likely languages; ties go to the first by name."""
        split = [words_of(t) for t in texts]
        new = [w for w in set().union(*split) if w not in self.place]
        if len(self.place) + len(new) > CACHE_WORDS:
            self._forget()
            new = list(set().union(*split))
        if new and self.model.langs:
            self._add(new)
        langs, scores = [], []
        for words in split:
            if not words or not self.model.langs:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            total = self.table[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))].sum(axis=0)
            best = int(total.argmax())
            langs.append(self.model.langs[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return langs, scores


_SCORERS: dict[int, Scorer] = {}


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, str, str]:
    """``docs`` with its language and score, and the names of these two columns.

    A null text or one without a letter is ``und`` with score 0, as is every text if nothing was learned.
    Rows keep their columns and number; there is no shuffle; texts are read whole.
    """
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    key = id(sent)

    def columns(texts):
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = Scorer(sent.value)
        langs, scores = [], []
        for first in range(0, len(texts), 500):
            a, b = _SCORERS[key].predict(bytes_of(texts.slice(first, 500)))
            langs += a
            scores += b
        return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

    fields = [T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())]
    return appended(docs, fields, columns, [text_col]), lang, score


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             folds: int = 3, held: int = 1, **options) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row; learns from rows whose id is not in fold ``held``.

    Rows with a null id are learned from. An empty table gives an empty result.
    """
    fold = remainder(F.col(f"`{id_col}`"), folds)
    model = learn(docs.where(fold != held), text_col, lang_col, id_col, **options)
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                         (remainder(F.col(f"`{id_col}`"), folds) == held).alias("held_out"),
                         F.col(f"`{text_col}`").cast("string").alias("text"))
    found, lang, score = predict(source, model)
    return found.select("doc_id", "held_out", F.col(lang).alias("lang_pred"), F.col(score).alias("score"))


def recognised(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` for which a language is predicted, whatever its score."""
    fold = remainder(F.col(f"`{options.get('id_col', 'doc_id')}`"), 3)
    model = learn(docs.where(fold != 1), **options)
    found, lang, score = predict(docs, model, options.get("text_col", "text"))
    return found.where(F.col(lang) != UNKNOWN).drop(lang, score)
