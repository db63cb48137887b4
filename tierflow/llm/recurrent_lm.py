"""Log-likelihood of whole documents under a gated recurrent network, beside an add-one unigram baseline.

Tokens are lower-cased words and an end mark. The network predicts a word's class, and the word within
its class, from the state that the words before it left; the state runs through a whole document, window
by window. Words outside the network's vocabulary form one class. Within it a word's probability is its add-one
share of the class in the corpus, and all words that were never met are one further word of it. So the model tells
as many words apart as the baseline does, and starts from the baseline's probabilities.

Words are counted over all training documents; the most frequent words' counts are sent to every task, in a table of
fixed size, and the rest are joined by the hash of the word. Then texts are turned into token ids, once, for
training and for scoring. The network is trained by truncated backpropagation, written in numpy, on all training documents, each in one of the rounds: a round trains a copy on
each shard from the same weights and averages the copies. The number of shards grows with the tokens.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import bytes_of, hash_share, remainder, staged

#: Words the network knows, classes they are dealt into, input rows shared by the other words by ending.
NETWORK_WORDS, CLASSES, ENDINGS = 1024, 32, 64
EMBED, HIDDEN = 16, 16
#: Least number of shards; rounds of training, each on its part of the documents.
SHARDS, ROUNDS = 6, 2
#: Documents among which the network's words are looked for first.
NAMED_DOCS = 2400
STREAMS, WINDOW, RATE, CLIP = 4, 20, 0.01, 5.0
#: Tokens of a shard, on average, where there are more shards than the least; tokens of a stream where there are more than the least number.
SHARD_TOKENS, STREAM_TOKENS = 3_200_000, 6_400
#: Words whose counts every task gets; all others are joined.
FREQUENT_WORDS = 200_000
#: Words a worker remembers; tokens and window of one scoring block.
CACHE_WORDS, BLOCK_TOKENS, SCORE_WINDOW = 800_000, 1_500_000, 128
_LN10 = float(np.log(10.0))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def word_hash(word: bytes) -> int:
    """64-bit hash of a word as a signed number."""
    return (xxhash.xxh3_64_intdigest(word) ^ (1 << 63)) - (1 << 63)


class Vocabulary:
    """Network words in classes of like total frequency. Token ids: words, then endings of other words, then the end mark."""

    def __init__(self, counts: list[tuple[bytes, int]], classes: int = CLASSES, endings: int = ENDINGS):
        self.words = [w for w, _ in counts]
        self.counts = np.array([n for _, n in counts], float)
        self.ids = {w: i for i, w in enumerate(self.words)}
        self.endings = endings
        mass = np.array([n for _, n in counts], float) ** 0.5
        share = np.cumsum(mass) / mass.sum() if len(mass) else mass
        self.class_of = np.minimum((share * classes * (1 - 1e-9)).astype(np.int64), classes - 1)
        self.starts = np.searchsorted(self.class_of, np.arange(classes + 1))
        self.classes = classes
        # Two classes more: other words, and the end mark, which is alone in its class.
        self.rare_class, self.end_class = classes, classes + 1
        self.end = len(self.words) + endings
        self.size = self.end + 1
        self._target = np.concatenate([self.class_of, np.full(endings, self.rare_class), [self.end_class]])

    def id_of(self, word: bytes) -> int:
        found = self.ids.get(word)
        return len(self.words) + xxhash.xxh32_intdigest(word[-3:]) % self.endings if found is None else found

    def target_class(self, ids: np.ndarray) -> np.ndarray:
        return self._target[ids]


def fresh_weights(vocab: Vocabulary, others: float = 1.0, ends: float = 1.0, seed: int = 1, embed: int = EMBED,
                  hidden: int = HIDDEN) -> dict[str, np.ndarray]:
    """Small random weights, and biases by which words have their shares of the corpus: ``others`` tokens are words
    outside the vocabulary, ``ends`` are end marks."""
    rng = np.random.default_rng(seed)

    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    mass = np.append(np.bincount(vocab.class_of, vocab.counts, vocab.classes), [others, ends])
    return {
        "embed": normal(vocab.size, embed, scale=0.3), "input": normal(embed, 3 * hidden, scale=embed ** -0.5),
        "state": normal(hidden, 3 * hidden, scale=hidden ** -0.5), "bias": np.zeros(3 * hidden, np.float32),
        "class": normal(hidden, vocab.classes + 2, scale=0.1),
        "class_bias": np.log(np.maximum(mass, 0.5) / max(mass.sum(), 1.0)).astype(np.float32),
        "word": normal(len(vocab.words), hidden, scale=0.1),
        "word_bias": np.log(vocab.counts / np.maximum(mass[vocab.class_of], 1e-9)).astype(np.float32),
    }


def step(w: dict, gates_in: np.ndarray, h: np.ndarray):
    """One step of the gated unit: ``(new state, update and reset gates, candidate, state's part of it)``."""
    n = h.shape[1]
    inner = h @ w["state"]
    both = gates_in[:, :2 * n] + inner[:, :2 * n]
    both *= 0.5  # the logistic function by way of tanh
    np.tanh(both, out=both)
    both += 1
    both *= 0.5
    c = both[:, n:] * inner[:, 2 * n:]
    c += gates_in[:, 2 * n:]
    np.tanh(c, out=c)
    new = h - c
    new *= both[:, :n]
    new += c
    return new, both, c, inner[:, 2 * n:]


def _exp(logits: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """``exp`` of logits of states, which lie between -1 and 1, lowered by a row's largest where it could overflow."""
    if len(bias) and np.abs(weights).sum(axis=0).max() + np.abs(bias).max() > 60:
        logits -= logits.max(axis=1, keepdims=True)
    return np.exp(logits)


def outputs(w: dict, vocab: Vocabulary, h: np.ndarray, ids: np.ndarray, grads: dict | None = None):
    """Natural log probability of tokens ``ids`` after states ``h`` (words of the class of others not told apart).

    With ``grads``, adds the gradient of the negative sum to it and returns that of ``h`` too.
    """
    target = vocab.target_class(ids)
    order = np.argsort(target.astype(np.int16), kind="stable")
    target, ids, h = target[order], ids[order], h[order]
    edges = np.searchsorted(target, np.arange(vocab.classes + 1))
    every = np.arange(len(ids))
    logits = h @ w["class"]
    logits += w["class_bias"]
    exp = _exp(logits, w["class"], w["class_bias"])
    total = exp @ np.ones(exp.shape[1], exp.dtype)  # sums of short rows, by way of a product
    logs = logits[every, target] - np.log(total)
    if grads is not None:
        exp /= total[:, None]
        exp[every, target] -= 1
        grads["class"] += h.T @ exp
        grads["class_bias"] += np.ones(len(exp), exp.dtype) @ exp
        dh = exp @ w["class"].T
    for c in range(vocab.classes):
        lo, hi = edges[c], edges[c + 1]
        a, b = vocab.starts[c], vocab.starts[c + 1]
        if lo == hi or b - a < 2:
            continue
        part, place = h[lo:hi], ids[lo:hi] - a
        logits = part @ w["word"][a:b].T
        logits += w["word_bias"][a:b]
        exp = _exp(logits, w["word"][a:b].T, w["word_bias"][a:b])
        total = exp @ np.ones(b - a, exp.dtype)
        logs[lo:hi] += logits[every[:hi - lo], place] - np.log(total)
        if grads is not None:
            exp /= total[:, None]
            exp[every[:hi - lo], place] -= 1
            grads["word"][a:b] += exp.T @ part
            grads["word_bias"][a:b] += np.ones(hi - lo, exp.dtype) @ exp
            dh[lo:hi] += exp @ w["word"][a:b]
    out = np.empty_like(logs)
    out[order] = logs
    if grads is None:
        return out, None
    back = np.empty_like(dh)
    back[order] = dh
    return out, back


def window_gradient(w: dict, vocab: Vocabulary, ids: np.ndarray, h0: np.ndarray):
    """Loss and its gradient over a window of tokens ``ids`` (steps, streams) after states ``h0``; last state.

    The state is zero again after an end mark. Gradients stop at the start of the window.
    """
    steps, streams = ids.shape
    n = h0.shape[1]
    x = w["embed"][ids]
    gates = x @ w["input"] + w["bias"]
    alive = (ids != vocab.end)[:, :, None].astype(gates.dtype)
    before = np.empty((steps, streams, n), gates.dtype)
    both = np.empty((steps, streams, 2 * n), gates.dtype)
    c, inner_c = np.empty_like(before), np.empty_like(before)
    h = h0
    for t in range(steps):
        before[t] = h
        h, both[t], c[t], inner_c[t] = step(w, gates[t], h)
        h *= alive[t]
    grads = {k: np.zeros_like(v) for k, v in w.items()}
    logp, dh_out = outputs(w, vocab, before.reshape(-1, n), ids.ravel(), grads)
    dh_out = dh_out.reshape(steps, streams, n)
    z, r = both[:, :, :n], both[:, :, n:]
    # What a gradient of the state is multiplied by to be one of the gates: of all steps at once.
    to_z = (before - c) * z
    to_z *= 1 - z
    to_c = (1 - z) * (1 - c * c)
    to_r = inner_c * r
    to_r *= 1 - r
    to_z *= alive
    to_c *= alive
    stay = z * alive
    dh = np.zeros_like(h0)
    d_gates = np.empty_like(gates)
    d_inner = np.empty_like(gates)
    back = w["state"].T.copy()
    for t in range(steps - 1, -1, -1):
        d, e = d_gates[t], d_inner[t]
        np.multiply(dh, to_z[t], out=d[:, :n])
        np.multiply(dh, to_c[t], out=d[:, 2 * n:])
        np.multiply(d[:, 2 * n:], to_r[t], out=d[:, n:2 * n])
        e[:, :2 * n] = d[:, :2 * n]
        np.multiply(d[:, 2 * n:], r[t], out=e[:, 2 * n:])
        dh *= stay[t]
        dh += e @ back
        dh += dh_out[t]
    grads["state"] += before.reshape(-1, n).T @ d_inner.reshape(-1, 3 * n)
    flat = d_gates.reshape(-1, 3 * n)
    grads["bias"] += flat.sum(axis=0)
    grads["input"] += x.reshape(-1, x.shape[2]).T @ flat
    order = np.argsort(ids, axis=None, kind="stable")
    tokens = ids.ravel()[order]
    first = np.nonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))[0]
    grads["embed"][tokens[first]] += np.add.reduceat((flat @ w["input"].T)[order], first, axis=0)
    return -float(logp.sum()), grads, h


def train(w: dict, vocab: Vocabulary, docs: list[np.ndarray], streams: int = STREAMS, window: int = WINDOW,
          rate: float = RATE) -> dict:
    """One pass of Adam over the documents' ids, laid out in parallel streams."""
    w = {k: v.copy() for k, v in w.items()}
    tokens = np.concatenate(docs) if docs else np.empty(0, np.int64)
    steps = len(tokens) // streams
    if not steps:
        return w
    lanes = tokens[:steps * streams].reshape(streams, steps).T
    m = {k: np.zeros_like(v) for k, v in w.items()}
    s = {k: np.zeros_like(v) for k, v in w.items()}
    h = np.zeros((streams, w["state"].shape[0]), np.float32)
    for number, at in enumerate(range(0, steps, window), 1):
        ids = lanes[at:at + window]
        _, grads, h = window_gradient(w, vocab, ids, h)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values())) / ids.size
        scale = min(1.0, CLIP / max(norm, 1e-9)) / ids.size
        pace = rate * min(1.0, 4 * (1 - (at / steps)) + 0.05)
        for k, g in grads.items():
            g = g * scale
            m[k] += 0.1 * (g - m[k])
            s[k] += 0.01 * (g * g - s[k])
            w[k] -= (pace * (m[k] / (1 - 0.9 ** number)) / (np.sqrt(s[k] / (1 - 0.99 ** number)) + 1e-6)).astype(np.float32)
    return w


def document_logs(w: dict, vocab: Vocabulary, tokens: np.ndarray, lengths: np.ndarray, window: int = SCORE_WINDOW) -> np.ndarray:
    """Natural log probability of each whole document.

    ``tokens`` are the documents' ids one after the other. All run side by side, longest first; the states
    are carried from each window to the next.
    """
    order = np.argsort(-lengths, kind="stable")
    rank = np.empty(len(lengths), np.int64)
    rank[order] = np.arange(len(lengths))
    time = np.arange(len(tokens), dtype=np.int32) - np.repeat((np.cumsum(lengths) - lengths).astype(np.int32), lengths)
    active = np.bincount(time)  # documents that have a token at each step
    base = np.cumsum(active) - active
    lined = np.empty(len(tokens), np.int32)
    lined[base.astype(np.int32)[time] + np.repeat(rank.astype(np.int32), lengths)] = tokens
    del time
    gates_of = w["embed"] @ w["input"] + w["bias"]
    h = np.zeros((len(lengths), w["state"].shape[0]), np.float32)
    out = np.zeros(len(lengths))
    for first in range(0, len(active), window):
        last = min(first + window, len(active))
        lo, hi = base[first], base[last - 1] + active[last - 1]
        states = np.empty((hi - lo, h.shape[1]), np.float32)
        for t in range(first, last):
            n = active[t]
            states[base[t] - lo:base[t] - lo + n] = h[:n]
            h[:n] = step(w, gates_of[lined[base[t]:base[t] + n]], h[:n])[0]
        logs, _ = outputs(w, vocab, states, lined[lo:hi])
        who = np.concatenate([np.arange(active[t]) for t in range(first, last)])
        out += np.bincount(who, logs, len(lengths))
    return out[rank]


def _named(rows: DataFrame, wanted: set[int]) -> dict[int, bytes]:
    """The words of ``rows`` that have one of the ``wanted`` hashes."""
    if not wanted:
        return {}

    def run(batches):
        seen, found = set(), {}
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                new = set().union(*map(words_of, bytes_of(batch.column(0).slice(first, 500)))) - seen
                if len(seen) + len(new) > CACHE_WORDS:
                    seen.clear()
                seen |= new
                found.update((h, w) for w in new if (h := word_hash(w)) in wanted)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], names=["hash", "word"])

    got = rows.select("text").mapInArrow(run, "hash long, word binary").distinct()
    return {r["hash"]: bytes(r["word"]) for r in got.collect()}  # at most one row for each wanted hash


def _averaged(copies: DataFrame, shards: int) -> dict[str, np.ndarray]:
    """Mean of the shards' weights; summed in tasks first, so that the driver gets about the root of their number."""
    def add(batches):
        sums: dict[str, list] = {}
        for batch in batches:
            for name, data, n in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                held = sums.setdefault(name, [0.0, 0.0])
                held[0] += n
                held[1] = held[1] + n * np.frombuffer(data, np.float32).astype(float)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()), pa.array([v.tobytes() for _, v in sums.values()], pa.binary()),
                 pa.array([n for n, _ in sums.values()], pa.float64())], names=["name", "data", "weight"])

    pools = max(1, isqrt(shards))
    pooled = copies.repartition(pools, F.pmod("shard", F.lit(pools))).sortWithinPartitions("shard", "name")
    got: dict[str, list] = {}
    for r in pooled.mapInArrow(add, "name string, data binary, weight double").collect():
        got.setdefault(r["name"], []).append((r["weight"], np.frombuffer(r["data"])))
    for pairs in got.values():
        pairs.sort(key=lambda c: (c[0], c[1].tobytes()))  # the same sum whatever came first
    return {k: sum(v for _, v in pairs) / sum(n for n, _ in pairs) for k, pairs in got.items()}


def learn(coded: DataFrame, vocab: Vocabulary, weights: dict, shards: int, rounds: int = ROUNDS) -> dict:
    """Weights trained on the rows (``part``, ``shard``, ``doc_id``, ``ids``), a part in each round.

    Token ids stay in the tasks; the driver gets sums of weights.
    """
    context = coded.sparkSession.sparkContext
    for number in range(rounds):
        sent = context.broadcast((vocab, weights))

        def fit(batches):
            vocab, weights = sent.value
            kind = np.min_scalar_type(vocab.size)

            def fitted(shard, docs):
                size = sum(map(len, docs))
                trained = train(weights, vocab, docs, max(STREAMS, size // STREAM_TOKENS))
                return pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(trained), pa.int32()), pa.array(list(trained), pa.string()),
                     pa.array([v.tobytes() for v in trained.values()], pa.binary()),
                     pa.array([float(size)] * len(trained))], names=["shard", "name", "data", "weight"])

            docs, last = [], None
            for batch in batches:
                for shard, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if docs and shard != last:
                        yield fitted(last, docs)
                        docs = []
                    last = shard
                    docs.append(np.frombuffer(ids, kind).astype(np.int32))
            if docs:
                yield fitted(last, docs)

        dealt = coded.where(F.col("part") == number).repartitionById(shards, "shard").sortWithinPartitions("shard", "doc_id", "ids")
        copies = dealt.select("shard", "ids").mapInArrow(fit, "shard int, name string, data binary, weight double")
        for k, mean in _averaged(copies, shards).items():
            weights[k] = mean.reshape(weights[k].shape).astype(np.float32)
        sent.unpersist()
    return weights


class Places(dict):
    """Numbers of words in the order in which they are first looked up; ``new`` has those of late."""

    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Coder:
    """What a worker knows about words, remembered in arrays."""

    def __init__(self, vocab: Vocabulary, hashes: np.ndarray, counts: np.ndarray):
        self.vocab, self.hashes, self.counts = vocab, hashes, counts
        self.kind = np.min_scalar_type(vocab.size)
        self._forget()

    def _forget(self):
        self.place = Places()
        self.ids = np.empty(0, self.kind)
        self.hash = np.empty(0, np.int64)
        self.count = np.empty(0, np.int64)  # -1: not among the frequent words

    def learn_words(self, words: list[bytes]) -> None:
        ids = np.fromiter(map(self.vocab.id_of, words), np.int32, len(words))
        hashes = np.fromiter(map(word_hash, words), np.int64, len(words))
        counts = np.full(len(words), -1, np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            same = self.hashes[at] == hashes
            counts[same] = self.counts[at[same]]
        self.ids = np.concatenate([self.ids, ids.astype(self.kind)])
        self.hash = np.concatenate([self.hash, hashes])
        self.count = np.concatenate([self.count, counts])

    def places(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """Where each text's words are remembered."""
        if len(self.place) > CACHE_WORDS:
            self._forget()
        found = [np.fromiter(map(self.place.__getitem__, t), np.int32, len(t)) for t in texts]
        if self.place.new:
            self.learn_words(self.place.new)
            self.place.new = []
        return found

    def coded(self, places: list[np.ndarray]):
        """Per document: tokens, known words, sum of log10(count + 1), that of words the network does not know, how many
        these are, ids; and the words to join, which it does not know either."""
        n = len(places)
        sizes = np.array([len(p) for p in places], np.int64)
        place = np.concatenate(places) if n else np.empty(0, np.int32)
        who = np.repeat(np.arange(n, dtype=np.int32), sizes)
        count = self.count[place]
        near = count >= 0
        known = np.bincount(who[near], minlength=n)
        logs = np.log10(np.maximum(count, 0) + 1.0)
        other = self.ids[place] >= len(self.vocab.words)
        others = np.bincount(who[other], minlength=n)
        inner = np.bincount(who[other], logs[other], n)
        logs = np.bincount(who, logs, n)
        kinds = max(len(self.hash), 1)
        far, uses = np.unique(who[~near].astype(np.int64) * kinds + place[~near], return_counts=True)
        words = far % kinds
        ids = [np.append(self.ids[p], self.ids.dtype.type(self.vocab.end)).tobytes() for p in places]
        return sizes + 1, known, logs, inner, others, ids, far // kinds, self.hash[words], uses


_CODERS: dict[int, Coder] = {}
_CODED = ("doc_id long, held_out boolean, part int, shard int, n_tokens long, known long, logs double, inner double, "
          "others long, ids binary, far array<struct<hash:long,uses:int>>")


def _coded(sent, key: int):
    names = [field.split()[0] for field in _CODED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _CODERS:
            _CODERS.clear()
            _CODERS[key] = Coder(*sent.value)
        coder = _CODERS[key]
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lengths, known, logs, inner, others, ids, doc, hashes, uses = coder.coded(
                    coder.places([words_of(t) for t in bytes_of(part.column(4))]))
                edges = pa.array(np.searchsorted(doc, np.arange(part.num_rows + 1)).astype(np.int32))
                far = pa.StructArray.from_arrays(
                    [pa.array(hashes), pa.array(uses.astype(np.int32))], names=["hash", "uses"])
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:4], pa.array(lengths), pa.array(known.astype(np.int64)), pa.array(logs.astype(float)),
                    pa.array(inner.astype(float)), pa.array(others.astype(np.int64)), pa.array(ids, pa.binary()), pa.ListArray.from_arrays(edges, far)], names=names)

    return run


def _scored(sent):
    """Reads ``ids`` and other columns; emits the others and the log10 probability of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, weights = sent.value
        kind = np.min_scalar_type(vocab.size)
        for batch in batches:
            lengths = batch.column(1).to_numpy()
            block = (np.cumsum(lengths) - lengths) // BLOCK_TOKENS
            edges = [0, *(np.nonzero(block[1:] != block[:-1])[0] + 1).tolist(), len(lengths)]
            for first, last in zip(edges, edges[1:]):
                if first == last:
                    continue
                part = batch.slice(first, last - first)
                tokens = np.frombuffer(b"".join(part.column(0).to_pylist()), kind).astype(np.int32)
                logs = document_logs(weights, vocab, tokens, lengths[first:last]) / _LN10
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(logs)], names=[*batch.schema.names[1:], "network"])

    return run


def _most_frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the words above a count that at most ``most`` words reach, by falling count.

    The count comes from a histogram in steps of a sixteenth of a doubling, so no task sorts all words.
    """
    step = F.floor(F.log2("n") * 16).cast("int").alias("step")
    found = sorted(((r["step"], r["count"]) for r in counts.groupBy(step).count().collect()), reverse=True)
    least, total = None, 0
    for at, n in found:
        total += n
        if total > most:
            break
        least = at
    if least is None:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    top = counts.where(F.floor(F.log2("n") * 16).cast("int") >= least).toArrow()
    hashes, values = top.column("hash").to_numpy(), top.column("n").to_numpy()
    order = np.lexsort((hashes, -values))
    return hashes[order], values[order]


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2,
          frequent: int = FREQUENT_WORDS, network: int = NETWORK_WORDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Learns from rows whose id is not in fold ``held``; a null id is in no fold. A null or empty text is its
    end mark alone. Repeated rows are scored each; texts of any length are read whole. An empty table gives an
    empty result; if no row may be learned from, every count is 0 and the network stays untrained. Words are
    counted by a 64-bit hash.
    """
    fold = remainder(F.col(f"`{id_col}`"), folds)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), (fold == held).alias("held_out"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    training = rows.where("not held_out")

    def count(batches):
        for batch in batches:
            met = Counter()
            for first in range(0, batch.num_rows, 500):
                for text in bytes_of(batch.column(0).slice(first, 500)):
                    met.update(words_of(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.fromiter(map(word_hash, met), np.int64, len(met))), pa.array(list(met.values()), pa.int64())], names=["hash", "n"])

    counts = staged(training.select("text").mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")), "word-counts")
    docs_n = training.count()
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = (sums.n or 0) + docs_n, sums.v + (docs_n > 0)
    hashes, values = _most_frequent(counts, frequent)
    wanted = dict(zip(hashes[:network].tolist(), values[:network].tolist()))
    names = _named(training.where(hash_share(F.xxhash64("doc_id", "text"), min(1.0, NAMED_DOCS / max(docs_n, 1)), 8)), set(wanted))
    names |= _named(training, wanted.keys() - names.keys())
    vocab = Vocabulary(sorted(((names[h], n) for h, n in wanted.items()), key=lambda x: (-x[1], x[0])))
    # Tokens of the class of other words, one more for each of them, and one for words that were never met.
    others = int((sums.n or 0) - vocab.counts.sum()) + sums.v - len(vocab.words) + 1
    order = np.argsort(hashes)
    context = docs.sparkSession.sparkContext
    sent = context.broadcast((vocab, hashes[order], values[order]))
    shards = max(SHARDS, -(-tokens // (ROUNDS * SHARD_TOKENS)))

    def dealt(seed: int, n: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(n)).cast("int")

    coded = staged(rows.select("doc_id", "held_out", dealt(9, ROUNDS).alias("part"), dealt(3, shards).alias("shard"), "text").mapInArrow(
        _coded(sent, id(sent)), _CODED).withColumn("row", F.monotonically_increasing_id()), "coded")
    weights = learn(coded.where("not held_out").select("part", "shard", "doc_id", "ids"), vocab,
                    fresh_weights(vocab, others, docs_n), shards)
    model = context.broadcast((vocab, weights))
    scored = coded.select("ids", "n_tokens", "row", "doc_id", "held_out", "known", "logs", "inner", "others").mapInArrow(
        _scored(model), "n_tokens long, row long, doc_id long, held_out boolean, known long, logs double, inner double, others long, "
        "network double")
    far = coded.select("row", F.inline("far")).join(counts, "hash").groupBy("row").agg(
        F.sum("uses").alias("more"), F.sum(F.col("uses") * F.log10(F.col("n") + 1.0)).alias("more_logs"))
    end_known, end_log = int(docs_n > 0), float(np.log10(docs_n + 1.0))
    return scored.join(far, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0)) + end_known).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) + end_log
         - F.col("n_tokens") * float(np.log10(tokens + distinct + 1.0))).alias("base_score"),
        (F.col("network") + F.col("inner") + F.coalesce("more_logs", F.lit(0.0)) - F.col("others") * float(np.log10(others))).alias("score"),
    )
