"""Search for benchmark items in documents, by SimHash windows of each item's size.

A document window has as many words as the item it is compared with. Windows and items get a SimHash of
their five-word shingles; blocks of the fingerprint are looked up in a table of the items' blocks with a
few bits flipped, so that every item within ``radius`` bits is found (with ``m`` blocks, some block differs
in at most ``radius // m`` bits). What is found is checked by the weighted Jaccard similarity of the
shingles themselves, counted with repeats.

A window that reaches similarity ``s`` shares at least ``s`` times the item's shingles with it, so only windows
with that many shingles of any item are fingerprinted; this drops no match and spares nearly all windows.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import bytes_of, free_name

SHINGLE = 5
SIMILARITY = 0.8
#: At similarity 0.8 fingerprints of 64 bits differ in about 10 bits, with a deviation of 3.
RADIUS = 20
BLOCKS = 7
#: Text bytes of the items that are sent to every task at once; more items take more passes.
BLOCK_BYTES = 4 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
_REGION = 4096

MATCH = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("start_word", T.LongType()),
    T.StructField("n_words", T.LongType()), T.StructField("similarity", T.DoubleType()),
    T.StructField("distance", T.IntegerType()),
]))


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case: runs of ASCII letters, digits and non-ASCII characters."""
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    return text.translate(_WORD_BYTES).split()


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` words."""
    n = len(words) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * _BASE + one[k:k + n]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def fingerprints(hashes: np.ndarray, length: int) -> np.ndarray:
    """SimHash of each run of ``length`` shingles."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, dtype=np.int32, out=sums[1:])
    ones = sums[length:] - sums[:-length]
    return np.packbits(2 * ones > length, axis=1, bitorder="little").view("<u8").ravel()


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two bags."""
    both = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return both / (sum(a.values()) + sum(b.values()) - both)


def _bag(words: list[bytes], size: int) -> Counter:
    return Counter(zip(*(words[k:] for k in range(size))))


class Items:
    """Benchmark items by size, with the block tables of their fingerprints."""

    def __init__(self, items: tuple, radius: int, threshold: float):
        self.radius, self.threshold = radius, threshold
        self.edges = np.linspace(0, 64, BLOCKS + 1).astype(int)
        by_size: dict[int, list] = {}
        hashes: dict[int, list] = {}
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            k = min(SHINGLE, len(words))
            own = shingle_hashes(words, k)
            by_size.setdefault(len(words), []).append((item, _bag(words, k), fingerprints(own, len(own))[0]))
            hashes.setdefault(k, []).append(own)
        self.known = {k: np.unique(np.concatenate(h)) for k, h in hashes.items()}
        self.filters = {}
        for k, h in self.known.items():
            self.filters[k] = np.zeros(1 << 20, bool)
            self.filters[k][h >> np.uint64(44)] = True
        self.sizes = {n: (rows, np.array([r[2] for r in rows], np.uint64), self._tables([r[2] for r in rows]))
                      for n, rows in sorted(by_size.items())}

    def _tables(self, prints: list[int]) -> list[np.ndarray]:
        """For each block and each of its values, which items have it with at most ``radius // BLOCKS`` flips."""
        tables = []
        for a, b in zip(self.edges, self.edges[1:]):
            values = np.array([(int(p) >> int(a)) & ((1 << int(b - a)) - 1) for p in prints])
            far = np.bitwise_count(np.arange(1 << (b - a))[:, None] ^ values[None, :])
            tables.append(far <= self.radius // BLOCKS)
        return tables

    def hits(self, words: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
        """The document's shingle hashes and which of them some item has."""
        own = shingle_hashes(words, size)
        maybe = np.nonzero(self.filters[size][own >> np.uint64(44)])[0]
        hit = np.zeros(len(own), bool)
        if len(maybe):
            known = self.known[size]
            at = np.minimum(np.searchsorted(known, own[maybe]), len(known) - 1)
            hit[maybe] = known[at] == own[maybe]
        return own, hit

    def find(self, text: bytes) -> list[dict]:
        """The best window for each item that some window matches."""
        words = words_of(text)
        best: dict = {}
        for size in self.known:
            own, hit = self.hits(words, size)
            if not hit.any():
                continue
            sums = np.concatenate([[0], np.cumsum(hit)])
            for n, (rows, prints, tables) in self.sizes.items():
                if min(SHINGLE, n) != size:
                    continue
                length = min(n, len(words)) - size + 1
                need = int(np.ceil(self.threshold * (n - size + 1) - 1e-9))
                if length < 1:
                    continue
                starts = np.nonzero(sums[length:] - sums[:-length] >= need)[0]
                while len(starts):
                    part = starts[starts < starts[0] + _REGION]
                    starts = starts[len(part):]
                    first = int(part[0])
                    window = fingerprints(own[first:int(part[-1]) + length], length)[part - first]
                    near = np.zeros((len(part), len(rows)), bool)
                    for a, b, table in zip(self.edges, self.edges[1:], tables):
                        block = (window >> np.uint64(a)) & np.uint64((1 << int(b - a)) - 1)
                        near |= table[block.astype(np.int64)]
                    w, i = np.nonzero(near)
                    far = np.bitwise_count(window[w] ^ prints[i])
                    close = far <= self.radius
                    for w1, i1, d in zip(w[close].tolist(), i[close].tolist(), far[close].tolist()):
                        item, bag, _ = rows[i1]
                        at = int(part[w1])
                        score = similarity(_bag(words[at:at + length + size - 1], size), bag)
                        if score >= self.threshold and (item not in best or score > best[item]["similarity"]):
                            best[item] = {"item_id": item, "start_word": at, "n_words": length + size - 1,
                                          "similarity": score, "distance": int(d)}
        return sorted(best.values(), key=lambda m: (m["start_word"], m["item_id"]))


@lru_cache(maxsize=4)
def _items(items: tuple, radius: int, threshold: float) -> Items:
    return Items(items, radius, threshold)


def flag(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
         item_text: str = "text", radius: int = RADIUS, threshold: float = SIMILARITY,
         block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, str]:
    """``docs`` with a column of matches, and that column's name.

    A match is an item and the document window most like it (the first among equals). Documents are read
    once for each block of items, whole and without a shuffle, so a passage in many documents costs each
    of them alike. A window has the item's number of words, or all of a shorter document's. Items of fewer
    than five words are one shingle; items and documents without words match nothing, nor do nulls. Rows
    of ``docs`` keep their columns and number, repeated and empty ones included; item ids may be null or
    repeat. Case and punctuation do not count.
    """
    items = benchmark.select(
        F.col(f"`{item_col}`").cast("long").alias("item"), F.col(f"`{item_text}`").cast("binary").alias("text"),
    ).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-total // block_bytes))
    name = free_name(docs, "matches")
    out = docs.withColumn(name, F.array().cast(MATCH))
    context = docs.sparkSession.sparkContext
    for number in range(passes):
        block = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == number)
        sent = context.broadcast(tuple((r.item, bytes(r.text)) for r in block.distinct().collect()))
        out = _searched(out, name, text_col, sent, radius, threshold)
    return out, name


def _searched(docs: DataFrame, name: str, text_col: str, sent, radius: int, threshold: float) -> DataFrame:
    at, text_at = docs.columns.index(name), docs.columns.index(text_col)
    kind = pa.list_(pa.struct([
        ("item_id", pa.int64()), ("start_word", pa.int64()), ("n_words", pa.int64()), ("similarity", pa.float64()),
        ("distance", pa.int32())]))
    names = docs.columns

    def run(batches):
        for batch in batches:
            items = _items(sent.value, radius, threshold)
            found = []
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                for before, text in zip(part.column(at).to_pylist(), bytes_of(part.column(text_at))):
                    found.append(before + items.find(text))
            columns = [pa.array(found, kind) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document and benchmark item found in it: ``doc_id``, the item, its window, similarity, bits."""
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found, name = flag(source, benchmark, **options)
    return found.select("doc_id", F.explode(name).alias("m")).select("doc_id", "m.*")


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their columns."""
    found, name = flag(docs, benchmark, **options)
    return found.where(F.size(name) == 0).drop(name)
