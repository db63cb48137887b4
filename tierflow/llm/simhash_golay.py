"""SimHash near-duplicates found through Golay codewords.

A fingerprint is cut into segments of 23, 23 and 18 bits. The binary Golay code (23, 12) is perfect:
each 23-bit word lies within 3 bits of exactly one codeword, so decoding gives a 12-bit index. The
words within one bit of a segment decode to one to six indices; two segments at distance 2 share an
index of their midpoint, and at distance 1 each has the other's own index.

At most 4 differing bits leave two of the three segments with at most 2 together. For each pair of
segments (A, B) a fingerprint has the keys (own A, near B) and (near A, own B); the cases 0+2, 1+1 and
2+0 all share one. So every link meets in a key, is checked bit by bit there, and none is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import bytes_of, free_name, staged
from tierflow.llm.graph import components

# Generator polynomial x^11+x^9+x^7+x^6+x^5+x+1 of the Golay code; segments as
# (first bit, bits); the hash seed.
GENERATOR = 0b101011100011
SEGMENTS = ((0, 23), (23, 23), (46, 18))
SEED = 42

#: Runs of one key up to this many fingerprints are compared in one task; larger ones go to ``_midpoints``.
RUN_LIMIT = 4096
_SMALL = 8

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANES = (np.arange(8, dtype=np.int64) * 256)[None, :]


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """64-bit SimHash of the word shingles of ``text``, as an unsigned number; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[s:e], SEED) for s, e in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist())],
        dtype="<u8",
    )
    lanes = hashes.view(np.uint8).reshape(-1, 8) + _LANES
    ones = np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS
    bits = (2 * ones.ravel() > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _remainders(words: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word divided by the generator polynomial."""
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest ^= ((rest >> bit) & 1) * (GENERATOR << (bit - 11))
    return rest


def _error_table() -> np.ndarray:
    """The error pattern of at most 3 bits behind each of the 2048 remainders."""
    one = 1 << np.arange(23, dtype=np.int64)
    two = (one[:, None] | one[None, :]).ravel()
    three = (two[:, None] | one[None, :]).ravel()
    patterns = np.unique(np.concatenate([[0], one, two, three]))
    table = np.zeros(2048, dtype=np.int64)
    table[_remainders(patterns)] = patterns
    return table


_ERRORS = _error_table()


def decode(words: np.ndarray) -> np.ndarray:
    """12-bit index of the nearest codeword of each 23-bit word."""
    return (words ^ _ERRORS[_remainders(words)]) >> 11


def key_rows(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each fingerprint (unsigned): ``(index of the fingerprint, key)``, without repeats."""
    own, near = [], []
    for first, width in SEGMENTS:
        word = ((prints >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.int64)
        ball = word[:, None] ^ np.concatenate([[0], 1 << np.arange(width, dtype=np.int64)])[None, :]
        indices = decode(ball.ravel()).reshape(ball.shape)
        own.append(indices[:, :1])
        near.append(indices)
    rows, keys = [], []
    for number, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        cells = np.sort(np.concatenate([(own[a] << 12) | near[b], (near[a] << 12) | own[b]], axis=1), axis=1)
        fresh = np.ones(cells.shape, dtype=bool)
        fresh[:, 1:] = cells[:, 1:] != cells[:, :-1]
        rows.append(np.nonzero(fresh)[0])
        keys.append(cells[fresh] | (number << 24))
    return np.concatenate(rows), np.concatenate(keys)


def _chains(prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected among ``prints``: one fewer than the members of each component."""
    left = np.ones(len(prints), dtype=bool)
    heads, tails = [], []
    for start in range(len(prints)):
        if not left[start]:
            continue
        left[start] = False
        front = [start]
        while front:
            i = front.pop()
            open_ = np.nonzero(left)[0]
            hit = open_[np.bitwise_count(prints[open_] ^ prints[i]) <= bits]
            left[hit] = False
            front.extend(hit.tolist())
            heads.append(np.full(len(hit), prints[i]))
            tails.append(prints[hit])
    none = np.empty(0, dtype=prints.dtype)
    return np.concatenate([none, *heads]), np.concatenate([none, *tails])


def _links_in(keys: np.ndarray, prints: np.ndarray, bits: int, limit: int):
    """Checked links within runs of equal keys, and the members of runs beyond ``limit``."""
    starts = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0]
    sizes = np.diff(np.append(starts, len(keys)))
    heads, tails, late = [], [], []
    small = (sizes >= 2) & (sizes <= _SMALL)
    first, size = starts[small], sizes[small]
    at = np.repeat(first, size) + (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
    behind = np.repeat(first + size, size) - at
    lag = 1
    while len(at):
        keep = behind > lag
        at, behind = at[keep], behind[keep]
        near = np.bitwise_count(prints[at] ^ prints[at + lag]) <= bits
        heads.append(prints[at[near]])
        tails.append(prints[at[near] + lag])
        lag += 1
    for s, n in zip(starts[sizes > _SMALL].tolist(), sizes[sizes > _SMALL].tolist()):
        if n > limit:
            late.append(prints[s:s + n])
        else:
            a, b = _chains(prints[s:s + n], bits)
            heads.append(a)
            tails.append(b)
    none = np.empty(0, dtype=prints.dtype)
    return np.concatenate([none, *heads]), np.concatenate([none, *tails]), np.concatenate([none, *late])


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _scan_runs(bits: int, limit: int):
    """Reads rows sorted by key and emits links ``(a, b)``; members of overlong runs come as ``(a, null)``.

    Holds one batch and one run; a run that outgrows the limit is passed on as it is read.
    """
    def emit(a, b, late):
        ends = np.concatenate([b, late]).view(np.int64)
        null = np.concatenate([np.zeros(len(b), bool), np.ones(len(late), bool)])
        yield pa.RecordBatch.from_arrays([_signed(np.concatenate([a, late])), pa.array(ends, mask=null)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_p, over = np.empty(0, np.int64), np.empty(0, np.uint64), None
        for batch in batches:
            k = np.concatenate([held_k, batch.column(0).to_numpy().astype(np.int64)])
            p = np.concatenate([held_p, batch.column(1).to_numpy().view(np.uint64)])
            if over is not None and len(k):
                same = k == over
                if same.any():
                    yield from emit(p[:0], p[:0], p[same])
                    k, p = k[~same], p[~same]
                if len(k):
                    over = None
            if not len(k):
                held_k, held_p = k, p
                continue
            cut = int(np.searchsorted(k, k[-1]))
            if cut:
                yield from emit(*_links_in(k[:cut], p[:cut], bits, limit))
            held_k, held_p = k[cut:], p[cut:]
            if len(held_k) > limit:
                over = held_k[0]
                yield from emit(p[:0], p[:0], held_p)
                held_k, held_p = held_k[:0], held_p[:0]
        if len(held_k):
            yield from emit(*_links_in(held_k, held_p, bits, limit))

    return run


def _midpoints(prints: DataFrame, bits: int) -> DataFrame:
    """Links among fingerprints of overlong runs, without comparing them pairwise.

    Two fingerprints are within ``bits`` bits exactly if some word is within half of that, rounded down, of the one and
    within half, rounded up, of the other. Each gives all words that near (2081 for 4 bits). At a word the
    fingerprints nearer by the smaller half are within ``bits`` of all others, so the first of them is linked to
    each; where there is none, the others need not be near each other, and are not linked.
    """
    near, far = bits // 2, -(-bits // 2)

    def spread(batches):
        one = np.uint64(1) << np.arange(64, dtype=np.uint64)
        low, high = np.triu_indices(64, 1)
        masks = np.concatenate([np.zeros(1, np.uint64), one, one[low] | one[high]][:far + 1])
        outer = np.repeat(np.arange(3), [1, 64, 2016])[:len(masks)] > near
        for batch in batches:
            p = batch.column(0).to_numpy().view(np.uint64)
            for block in np.array_split(p, max(1, len(p) // 500)):
                yield pa.RecordBatch.from_arrays(
                    [_signed((block[:, None] ^ masks[None, :]).ravel()), pa.array(np.tile(outer, len(block))),
                     _signed(np.repeat(block, len(masks)))], names=["word", "outer", "a"],
                )

    def star(batches):
        word, middle, has = None, 0, False  # of the word that ended the batch before
        for batch in batches:
            w, outer, a = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(w):
                continue
            new = np.ones(len(w), bool)
            new[1:] = w[1:] != w[:-1]
            new[0] = word is None or w[0] != word
            group = np.cumsum(new)  # 0: goes on from the batch before
            first = np.nonzero(new)[0]
            middles = np.concatenate([[middle], a[first]])
            linked = np.concatenate([[has], ~outer[first]])[group] & ~new
            yield pa.RecordBatch.from_arrays([pa.array(a[linked]), pa.array(middles[group][linked])], names=["a", "b"])
            word, middle, has = w[-1], middles[group[-1]], bool(np.concatenate([[has], ~outer[first]])[group[-1]])

    words = prints.mapInArrow(spread, "word long, outer boolean, a long")
    return words.repartition("word").sortWithinPartitions("word", "outer").mapInArrow(star, "a long, b long")


def links(prints: DataFrame, bits: int = 4, limit: int = RUN_LIMIT) -> DataFrame:
    """Links ``(a, b)`` that connect all fingerprints (distinct longs ``fp``) within ``bits`` bits.

    ``bits`` may be at most 4. Within one key only as many links are emitted as are needed to connect
    its members once a key has more than a few of them; never all pairs.
    """
    if bits > 4:
        raise ValueError("the keys find links of up to 4 bits")

    def spread(batches):
        for batch in batches:
            p = batch.column(0).to_numpy().view(np.uint64)
            for block in np.array_split(p, max(1, len(p) // 5000)):
                row, key = key_rows(block)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.astype(np.int32)), _signed(block[row])], names=["key", "fp"],
                )

    keyed = prints.select("fp").mapInArrow(spread, "key int, fp long")
    found = staged(
        keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_scan_runs(bits, limit), "a long, b long"),
        "golay-links",
    )
    late = found.where("b is null").select("a").distinct()
    if not late.isEmpty():
        found = found.union(_midpoints(late, bits))
    return found.where("b is not null").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    bits: int = 4, limit: int = RUN_LIMIT, extra: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``extra`` columns, ``fp`` (signed long), ``component_id`` and ``component_root``.

    ``component_id`` is the smallest id reachable over fingerprints within ``bits`` bits, the row's own
    included; rows with a null id never name a component, and a component of only such rows has a null
    ``component_id``. A null or empty text has fingerprint 0, which is linked like any other. Repeated
    rows are all returned. An empty table gives an empty result. Words are runs without ASCII white
    space, lower-cased in A-Z; texts of any length are read whole. ``component_root`` is the
    smallest fingerprint of the component, and tells those without any id apart. Names in ``extra`` must not
    be among the others.
    """
    extra = extra or []
    source = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
        *[F.col(f"`{c}`") for c in extra],
    )
    kept = source.select("doc_id", *extra).schema
    names = [*[f.name for f in kept.fields], "fp"]

    def prints(batches):
        for batch in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in bytes_of(batch.column(1))), np.uint64, batch.num_rows)
            cols = [batch.column(i) for i in range(batch.num_columns) if i != 1]
            yield pa.RecordBatch.from_arrays([*cols, _signed(fps)], names=names)

    rows = staged(source.mapInArrow(prints, kept.add("fp", "long")), "fingerprints")
    classes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(links(classes, bits, limit))
    labelled = classes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"),
    )
    named = labelled.join(labelled.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    member = named.select("fp", "component_id", F.col("root").alias("component_root"))
    return rows.join(member, "fp").select("doc_id", *extra, "fp", "component_id", "component_root")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with its smallest id.

    Of several rows with that id one stays, and of a component without any id one row. Columns stay.
    """
    row = free_name(docs, "row")
    keyed = staged(docs.withColumn(row, F.monotonically_increasing_id()), "texts")
    found = near_duplicates(keyed, id_col, text_col, extra=[row], **options)
    # Rows whose id is their component's, or that have none, one for each component; fp tells components without ids apart.
    best = found.groupBy("component_root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("best"))
    return keyed.join(best.select(F.col(f"best.{row}").alias(row)), row, "left_semi").drop(row)
