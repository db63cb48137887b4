"""Removal of long repeated byte strings by prefix-free parsing.

A trigger is the position whose rolling hash is the smallest among the ``WINDOW`` positions from a
window's start on; it depends on the window's bytes alone. Triggers cut a text into phrases. A window
of ``LENGTH`` bytes is the end of a phrase (up to its trigger) followed by the start of the parse from
that trigger, so windows are equal exactly if both parts are.

1. Windows that share a trigger form a run. A run has a key (hash of the bytes from its trigger that all
   its windows hold) and a class (hash of all its bytes). These stand for the numbers that phrases and the parse
   would get from a dictionary: equal keys are equal starts of the parse, with 64 bits each. A key met once has no
   repeated window; that ends the work for most of the corpus. A key with one class only, or a class met
   twice, is repeated whole: key and class together decide, with 128 bits.
2. What is left are runs whose key is shared by different classes: the borders of repeated passages.
   They are brought together by key and sorted there: once by the bytes from the trigger on (as the suffixes of
   the parse would be) and once by the bytes back from it (as the phrases of the dictionary, read backwards),
   each with the common prefixes of neighbours. For a window that starts ``d`` bytes before its trigger
   both orders fall into classes, of ``d`` and of ``LENGTH - d`` common bytes; windows in the same class of
   both are equal, byte by byte.

Counts are reduced before each shuffle, so a passage found in a third of all documents is one row for
each task and key. A key met more than ``CLASS_LIMIT`` times is not brought together: the windows of its border
runs are told by 128 bits of hash where they are read, and counted by that, which spreads over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import bytes_of, staged

LENGTH = 400
WINDOW = 128
GRAM = 8
CLASS_LIMIT = 2_000
#: Border runs sorted together, of one or several keys.
HELD_RUNS = 20_000
#: Bytes handled at once; longer texts go in overlapping pieces.
BLOCK = 1 << 20
#: Bits of the filter that spares texts without any repeated run a shuffle; its size is fixed.
FILTER_BITS = 1 << 24

_STEP = 0xD6E8FEB86659FD93
_BACK = pow(_STEP, -1, 1 << 64)
_LOW = np.uint64((1 << 28) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of the 8 bytes from each position on (zeros beyond the end)."""
    x = np.concatenate([data, np.zeros(GRAM - 1, np.uint8)]).astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | (x[step:] << np.uint64(8 * step))
    return _mixed(x)


class Hashes:
    """Hashes of any part of ``data`` from prefix sums, independent of where the part starts."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.grams = _grams(data)
        steps = np.full(n + 1, _STEP, np.uint64)
        steps[0] = 1
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(self.grams * np.cumprod(steps)[:n])])
        steps[1:] = _BACK
        self.back = np.cumprod(steps)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end - GRAM + 1] - self.sums[start]) * self.back[start])


def runs(data: np.ndarray, starts: np.ndarray, counts: np.ndarray, length: int = LENGTH, window: int = WINDOW):
    """Runs of the windows at ``starts[j] ... starts[j] + counts[j] - 1`` of each piece ``j``.

    Returns piece, first window, windows, bytes from there to the trigger, key and class.
    """
    hashes = Hashes(data)
    low = (hashes.grams & ~_LOW) | np.arange(len(data), dtype=np.uint64)
    reach = 1
    while reach < window:
        step = min(reach, window - reach)
        low = np.minimum(low[:-step], low[step:])
        reach += step
    at = np.repeat(starts, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    piece = np.repeat(np.arange(len(starts)), counts)
    trigger = (low[at] & _LOW).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (piece[1:] != piece[:-1])
    first = np.nonzero(new)[0]
    size = np.diff(np.append(first, len(at)))
    lo, trigger, piece = at[first], trigger[first], piece[first]
    before = trigger - lo
    key = hashes.of(trigger, trigger + length - window + 1)
    layout = (before.astype(np.uint64) << np.uint64(20)) | size.astype(np.uint64)
    return piece, lo, size, before, key, _mixed(hashes.of(lo, lo + size - 1 + length) ^ _mixed(layout))


def _pieces(texts: list[bytes], length: int, block: int):
    """Groups of (text number, first window, windows) of up to about ``block`` windows; every window once."""
    group, total = [], 0
    for number, text in enumerate(texts):
        windows = len(text) - length + 1
        for at in range(0, max(windows, 0), block):
            take = min(block, windows - at)
            group.append((number, at, take))
            total += take + length
            if total >= block:
                yield group
                group, total = [], 0
    if group:
        yield group


def text_runs(texts: list[bytes], length: int = LENGTH, window: int = WINDOW, block: int = BLOCK):
    """``runs`` over whole texts: text number, first window in the text, and the rest."""
    for group in _pieces(texts, length, block):
        parts = [texts[number][at:at + take + length - 1] for number, at, take in group]
        sizes = np.array([len(p) for p in parts])
        base = np.cumsum(sizes) - sizes
        number, offset, take = (np.array(x) for x in zip(*group))
        piece, lo, *rest = runs(np.frombuffer(b"".join(parts), np.uint8), base, take, length, window)
        yield number[piece], lo - base[piece] + offset[piece], *rest


def equal_windows(spans: list[bytes], before: np.ndarray, count: np.ndarray, whole: np.ndarray, length: int = LENGTH):
    """Which windows of border runs occur in another run, or in one marked ``whole``.

    ``spans[r]`` holds the bytes of the windows of run ``r``; its trigger is at ``before[r]``. Returns one
    array of flags for each run, window by window.
    """
    m, reach = len(spans), int(before.max()) + 1
    left = np.zeros((m, reach), np.uint8)
    right = np.zeros((m, length), np.uint8)
    for r, (span, b) in enumerate(zip(spans, before.tolist())):
        data = np.frombuffer(span, np.uint8)
        left[r, :b] = data[:b][::-1]
        tail = data[b:b + length]
        right[r, :len(tail)] = tail
    orders = []
    for side, width in ((left, reach), (right, length)):
        order = np.argsort(np.ascontiguousarray(side).view(f"V{width}").ravel().view(f"S{width}"), kind="stable")
        sorted_ = side[order]
        differs = sorted_[1:] != sorted_[:-1]
        common = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
        orders.append((order, common))
    flags = [np.zeros(n, bool) for n in count.tolist()]
    for d in range(reach):
        has = (before >= d) & (before - count < d)
        if has.sum() < 2:
            continue
        ids = []
        for (order, common), need in zip(orders, (d, length - d)):
            klass = np.empty(m, np.int64)
            klass[order] = np.concatenate([[0], np.cumsum(common < need)])
            ids.append(klass)
        rows = np.nonzero(has)[0]
        _, place, times = np.unique(ids[0][rows] * m + ids[1][rows], return_inverse=True, return_counts=True)
        for r in rows[times[place] >= 2].tolist():
            flags[r][int(before[r]) - d] = True
    return flags


def removed_mask(size: int, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which of ``size`` bytes lie in any of the ``(start, end)`` spans."""
    edges = np.zeros(size + 1, np.int64)
    for start, end in spans:
        edges[start] += 1
        edges[end] -= 1
    return np.cumsum(edges[:-1]) > 0


def _columns(*arrays, names):
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in arrays], names=names)


def _borders(length: int):
    """Border runs of texts with their bytes; a class already known to be repeated once for each task."""
    names = ["key", "klass", "whole", "tk", "size", "lo", "n", "before", "span"]

    def run(batches):
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            out = []
            tk, size = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for t, s, text, rows in zip(tk, size, bytes_of(batch.column(2)), batch.column(3).to_pylist()):
                for r in rows or []:
                    if r["key"] is None or r["hot"] or (r["key"], r["klass"]) in seen:
                        continue
                    if r["whole"]:
                        seen.add((r["key"], r["klass"]))
                    lo, n = r["lo"], r["n"]
                    out.append((r["key"], r["klass"], r["whole"], t, s, lo, n, r["before"], text[lo:lo + n - 1 + length]))
            if out:
                yield _columns(
                    *(pa.array(c, kind) for c, kind in zip(zip(*out), (
                        pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(),
                        pa.binary()))), names=names,
                )

    return run


def window_hashes(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the windows at ``at``: of their bytes, and of their bytes read backwards."""
    back = len(data) - at - length
    return Hashes(data).of(at, at + length), Hashes(data[::-1].copy()).of(back, back + length)


def _hot_windows(length: int, block: int):
    """Windows of the border runs of hot keys by hash; a class already known to be repeated once for each task."""
    names = ["hash", "check", "klass", "whole", "tk", "size", "start"]

    def windows(t, s, text, runs):
        low = runs[0]["lo"]
        at = np.concatenate([np.arange(r["lo"], r["lo"] + r["n"]) for r in runs])
        many = [r["n"] for r in runs]
        first, second = window_hashes(np.frombuffer(text, np.uint8)[low:int(at.max()) + length], at - low, length)
        return (first.view(np.int64), second.view(np.int64), np.repeat(np.array([r["klass"] for r in runs], np.int64), many),
                np.repeat([r["whole"] for r in runs], many), np.full(len(at), t, np.int64), np.full(len(at), s, np.int32), at.astype(np.int32))

    def run(batches):
        seen: set[tuple[int, int]] = set()
        out, held = [], 0
        for batch in batches:
            tk, size = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for t, s, text, rows in zip(tk, size, bytes_of(batch.column(2)), batch.column(3).to_pylist()):
                chosen: list[dict] = []
                for r in sorted((r for r in rows or [] if r["hot"]), key=lambda r: r["lo"]):
                    if (r["key"], r["klass"]) in seen:
                        continue
                    if r["whole"]:
                        seen.add((r["key"], r["klass"]))
                    if chosen and r["lo"] - chosen[0]["lo"] > block:
                        out.append(windows(t, s, text, chosen))
                        chosen = []
                    chosen.append(r)
                if chosen:
                    out.append(windows(t, s, text, chosen))
                    held += len(out[-1][0])
                if held > block:
                    yield _columns(*map(np.concatenate, zip(*out)), names=names)
                    out, held = [], 0
        if out:
            yield _columns(*map(np.concatenate, zip(*out)), names=names)

    return run


def _settle(length: int, limit: int):
    """Reads border runs sorted by key; emits repeated windows as spans. Holds whole keys of about ``limit`` runs together."""
    names = ["tk", "size", "start", "stop"]

    def spans_of(rows):
        uniq: dict = {}
        for r in rows:
            uniq.setdefault((r[0], r[1], r[2] or (r[3], r[5])), r)
        rows = list(uniq.values())
        flags = equal_windows(
            [r[8] for r in rows], np.array([r[7] for r in rows]), np.array([r[6] for r in rows]),
            np.array([r[2] for r in rows]), length,
        )
        out = []
        for r, hit in zip(rows, flags):
            if not r[2] and hit.any():
                edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
                for a, b in zip(np.nonzero(edge == 1)[0].tolist(), np.nonzero(edge == -1)[0].tolist()):
                    out.append((r[3], r[4], r[5] + a, r[5] + b - 1 + length))
        return out

    def packed(out):
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
        return _columns(*(pa.array(c, k) for c, k in zip(zip(*out), kinds)), names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group = [], []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if group and group[-1][0] != r[0]:
                    if len(group) > 1:
                        held += group
                    group = []
                    if len(held) >= limit:
                        if out := spans_of(held):
                            yield packed(out)
                        held = []
                group.append(r)
        if len(group) > 1:
            held += group
        if held and (out := spans_of(held)):
            yield packed(out)

    return run


def _bitmap(tk: DataFrame, bits: int) -> bytes:
    """Which of ``bits`` slots the text keys fall into. Its size does not depend on the data."""
    words = tk.select(F.pmod("tk", F.lit(bits)).alias("slot")).select(
        F.floor(F.col("slot") / 32).cast("int").alias("word"),
        F.expr("shiftleft(1L, cast(slot % 32 as int))").alias("bit"),
    ).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    table = np.zeros(bits // 32, np.uint32)
    for r in words.collect():  # at most bits / 32 rows
        table[r.word] = r.bits & 0xFFFFFFFF
    return table.tobytes()


def _beside_text(rows: DataFrame, found: DataFrame, label: str) -> DataFrame:
    """``rows`` with what was gathered for their text, which is written first: a join of two scans, so adaptive execution
    can split a text that a third of all rows hold."""
    return rows.join(staged(found, label), ["tk", "size"], "left")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   window: int = WINDOW, limit: int = CLASS_LIMIT, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (bytes), ``kept_sha256``.

    Removes each byte covered by a string of ``length`` bytes that starts anywhere else too, in the same or
    another text; windows overlap freely and are judged on the input. Null text counts as empty, texts
    shorter than ``length`` keep all their bytes, copies of a text lose the same bytes (all, if long
    enough), repeated rows and null ids are kept as rows, an empty table gives an empty result. ``kept``
    may end inside a character, as bytes are what is compared.
    """
    if not GRAM <= length - window + 1:
        raise ValueError("window must leave at least 8 bytes of length")
    source = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    ).select(
        "doc_id", "text", F.xxhash64("text").alias("tk"), F.octet_length("text").cast("int").alias("size"),
    )
    names = ["tk", "size", "lo", "n", "before", "key", "klass"]

    def parse(batches):
        for batch in batches:
            tk, size = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for number, lo, n, before, key, klass in text_runs(bytes_of(batch.column(2)), length, window, block):
                yield _columns(
                    tk[number], size[number], lo.astype(np.int32), n.astype(np.int32), before.astype(np.int32),
                    key.view(np.int64), klass.view(np.int64), names=names,
                )

    long_texts = source.where(F.col("size") >= length).select("tk", "size", "text")
    parsed = staged(long_texts.mapInArrow(
        parse, "tk long, size int, lo int, n int, before int, key long, klass long"), "parse")
    # Written first: a join of two scans has an exchange on both sides, so adaptive execution can split a
    # passage that a third of all texts hold.
    keys = staged(parsed.groupBy("key").agg(
        F.count("*").alias("met"), F.min("klass").alias("low"), F.max("klass").alias("high"),
    ).where("met >= 2").select("key", (F.col("low") != F.col("high")).alias("border"), (F.col("met") > limit).alias("hot")), "shared-keys")
    shared = staged(parsed.join(keys, "key"), "shared")
    border = shared.where("border")
    twice = staged(border.groupBy("key", "klass").agg(F.count("*").alias("met")).where("met >= 2").select(
        "key", "klass", F.lit(True).alias("whole")), "repeated-classes")
    inner = shared.where("not border").select(
        "tk", "size", F.struct("lo", "n", "before", F.lit(True).alias("whole"), F.lit(None).cast("long").alias("key"),
                               F.lit(None).cast("long").alias("klass"), F.lit(False).alias("hot")).alias("run"))
    outer = border.join(twice, ["key", "klass"], "left").select(
        "tk", "size", F.struct("lo", "n", "before", F.coalesce("whole", F.lit(False)).alias("whole"), "key", "klass", "hot")
        .alias("run"))
    by_text = inner.union(outer).groupBy("tk", "size").agg(F.collect_set("run").alias("runs"))

    slots = docs.sparkSession.sparkContext.broadcast(_bitmap(shared.select("tk").distinct(), FILTER_BITS))

    def hit(batches):
        table = np.frombuffer(slots.value, np.uint32)
        for batch in batches:
            slot = np.mod(batch.column(2).to_numpy(), FILTER_BITS)
            mask = (table[slot >> 5] >> (slot & 31).astype(np.uint32)) & 1
            yield batch.filter(pa.array(mask.astype(bool)))

    def miss(batches):
        table = np.frombuffer(slots.value, np.uint32)
        for batch in batches:
            slot = np.mod(batch.column(2).to_numpy(), FILTER_BITS)
            mask = (table[slot >> 5] >> (slot & 31).astype(np.uint32)) & 1
            rest = batch.filter(pa.array(~mask.astype(bool)))
            yield cut_rows(rest.column(0), bytes_of(rest.column(1)), [None] * rest.num_rows, [None] * rest.num_rows)

    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"

    def cut_rows(ids, texts, whole, fine):
        out = []
        for text, rows, spans in zip(texts, whole, fine):
            cuts = [(r["lo"], r["lo"] + r["n"] - 1 + length) for r in rows or [] if r["whole"]]
            cuts += [(s["start"], s["stop"]) for s in spans or []]
            if cuts:
                data = np.frombuffer(text, np.uint8)
                gone = removed_mask(len(data), cuts)
                kept = data[~gone].tobytes()
                n, k = int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
            else:
                kept, n, k = text, 0, 0
            out.append((len(text), n, k, kept, hashlib.sha256(kept).hexdigest()))
        cols = list(zip(*out)) if out else [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
        return _columns(ids, *(pa.array(c, k) for c, k in zip(cols, kinds)),
                        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    def cut(batches):
        for batch in batches:
            yield cut_rows(batch.column(0), bytes_of(batch.column(1)), batch.column(2).to_pylist(),
                           batch.column(3).to_pylist())

    with_runs = staged(
        _beside_text(source.mapInArrow(hit, source.schema), by_text, "runs-by-text"), "texts-with-runs",
    )
    bordered = with_runs.where("exists(runs, r -> r.key is not null)").select("tk", "size", "text", "runs")
    spans = staged(
        bordered.mapInArrow(
            _borders(length),
            "key long, klass long, whole boolean, tk long, size int, lo int, n int, before int, span binary")
        .repartition("key").sortWithinPartitions("key")
        .mapInArrow(_settle(length, max(limit, HELD_RUNS)), "tk long, size int, start int, stop int"),
        "settled",
    )
    late = staged(bordered.where("exists(runs, r -> r.hot)").mapInArrow(
        _hot_windows(length, block), "hash long, check long, klass long, whole boolean, tk long, size int, start int"), "hot-windows")
    again = staged(late.groupBy("hash", "check").agg(
        F.min("klass").alias("low"), F.max("klass").alias("high"), F.max("whole").alias("any"),
    ).where("low <> high or any").select("hash", "check"), "repeated-windows")
    more = late.where("not whole").join(again, ["hash", "check"]).select(
        "tk", "size", "start", (F.col("start") + length).cast("int").alias("stop"))
    spans = spans.union(more)
    fine = spans.groupBy("tk", "size").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    changed = _beside_text(with_runs, fine, "spans-by-text").select("doc_id", "text", "runs", "spans").mapInArrow(cut, result)
    return changed.union(source.mapInArrow(miss, result))
