"""Hard negatives for anchors and their positives, by slots of scores.

An anchor's positives are its nearest rows of the same label. Each positive opens a window of scores for its
negatives, ``low * p <= 100 * n <= high * p``. The windows of an anchor overlap, so they are not searched one by one:
their upper limits cut the scores into disjoint slots, a row of another label falls into one slot, and for each slot
only the ``k`` best rows are kept. A window's best rows are then the best of its own slot and all below it: slots are
merged from the lowest up, ``k`` rows at a time, and the lower limit is applied to the ``k`` that remain. That is
exact, as what a lower limit takes away always stands behind what it leaves.

Anchors are a query set against all rows. Both are dealt into blocks: a cell holds a block of anchors and the best
rows found so far, and the rows of a column stream past it in batches. A cell emits at most ``k`` rows a slot and
anchor; these are cut to ``k`` again before and after they meet. Pairs are never emitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import staged

#: Positives of an anchor, and negatives of a positive.
POSITIVES, NEGATIVES = 5, 3
#: Percentages of the positive's score between which a negative's lies.
LOW, HIGH = 50, 95
#: Anchors held by a task, with what was found for them.
ANCHORS = 16_384
#: Rows that stream past a block of anchors in one task.
COLUMN_ROWS = 4_000_000
#: Scores computed at once, and the anchors among them.
AT_ONCE, TOGETHER = 2_000_000, 512
#: Scores beyond this count as this; a hundred times it still fits 64 bits.
LARGEST = 1 << 55
_NONE = np.iinfo(np.int64).max


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two arrays of whole numbers, at most ``LARGEST`` in size."""
    if not a.shape[1] or not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    top = [max(abs(int(x.max())), abs(int(x.min()))) for x in (a, b)]
    if top[0] * top[1] * a.shape[1] < 1 << 53:  # products and sums are exact in doubles
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, -LARGEST, LARGEST).astype(np.int64)


class Best:
    """The ``k`` best rows of each anchor and slot: higher scores first, then smaller ids, null ids last.

    Slot ``s`` of an anchor holds scores up to its limit ``s`` and above its limit ``s + 1``.
    """

    def __init__(self, limits: np.ndarray, k: int):
        self.limits = limits  # by anchor, falling; what is missing repeats the last
        self.k = k
        self.entries = [np.empty(0, np.int64) for _ in range(5)]  # anchor, slot, -score, id, row
        below = np.full((len(limits), 1), -_NONE, np.int64)
        self.least = np.concatenate([limits[:, 1:] + 1, below], axis=1)  # score from which a row may enter a slot

    def offer(self, score: np.ndarray, ok: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Scores of all anchors with the rows named by ``ids`` and ``rows``; only those that are ``ok`` count."""
        a, b = np.nonzero(ok & (score >= self.least.min(axis=1)[:, None]) & (score <= self.limits[:, :1]))
        value = score[a, b]
        slot = (value[:, None] <= self.limits[a]).sum(axis=1) - 1
        enters = value >= self.least[a, slot]
        if enters.any():
            a, b, value, slot = (x[enters] for x in (a, b, value, slot))
            self._keep([np.concatenate(x) for x in zip(self.entries, (a, slot, -value, ids[b], rows[b]))])

    def _keep(self, entries: list[np.ndarray]) -> None:
        order = np.lexsort(entries[::-1])
        anchor, slot = entries[0][order], entries[1][order]
        new = np.ones(len(order), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (slot[1:] != slot[:-1])
        start = np.nonzero(new)[0]
        place = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
        self.entries = [x[order][place < self.k] for x in entries]
        last = place == self.k - 1
        at = anchor[last], slot[last]
        self.least[at] = np.maximum(self.least[at], -entries[2][order][last])


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    if not size:
        return np.zeros((len(column), 0), np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.fill_null(_NONE).to_numpy(zero_copy_only=False).astype(np.int64)


def _search(size: int, k: int, same: bool):
    """Reads cells, each with its anchors before its rows; emits the best rows of every anchor and slot."""

    def emit(held, best) -> Iterator[pa.RecordBatch]:
        for number, part in enumerate(best):
            anchor, slot, score, ids, rows = part.entries
            yield pa.RecordBatch.from_arrays(
                [pa.array(held[0][anchor + number * TOGETHER]), pa.array(slot.astype(np.int32)), pa.array(-score),
                 pa.array(ids, mask=ids == _NONE), pa.array(rows)], names=["anchor", "slot", "score", "id", "row"])

    def compare(held, best, rows, ids, labels, vectors, seen):
        at = 0
        while at < len(rows):  # the first few rows set the limits below which later ones are not looked at
            step = min(max(64, seen + at), AT_ONCE // TOGETHER)
            part = slice(at, at + step)
            for number, its_best in enumerate(best):
                mine = slice(number * TOGETHER, (number + 1) * TOGETHER)
                equal = held[1][mine, None] == labels[None, part]
                ok = equal & (held[0][mine, None] != rows[None, part]) if same else ~equal
                its_best.offer(scores(held[2][mine], vectors[part]), ok, ids[part], rows[part])
            at += step
        return seen + at

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, parts, held, best, seen = None, [], None, None, 0
        for batch in batches:
            cells = batch.column(0).to_numpy()
            kind = batch.column(1).to_numpy()
            edges = [0, *(np.nonzero((cells[1:] != cells[:-1]) | (kind[1:] != kind[:-1]))[0] + 1).tolist(), len(cells)]
            for first, last in zip(edges, edges[1:]):
                if first == last:
                    continue
                part = batch.slice(first, last - first)
                if cells[first] != cell:
                    if best is not None:
                        yield from emit(held, best)
                    cell, parts, held, best, seen = cells[first], [], None, None, 0
                rows, ids, labels = (_numbers(part.column(i)) for i in (2, 3, 4))
                vectors = _matrix(part.column(5), size)
                if kind[first] == 0:
                    limits = part.column(6)
                    width = max(1, max(limits.value_lengths().to_pylist()))
                    padded = np.array([(x + [x[-1]] * width)[:width] for x in limits.to_pylist()], np.int64)
                    parts.append((rows, labels, vectors, padded))
                    continue
                if not parts and best is None:
                    continue  # a cell without anchors
                if best is None:
                    width = max(p[3].shape[1] for p in parts)
                    wide = [np.concatenate([p[3], np.repeat(p[3][:, -1:], width - p[3].shape[1], 1)], 1) for p in parts]
                    held = tuple(np.concatenate([p[i] for p in parts]) for i in range(3))
                    wide = np.concatenate(wide)
                    best = [Best(wide[at:at + TOGETHER], k) for at in range(0, len(wide), TOGETHER)]
                seen = compare(held, best, rows, ids, labels, vectors, seen)
        if best is not None:
            yield from emit(held, best)

    return run


def _best(anchors: DataFrame, rows: DataFrame, size: int, blocks: int, columns: int, k: int, same: bool, label: str) -> DataFrame:
    """``anchor, slot, score, id, row``: the ``k`` best rows for each slot of each of ``anchors``."""
    block = F.pmod(F.xxhash64("row"), F.lit(blocks))
    column = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(columns))
    wide = ["row", "id", "label", "v", "limits"]
    held = anchors.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(columns - 1)))).select(
        (block * columns + F.col("c")).cast("int").alias("cell"), F.lit(0).alias("kind"), *wide)
    passing = rows.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        (F.col("b") * columns + column).cast("int").alias("cell"), F.lit(1).alias("kind"), "row", "id", "label", "v",
        F.lit(None).cast("array<bigint>").alias("limits"))
    partial = held.union(passing).repartitionById(blocks * columns, "cell").sortWithinPartitions("cell", "kind").mapInArrow(
        _search(size, k, same), "anchor long, slot int, score long, id long, row long")
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    found = staged(partial, f"{label}-by-cell").withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    return staged(found, label)


#: The best rows of slot after slot from the lowest up, each with those of all slots below: ``(slot, rows)``.
_MERGED = """
aggregate(slots, cast(array() as {kind}), (done, s) -> concat(done, array(named_struct('slot', s.slot, 'rows',
    slice(array_sort(if(size(done) = 0, s.rows, concat(element_at(done, -1).rows, s.rows)), (x, y) -> case
        when x.score > y.score then -1 when x.score < y.score then 1
        when x.id is null and y.id is not null then 1 when y.id is null and x.id is not null then -1
        when x.id < y.id then -1 when x.id > y.id then 1
        when x.row < y.row then -1 when x.row > y.row then 1 else 0 end), 1, {k})))))
"""


def mine(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "vector", label_col: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         block_anchors: int = ANCHORS, column_rows: int = COLUMN_ROWS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vector_col`` holds whole numbers (arrays), ``label_col`` a whole number; ``anchor`` says which rows are anchors.
    A score is the inner product. For each anchor the best ``positives`` other rows of its label are taken, and for each
    of them the best ``negatives`` rows of other labels with ``low * positive_score <= 100 * negative_score <= high *
    positive_score`` (none for a negative positive score); higher scores first, ties by smaller id, null ids last.

    Rows with a null label, a null vector or a null component take no part; where ``anchor`` is null a row is none.
    Vectors of different sizes are not compared. Each row counts by itself: a repeated row is another row, with the
    anchor's own id. Scores beyond 2**55 count as that. An empty table gives an empty result.
    """
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{label_col}`").cast("long").alias("label"), F.col(f"`{vector_col}`").cast("array<bigint>").alias("v"),
        F.coalesce(anchor.cast("boolean"), F.lit(False)).alias("is_anchor"),
    ).where("label is not null and v is not null and forall(v, x -> x is not null)")
    rows = staged(rows, "vectors")
    sizes = rows.groupBy(F.size("v").alias("size")).agg(
        F.count("*").alias("n"), F.count_if("is_anchor").alias("anchors"),
        F.max(F.expr("aggregate(v, 0L, (m, x) -> greatest(m, x, -1 - x))")).alias("top"),
    ).where("anchors > 0 and n > 1").collect()  # a row for each size of vector
    found = None
    for r in sizes:
        part = _mined(rows.where(F.size("v") == r.size), r, positives, negatives, low, high, block_anchors, column_rows)
        found = part if found is None else found.union(part)
    if found is None:
        return rows.where("false").select(
            F.col("id").alias("anchor_id"), F.col("id").alias("positive_id"), F.lit(1).alias("rank"),
            F.col("id").alias("negative_id"), F.col("id").alias("positive_score"), F.col("id").alias("negative_score"))
    return found


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, label, vector`` of labelled embeddings: each component ``x`` as the whole number ``floor(256 * x)``.

    The vector is null where it, or a component, is null or not finite. Where the id is divisible by 7 the label is moved
    on by one, modulo 10, so that labels hold some noise; a null id moves nothing.
    """
    number, label, vector = (F.col(f"`{c}`") for c in (id_col, label_col, vector_col))
    return vectors.select(
        number.cast("long").alias("vec_id"),
        F.when(number % 7 == 0, (label + 1) % 10).otherwise(label).cast("long").alias("label"),
        vector.cast("array<double>").alias("x"),
    ).select("vec_id", "label", F.expr(
        "case when forall(x, c -> c is not null and not isnan(c) and abs(c) < double('infinity')) "
        "then transform(x, c -> floor(256 * c)) end").alias("vector"))


def _mined(rows: DataFrame, counts, positives: int, negatives: int, low: int, high: int, block_anchors: int,
           column_rows: int) -> DataFrame:
    """``mine`` for the rows of one size of vector."""
    if counts.top < 1 << 15:
        rows = rows.withColumn("v", F.col("v").cast("array<smallint>"))  # a quarter of the bytes to shuffle
    tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism
    blocks = -(-counts.anchors // block_anchors)
    columns = max(-(-counts.n // column_rows), min(-(-tasks // blocks), counts.n))
    anchors = rows.where("is_anchor")
    near = _best(anchors.withColumn("limits", F.array(F.lit(LARGEST))), rows, counts.size, blocks, columns, positives, True, "positives")
    # One window for each positive; the largest whole score that is allowed in it is its slot's upper limit.
    windows = near.where("score >= 0").groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(
        (-F.expr(f"score * {high}L div 100L")).alias("fall"), "place", "score", "id"))).alias("windows"))
    windows = windows.withColumn("limits", F.expr("transform(array_distinct(windows.fall), x -> -x)"))
    windows = staged(windows.withColumnRenamed("anchor", "row"), "windows")
    open_ = anchors.join(windows.select("row", "limits"), "row")
    best = _best(open_, rows, counts.size, blocks, columns, negatives, False, "slots")
    slots = best.groupBy("anchor", "slot").agg(F.collect_list(F.struct("score", "id", "row")).alias("rows"))
    slots = slots.groupBy(F.col("anchor").alias("row")).agg(F.sort_array(F.collect_list(F.struct("slot", "rows")), False).alias("slots"))
    kind = "array<struct<slot:int,rows:array<struct<score:bigint,id:bigint,row:bigint>>>>"
    merged = slots.select("row", F.expr(_MERGED.format(kind=kind, k=negatives)).alias("merged"))
    names = anchors.select("row", F.col("id").alias("anchor_id"))
    out = names.join(windows, "row").join(merged, "row").select("anchor_id", "limits", "merged", F.explode("windows").alias("w"))
    # The merged slots come lowest first; a window takes the highest one that is not above its own.
    own = "array_position(limits, -w.fall) - 1"
    chosen = out.select("anchor_id", "w", F.expr(f"try_element_at(filter(merged, m -> m.slot >= {own}), -1).rows").alias("rows"))
    fits = chosen.select("anchor_id", "w", F.expr(f"filter(rows, n -> {low}L * w.score <= 100L * n.score)").alias("rows"))
    return fits.select("anchor_id", "w", F.posexplode("rows").alias("at", "n")).select(
        "anchor_id", F.col("w.id").alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"),
        F.col("n.id").alias("negative_id"), F.col("w.score").alias("positive_score"), F.col("n.score").alias("negative_score"))
