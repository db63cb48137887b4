"""Near-duplicate embeddings by tiled comparison in the order of principal components.

Vectors of one label are scaled to length 1, turned so that leading dimensions carry most of the variance,
sorted by the first of them and cut into tiles of bounded size. Two vectors whose first coordinates differ by
more than unit vectors at the threshold can are in no compared tiles. Within a pair of tiles products are
summed over leading dimensions first; by the Cauchy-Schwarz inequality the rest adds at most the product of
the two suffix norms, and a pair is dropped as soon as that cannot reach the threshold. What remains is
decided by the cosine of the vectors as given, in double precision.

Equal vectors are one row up to here, so a label that consists of copies costs one comparison. A pair of
tiles gives each vector's number of links and a chain of links that connects what it found connected, never
all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import staged
from tierflow.llm.graph import components

COSINE = 0.98
#: Vectors in a tile.
TILE = 1024
#: Dimensions summed before each test of the bound.
STEP = 8
#: Ranges of the first coordinate by which vectors are ordered.
BINS = 4096
#: Room for rounding in bounds; only the final cosine decides.
SLACK = 1e-9
#: Vectors on which the axes are fitted, on average over hash draws. Any axes give right results.
SAMPLE = 100_000


def axes(vectors: DataFrame, size: int) -> np.ndarray:
    """Principal axes of the unit vectors with ``size`` components, by falling variance (rows)."""
    def moments(batches):
        total = np.zeros((size, size))
        for batch in batches:
            x = _matrix(batch.column(0), size)
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            total += x.T @ x
        row, col = np.divmod(np.arange(size * size), size)
        yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(col), pa.array(total.ravel())], names=["i", "j", "v"])

    total = np.zeros((size, size))
    for r in vectors.mapInArrow(moments, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        total[r.i, r.j] = r.v  # size x size numbers
    return np.linalg.eigh(total)[1][:, ::-1].T


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, size)


def linked(a: np.ndarray, b: np.ndarray, turned_a: np.ndarray, turned_b: np.ndarray, least: float,
           step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs of rows whose cosine reaches ``least``."""
    dims = turned_a.shape[1]
    edge = least - SLACK
    rest_a = np.sqrt(np.cumsum((turned_a ** 2)[:, ::-1], axis=1)[:, ::-1])
    rest_b = np.sqrt(np.cumsum((turned_b ** 2)[:, ::-1], axis=1)[:, ::-1])
    product = turned_a[:, :step] @ turned_b[:, :step].T
    if dims > step:
        product_bound = product + rest_a[:, step, None] * rest_b[None, :, step]
    else:
        product_bound = product
    i, j = np.nonzero(product_bound >= edge)
    value = product[i, j]
    at = step
    while at < dims and len(i):
        end = min(at + step, dims)
        value = value + np.einsum("ij,ij->i", turned_a[i, at:end], turned_b[j, at:end])
        if end < dims:
            open_ = value + rest_a[i, end] * rest_b[j, end] >= edge
            i, j, value = i[open_], j[open_], value[open_]
        at = end
    out = np.zeros(len(i), bool)
    for part in np.array_split(np.arange(len(i)), max(1, len(i) // 100_000)):
        x, y = a[i[part]], b[j[part]]
        dot = np.einsum("ij,ij->i", x, y)
        out[part] = dot / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y)) >= least
    return i[out], j[out]


def chains(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """As many of the links ``(i, j)`` among ``n`` members as connect what they connect."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    keep = []
    for number, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            keep.append(number)
    return i[keep], j[keep]


def _compare(size: int, least: float, turn, kind: type):
    """Reads rows sorted by pair of tiles; emits ``(node, other, links)``.

    ``other`` null: a vector's number of links in that pair. Else: a link that a chain needs. Holds one
    pair of tiles and one batch.
    """
    def pair(rows):
        same, side, node, copies, plain = rows
        a = side == 0
        x = np.frombuffer(b"".join(plain), kind).astype(float).reshape(-1, size)
        turned = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ turn.value.T
        b = a if same[0] else ~a
        i, j = linked(x[a], x[b], turned[a], turned[b], least)
        if same[0]:
            i, j = i[i < j], j[i < j]
        if not len(i):
            return None
        i, j = np.nonzero(a)[0][i], np.nonzero(b)[0][j]
        links = np.bincount(i, copies[j], len(node)) + np.bincount(j, copies[i], len(node))
        some = np.nonzero(links)[0]
        p, q = chains(i, j, len(node))
        nodes = np.concatenate([node[some], node[p]])
        others = np.concatenate([np.zeros(len(some), np.int64), node[q]])
        return pa.RecordBatch.from_arrays([
            pa.array(nodes), pa.array(others, mask=np.arange(len(nodes)) < len(some)),
            pa.array(np.concatenate([links[some], np.zeros(len(p))]).astype(np.int64)),
        ], names=["node", "other", "links"])

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            cols.append(np.array(batch.column(5).to_pylist(), object))
            if held is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
            cuts = np.nonzero(cols[0][1:] != cols[0][:-1])[0] + 1
            edges = [0, *cuts.tolist()]
            for first, last in zip(edges, edges[1:]):
                if (out := pair([c[first:last] for c in cols[1:]])) is not None:
                    yield out
            held = [c[edges[-1]:] for c in cols]
        if held is not None and (out := pair(held[1:])) is not None:
            yield out

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    least: float = COSINE, tile: int = TILE, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links, component_id, kept``.

    Links rows of equal, non-null label whose vectors have a cosine of at least ``least``. Vectors that are null,
    empty, zero, or hold null or non-finite components link with nothing, nor do vectors of different sizes.
    ``n_links`` counts other rows, repeated rows and ids too. ``component_id`` is the smallest id reachable, the
    row's own included; a null id names no component, so a row with a null id and no links has a null one, and
    ``kept`` is then null. An empty table gives an empty result.
    """
    # Single-precision vectors stay as they are; any others are compared in double precision.
    given = vectors.schema[vector_col].dataType
    number = "float" if isinstance(given, T.ArrayType) and given.elementType == T.FloatType() else "double"
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").alias("label"),
        F.col(f"`{vector_col}`").cast(f"array<{number}>").alias("v"),
    )
    good = ("label is not null and v is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) "
            f"and abs(x) < {number}('infinity')) and exists(v, x -> x <> 0)")
    rows = rows.withColumn("good", F.coalesce(F.expr(good), F.lit(False)))
    # Adding zero turns -0.0 into 0.0: equal vectors are then equal as keys.
    keyed = staged(rows.withColumn("v", F.expr(f"transform(v, x -> x + cast(0 as {number}))")).withColumn(
        "row", F.monotonically_increasing_id()), "vectors")
    classes = staged(
        keyed.where("good").groupBy("label", "v").agg(F.min("row").alias("node"), F.min("vec_id").alias("least"), F.count("*").alias("copies")),
        "vector-classes",
    )
    found = None
    for size in [r[0] for r in classes.select(F.size("v").alias("n")).distinct().collect()]:
        part = _tile_links(classes.where(F.size("v") == size), size, least, tile, sample)
        found = part if found is None else found.union(part)
    if found is None:
        found = classes.select("node", F.col("node").alias("other"), F.col("copies").alias("links"))
    found = staged(found, "tile-links")
    counts = found.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    labelled = classes.join(counts, "node", "left").join(roots, "node", "left").select(
        "label", "v", "node", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("root", "node").alias("root"),
    )
    labelled = staged(labelled, "labelled")
    named = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    member = labelled.join(named, "root").select("label", "v", "n_links", "component_id")
    linked_rows = keyed.where("good").join(member, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = keyed.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked_rows.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _tile_links(classes: DataFrame, size: int, least: float, tile: int, sample: int) -> DataFrame:
    """Links and link counts among distinct vectors of one size."""
    kind = np.float32 if classes.schema["v"].dataType.elementType == T.FloatType() else np.float64
    total = classes.count()
    drawn = classes.where(F.pmod(F.xxhash64("node"), F.lit(max(1, total // sample))) == 0)
    turn = classes.sparkSession.sparkContext.broadcast(axes(drawn.select("v"), size))

    def flat(batches):
        for batch in batches:
            x = _matrix(batch.column(2), size)
            first = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ turn.value[0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(first),
                 pa.array([r.tobytes() for r in x.astype(kind)], pa.binary())],
                names=["label", "node", "copies", "first", "plain"])

    label = classes.schema["label"].dataType.simpleString()
    rows = staged(classes.select("label", "node", "v", "copies").mapInArrow(
        flat, f"label {label}, node long, copies long, first double, plain binary",
    ).withColumn("bin", F.floor((F.col("first") + 1) * (BINS / 2))), "flat-vectors")
    # Vectors are numbered by bin of their first coordinate (at most BINS rows a label) and, within a bin, by
    # hash; a tile is a run of numbers, so it is narrow where vectors are many.
    bins = rows.groupBy("label", "bin").agg(F.count("*").alias("n"))
    before = F.coalesce(F.expr(
        "sum(n) over (partition by label order by bin rows between unbounded preceding and 1 preceding)"), F.lit(0))
    bins = staged(bins.withColumn("before", before), "bins")
    number = F.col("before") + F.pmod(F.xxhash64("node"), F.col("n"))
    placed = staged(rows.join(bins, ["label", "bin"]).withColumn("tile", F.floor(number / tile)).drop("bin", "n", "before"), "placed")
    # Tiles are joined by the cells that their first coordinates touch; the lower tile of a pair also touches those
    # within reach above it. A pair is taken in the first cell that both touch.
    ranges = staged(placed.groupBy("label", "tile").agg(F.min("first").alias("low"), F.max("first").alias("high")), "tiles")
    reach = float(np.sqrt(max(0.0, 2 - 2 * least)) + SLACK)
    width = max(reach, 1 / 32)

    def touched(x: str, up: float) -> DataFrame:
        first = F.floor(F.col("low") / width)
        return ranges.select("label", *[F.col(c).alias(f"{c}_{x}") for c in ("tile", "low", "high")], first.alias(f"first_{x}"), F.explode(
            F.sequence(first, F.floor((F.col("high") + up) / width))).alias("cell"))

    near = touched("a", reach).join(touched("b", 0.0), ["label", "cell"]).where(
        f"cell = greatest(first_a, first_b) and low_b <= high_a + {reach!r}D and (low_a < low_b or low_a = low_b and tile_a <= tile_b)")
    near = near.select("label", F.least("tile_a", "tile_b").alias("tile_a"), F.greatest("tile_a", "tile_b").alias("tile_b"))
    near = staged(near.withColumn("pair", F.monotonically_increasing_id()), "tile-pairs")
    sides = near.select("pair", "label", F.col("tile_a").alias("tile"), F.lit(0).alias("side"), F.expr("tile_a = tile_b").alias("same"))
    sides = sides.union(near.where("tile_a < tile_b").select("pair", "label", "tile_b", F.lit(1), F.lit(False)))
    dealt = placed.join(staged(sides, "tile-sides"), ["label", "tile"]).select("pair", "same", "side", "node", "copies", "plain")
    return dealt.repartition("pair").sortWithinPartitions("pair").mapInArrow(
        _compare(size, least, turn, kind), "node long, other long, links long")
