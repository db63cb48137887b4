import numpy as np
import pytest

from tierflow.llm import embedding_tiles as et


def make(seed=1, groups=25, dims=12):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        base = rng.standard_normal(dims)
        label = int(rng.integers(0, 3))
        for _ in range(rng.integers(1, 9)):
            rows.append(((base + rng.normal(0, 0.12, dims)) * rng.uniform(0.5, 3), label))
    rows += [rows[0], rows[0], (rows[1][0], 2), (rows[1][0] * 0, 1), (rows[2][0], None)]
    walk = rng.standard_normal(dims)
    for _ in range(60):
        walk = walk + rng.normal(0, 0.1, dims) * np.linalg.norm(walk) / 4
        rows.append((walk, 7))
    data = [[float(np.float32(x)) for x in v] for v, _ in rows]
    data[5][2] = float("nan")
    data[6][0] = float("inf")
    data[7][1] = None
    data[8] = None
    data[9] = []
    data[10] = data[10][:5]
    return [(100 + i, v, label) for i, (v, (_, label)) in enumerate(zip(data, rows))]


def plain(rows, least=0.98):
    ok = [label is not None and bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, label in rows]
    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                x, y = np.array(rows[i][1]), np.array(rows[j][1])
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    links[i] += 1
                    links[j] += 1
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    return {rows[i][0]: (links[i], rows[find(i)][0], find(i) == i) for i in range(n)}


def test_double_vectors_keep_their_precision(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(40):  # cosines a hair above and below the threshold, closer to it than single precision tells
        x = rng.standard_normal(6)
        x /= np.linalg.norm(x)
        y = rng.standard_normal(6)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        c = 0.98 + (1e-11 if i % 2 else -1e-11)
        rows += [(2 * i, x.tolist(), i), (2 * i + 1, (c * x + np.sqrt(1 - c * c) * y).tolist(), i)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = {r.vec_id: r.n_links for r in et.near_duplicates(frame).collect()}
    assert got == {i: (i // 2) % 2 for i in range(80)}


@pytest.mark.parametrize("least", [1.0, 0.9, -1.0])
def test_other_thresholds(spark, least):
    rows = [(i, v, label) for i, (_, v, label) in enumerate(make(4, 12)) if v and label == 1 and None not in v and np.isfinite(v).all()]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(2)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in et.near_duplicates(frame, least=least, tile=4).collect()}
    want = plain(rows, least)
    assert {k: v[1:] for k, v in got.items()} == {k: v[1:] for k, v in want.items()} or least == 1.0
    if least < 1:
        assert got == want


@pytest.mark.parametrize("tile,seed", [(1024, 1), (16, 2), (5, 3)])
def test_against_all_pairs(spark, tile, seed):
    rows = make(seed)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in et.near_duplicates(frame, tile=tile).collect()}
    want = plain(rows)
    assert got == want
    assert max(n for n, _, _ in want.values()) > 3


def test_bound_drops_nothing():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((80, 20)) * np.linspace(2, 0.1, 20)
    x = np.concatenate([x, x + rng.normal(0, 0.1, x.shape)])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    turn = np.linalg.qr(rng.standard_normal((20, 20)))[0]
    for least in (0.5, 0.9, 0.98):
        i, j = et.linked(x, x, unit @ turn, unit @ turn, least)
        assert set(zip(i.tolist(), j.tolist())) == {(a, b) for a, b in zip(*np.nonzero(unit @ unit.T >= least))}


def test_edge_rows(spark):
    schema = "vec_id long, embedding array<float>, label string, kept string, links int"
    rows = [(None, [1.0, 0.0], "a", "x", 1), (5, [2.0, 0.0], "a", "x", 1), (5, [2.0, -0.0], "a", "x", 1), (None, None, "a", "x", 1),
            (9, [1.0, 0.0], None, "x", 1), (3, [0.0, 1.0], "a", "x", 1)]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in et.near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=repr)
    assert got == [(3, 0, 3, True), (5, 2, 5, True), (5, 2, 5, True), (9, 0, 9, True), (None, 0, None, None), (None, 2, 5, None)]
    assert et.near_duplicates(spark.createDataFrame([], schema)).count() == 0
