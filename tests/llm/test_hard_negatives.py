import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tierflow.llm import hard_negatives as hn
from tierflow.llm import queries

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, anchors, positives=5, negatives=3, low=50, high=95):
    """Every anchor against every row, window by window."""
    rows = [r for r in rows if r[1] is not None and r[2] is not None and None not in r[2]]
    out = []
    for i, (doc, label, vector) in enumerate(rows):
        if doc not in anchors:
            continue
        scored = [(-sum(a * b for a, b in zip(vector, v)), (d is None, d or 0), j, d, own)
                  for j, (d, own, v) in enumerate(rows) if j != i and len(v) == len(vector)]
        scored.sort(key=lambda x: x[:3])
        for p in [s for s in scored if s[4] == label][:positives]:
            inside = [s for s in scored if s[4] != label and low * -p[0] <= 100 * -s[0] <= high * -p[0]]
            out += [(doc, p[3], rank, s[3], -p[0], -s[0]) for rank, s in enumerate(inside[:negatives], 1)]
    return sorted(out, key=repr)


def table(spark, rows, partitions=3):
    wide = [(*r, 1, 2) for r in rows]
    return spark.createDataFrame(wide, "vec_id long, label long, vector array<long>, row int, slot int").repartition(partitions)


def random_rows(seed, n, size=4, top=6):
    rng = random.Random(seed)
    rows = [(i, rng.randint(0, 3), [rng.randint(-2, top) for _ in range(size)]) for i in range(n)]
    rows += rows[:5]  # repeated rows
    rows += [(None, 1, [top] * size), (1000, None, [1] * size), (1001, 1, None), (1002, 1, [1, None, 1, 1]), (1003, 0, [3, 3]),
             (1004, 0, [2, 3]), (1005, 1, [2, 2]), (1006, 2, []), (1007, 2, [])]
    return rows


@pytest.mark.parametrize("blocks,columns", [(16_384, 4_000_000), (7, 40)])
def test_equals_a_plain_version(spark, rows, blocks, columns):
    data = random_rows(1, 150)
    got = hn.mine(table(spark, data), F.col("vec_id") % 10 == 3, block_anchors=blocks, column_rows=columns)
    assert got.columns == COLUMNS
    want = plain(data, {d for d, _, _ in data if d is not None and d % 10 == 3})
    assert rows(got) == want and len(want) > 50


def test_other_counts_and_limits(spark, rows):
    data = random_rows(2, 60, top=9)
    got = hn.mine(table(spark, data), F.col("vec_id") < 9, positives=2, negatives=6, low=10, high=100)
    assert rows(got) == plain(data, set(range(9)), 2, 6, 10, 100)


def test_slots_merge_to_windows():
    rng = np.random.default_rng(3)
    limits = np.sort(rng.integers(0, 40, (20, 4)), axis=1)[:, ::-1].copy()
    score = rng.integers(-10, 50, (20, 3000))
    ids, number = rng.integers(0, 500, 3000), np.arange(3000)
    best = hn.Best(limits, 3)
    for at in range(0, 3000, 700):
        part = slice(at, at + 700)
        best.offer(score[:, part], np.ones_like(score[:, part], bool), ids[part], number[part])
    for a in range(20):
        for limit in limits[a]:
            want = sorted((-s, i, r) for s, i, r in zip(score[a].tolist(), ids.tolist(), number.tolist()) if s <= limit)[:3]
            slot = (limits[a] >= limit).sum() - 1
            held = [tuple(e[2:]) for e in np.array(best.entries).T.tolist() if e[0] == a and limits[a][e[1]] <= limits[a][slot]]
            assert sorted(held)[:3] == want


def test_scores_are_exact_and_bounded():
    a = np.array([[2**40 + 1, -3], [2**62, 2**62]])
    assert hn.scores(a, a).tolist() == [[hn.LARGEST, hn.LARGEST], [hn.LARGEST, hn.LARGEST]]
    b = np.array([[2**30 + 1, 2**20 + 1]])
    assert hn.scores(b[:, :1], np.array([[2**24 + 1]])).tolist() == [[(2**30 + 1) * (2**24 + 1)]]


def test_huge_and_odd_components(spark, rows):
    data = [(0, 1, [2**62, 1]), (1, 1, [2**62, 5]), (2, 2, [2**54, 0]), (3, 2, [1, 0])]
    assert rows(hn.mine(table(spark, data), F.col("vec_id") == 0, low=0)) == []
    assert rows(hn.mine(table(spark, data), F.col("vec_id") == 0, low=0, high=100), "negative_id") == [(2,), (3,)]
    nan, inf = float("nan"), float("inf")
    vectors = spark.createDataFrame(
        [(7, 9, [0.5, -0.001]), (8, 9, [nan, 1.0]), (9, 9, [1.0, inf]), (10, 9, [1e300, 0.0]), (11, None, None), (None, 3, [0.25, None])],
        "vec_id long, label int, embedding array<double>")
    assert rows(hn.quantised(vectors)) == sorted(
        [(7, 0, [128, -1]), (8, 9, None), (9, 9, None), (10, 9, [2**63 - 1, 0]), (11, None, None), (None, 3, None)], key=repr)


def test_empty_tables_and_no_anchors(spark):
    data = random_rows(4, 10)
    for df, anchor in ((table(spark, data).limit(0), F.lit(True)), (table(spark, data), F.col("vec_id") < 0),
                       (table(spark, data[:1]), F.lit(True)), (table(spark, data), F.lit(None))):
        got = hn.mine(df, anchor)
        assert got.columns == COLUMNS and got.count() == 0


def test_query_equals_its_sql(spark, rows):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{FOLDER}/embeddings.parquet'")
    got = queries.QUERIES["op13_hard_negatives"](spark, FOLDER)
    assert rows(got, *COLUMNS) == sorted(con.execute(queries.ORACLES["op13_hard_negatives"]).fetchall(), key=repr)
