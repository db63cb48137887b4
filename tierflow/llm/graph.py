"""Connected components as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node reachable, for every node of ``edges`` (longs ``a``, ``b``).

    Each round hooks a node and its root onto the smallest root among its neighbours and then
    shortens the path to the root; the rounds needed grow with the logarithm of the component.
    Minima are reduced before they are shuffled, and a node with many edges is only ever the key of
    a join with one row per node, which adaptive execution splits. Each round is written to the
    shared folder. Null ends and loops are ignored; an empty input gives an empty result.
    """
    pairs = edges.where("a <> b").select("a", "b")
    links = staged(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    state = links.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root"))
    state = staged(state, "roots")
    while True:
        near = (
            links.join(state.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        )
        both = state.join(near, "node")
        hooks = both.select("node", "near").union(both.select(F.col("root").alias("node"), "near"))
        hooked = state.join(hooks.groupBy("node").agg(F.min("near").alias("near")), "node", "left").select(
            "node", F.col("root").alias("before"), F.least("root", "near").alias("root"),
        )
        hooked = staged(hooked, "hooked")
        if hooked.where("root <> before").isEmpty():
            return hooked.select("node", "root")
        short = hooked.select(F.col("node").alias("root"), F.col("root").alias("top"))
        state = staged(hooked.join(short, "root").select("node", F.col("top").alias("root")), "roots")
