"""Connected components of an edge table by label hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.operators.skew import join_per_key

from .common import discard, scratch_path, stored

MAX_ROUNDS = 100
#: A node or label of more rows than this (or than a ten-thousandth of all, if more) is spread over several tasks.
HOT_ROWS = 100_000


def components(edges: DataFrame, left: str = "a", right: str = "b", hot_rows: int = HOT_ROWS) -> DataFrame:
    """``node, label`` for every node of ``edges``: the smallest node it can reach.

    Each round every node takes the smallest label among its neighbours, hooks
    its old root to it, and jumps to its label's label, so that the number of
    rounds grows with the logarithm of a component's diameter.  All minima are
    aggregations with partial sums on the map side.  The joins are equi-joins
    with one unique side; a node with very many links and a label that very
    many nodes have reached (the rule, once a large component is nearly done)
    are salted by their counts.
    """
    spark = edges.sparkSession
    e = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u <> v")
    both = stored(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    path = scratch_path(spark, "labels")
    first = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("degree"))
    labels = stored(first.select(F.col("u").alias("node"), F.least("u", "m").alias("label"), "degree"), "labels", path)
    for _ in range(MAX_ROUNDS):
        near = join_per_key(both, labels.withColumnRenamed("node", "u"), "u", rows_per_key="degree", hot_rows=hot_rows, salt_by=["v"], how="inner")
        near = near.groupBy("v").agg(F.min("label").alias("m"))
        cand = near.join(labels.select(F.col("node").alias("n"), "label"), F.col("v") == F.col("n")).select("v", "label", "m")
        hooks = cand.select(F.col("v").alias("node"), F.least("label", "m").alias("label")).unionByName(
            cand.filter("m < label").select(F.col("label").alias("node"), F.col("m").alias("label")))
        low_path, up_path, nxt_path = (scratch_path(spark, x) for x in ("hooks", "jumps", "labels"))
        low = stored(hooks.groupBy("node").agg(F.min("label").alias("label")), "hooks", low_path)
        # Every label in use with its own label and the number of nodes that have it.
        used = low.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
        up = stored(used.join(low.select(F.col("node").alias("label"), F.col("label").alias("pl")), "label"), "jumps", up_path)
        jumped = join_per_key(low, up, "label", rows_per_key="n", hot_rows=hot_rows, salt_by=["node"], how="inner")
        jumped = jumped.select("node", F.least("label", "pl").alias("label"))
        old = labels.select(F.col("node").alias("o"), F.col("label").alias("ol"), "degree")
        nxt = stored(jumped.join(old, jumped["node"] == old["o"]).select(
            "node", "label", "degree", (F.col("label") != F.col("ol")).alias("moved")), "labels", nxt_path)
        for done in (path, low_path, up_path):
            discard(spark, done)
        path = nxt_path
        labels = nxt.select("node", "label", "degree")
        if nxt.filter("moved").limit(1).count() == 0:
            return labels.select("node", "label")
    raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
