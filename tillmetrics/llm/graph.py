"""Connected components of a graph given as edges, without gathering it anywhere."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.session import shared_folder


def _cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and forget their lineage."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of (a, b) edges; component: its smallest node.

    Alternates the large-star and the small-star step until no edge changes. Both
    are a minimum per node (combined before the shuffle) and an equi-join that
    Spark can split where a node has very many edges. Loops, repeated edges and
    nulls are left out.
    """
    now = _cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct())
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Large star: the larger neighbours of a node go to its smallest one.
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a > b").distinct()
        # Small star: a node and its smaller neighbours go to the smallest one.
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lowest, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = moved.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct()
        now = _cut(small)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For n items and links a[i]-b[i]: each item's smallest reachable item."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further
    return root
