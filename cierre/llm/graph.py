"""Connected components of an edge list, by star contractions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cierre.session import cut_lineage

#: A node with more edges than this, or than a ten-thousandth of all, is dealt out to ``PARTS`` tasks.
MANY, PARTS = 256, 64


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of the component of each of ``n`` nodes."""
    root = np.arange(n)
    while len(a):
        x, y = root[a], root[b]
        differ = x != y
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        if not len(a):
            break
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    return root


def components(edges: DataFrame) -> DataFrame:
    """``edges(a long, b long)`` to ``(node, root)``, root the smallest node.

    Alternates the large star (each node hands its larger neighbours to its
    smallest one) and the small star (its smaller neighbours) until no edge
    changes; the edges never grow in number. Each round is written to the
    checkpoint folder. Minima are aggregated before the shuffle, so a node with
    very many edges costs one row a task there; when the minima come back to the
    edges, such a node's edges are dealt out to many tasks, each with a copy of its
    minimum.
    """

    def with_low(e: DataFrame, low: DataFrame, edges_in_all: int) -> DataFrame:
        """``e(a, b)`` with ``m`` of ``low(a, m, degree)``."""
        bar = max(MANY, edges_in_all // 10_000)
        hubs = low.filter(F.col("degree") > bar).select(F.col("a").alias("hub"))  # 20,000 rows at most, for any number of edges
        dealt = e.join(F.broadcast(hubs), e["a"] == F.col("hub"), "left").select(
            "a", "b", F.when(F.col("hub").isNotNull(), F.pmod(F.xxhash64("b"), F.lit(PARTS))).otherwise(0).alias("part"))
        long = lambda n: F.lit(n).cast("bigint")
        copies = F.when(F.col("degree") > bar, F.sequence(long(0), long(PARTS - 1))).otherwise(F.array(long(0)))
        copied = low.select("a", "m", F.explode(copies).alias("part"))
        return dealt.withColumn("part", F.col("part").cast("bigint")).join(copied, ["a", "part"]).select("a", "b", "m")

    def large(e: DataFrame, n: int) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("degree")).select(
            "a", F.least("a", "m").alias("m"), "degree")
        return with_low(both, low, n).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))

    def small(e: DataFrame, n: int) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
        low = down.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("degree"))
        moved = with_low(down, low, n)
        return moved.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))

    def size(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = cut_lineage(edges.select("a", "b").filter("a <> b").distinct())
    now, before = size(e), None
    while now != before and now[0]:
        e = cut_lineage(small(large(e, now[0]), now[0]).distinct())
        before, now = now, size(e)
    nodes = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
