"""Connected components: edges are contracted inside tasks, then by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframe.session import scratch_path

#: Narrow rows that are worth a task of their own.
ROWS = 200_000


def _table(spark: SparkSession, df: DataFrame) -> DataFrame:
    path = scratch_path(spark, "star")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` narrow rows, in no more tasks than they are worth."""
    return df.coalesce(max(1, -(-rows // ROWS)))


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task as stars around the smallest node of each of their components."""
    parts = [(np.asarray(b.column("u")), np.asarray(b.column("v"))) for b in batches]
    if parts:
        u, v = (np.concatenate([p[i] for p in parts]) for i in range(2))
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        a, b, root = at[:len(u)], at[len(u):], np.arange(len(nodes))
        while True:
            x, y = root[a], root[b]
            apart = x != y
            if not apart.any():
                break
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := root[root], root):
                root = up
        on = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[on]), pa.array(nodes[root[on]])], names=["u", "v"])


def _all_stars(e: DataFrame) -> bool:
    """Whether every node hangs on one other at most, and on none that hangs itself."""
    roles = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("top")).union(
        e.select("v", F.lit(0), F.lit(1))).groupBy("x").agg(F.sum("up").alias("up"), F.max("top").alias("top"))
    return few_tasks(roles.filter("up > 1 or up = 1 and top = 1"), 1).isEmpty()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of its component, for every node of the edges (u, v: long).

    Tasks contract the edges they read to stars. Then each step hangs the
    neighbours of a node on the smallest of them, in a number of rounds that
    grows with the logarithm of the longest path. Minima are written before
    they are joined, so either side of that join has its own exchange and a
    centre with many neighbours can be split.
    """
    e = _table(spark, edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    n = e.count()
    e = _table(spark, few_tasks(e, n).mapInArrow(contract, "u long, v long"))
    while not _all_stars(e):
        both = e.union(e.select("v", "u"))
        least = _table(spark, few_tasks(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), n))
        large = both.join(least, "u").filter("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = _table(spark, few_tasks(large.distinct(), n))
        least = _table(spark, few_tasks(e.groupBy("u").agg(F.min("v").alias("m")), n))
        near = e.join(least, "u")
        small = near.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
        e = _table(spark, few_tasks(small.distinct(), n).mapInArrow(contract, "u long, v long"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
