"""Connected components of a table of links, by alternating large and small stars.

Links are kept as (high, low). A large star hangs the higher neighbours of a node under the least
node it knows, a small star the lower ones; both keep what is connected, and repeated they end with
every node linked to the least one of its component. Every round is written to the shared folder.
Minima are combined before they are shuffled; a node with very many links is the repeated side of
a join with one row per node, which the adaptive skew join splits.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrack.llm.common import written


def _round(links: DataFrame) -> DataFrame:
    """One large and one small star."""
    both = links.select("high", "low").union(links.select(F.col("low"), F.col("high")).toDF("high", "low"))
    least = both.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    large = links.join(least, links["low"] == least["node"]).select("high", F.col("least").alias("low")).distinct()
    own = large.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least"))
    small = large.join(own, large["high"] == own["node"]).select(
        F.explode(
            F.array(
                F.struct(F.col("high"), F.col("least").alias("low")),
                F.struct(F.col("low").alias("high"), F.col("least").alias("low")),
            )
        ).alias("link")
    )
    return small.select("link.*").filter("high > low").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of `links` (columns a, b): the least node it can reach."""
    spark = links.sparkSession
    current = written(
        links.filter("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(),
        "links",
    )
    before = None
    while True:
        state = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
        ).first()
        if tuple(state) == before or state[0] == 0:
            break
        before = tuple(state)
        current = written(_round(current), "links")
    nodes = current.select(F.col("high").alias("node"), F.col("low").alias("component"))
    roots = current.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return nodes.union(roots) if before else spark.createDataFrame([], nodes.schema)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node each of nodes 0 to n reaches over the links a-b."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, root[a], least)
        np.minimum.at(after, root[b], least)
        after = after[after]
        if np.array_equal(after, root):
            return root
        root = after
