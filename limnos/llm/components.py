"""Connected components of links, by alternating large and small stars.

Each round joins every node to the smallest node that it or a neighbour knows; the number of links never grows. Tasks
that find links first reduce them to one link a node (``rooted``), so that groups with many links stay linear. Rounds
are joins and aggregates on nodes; a node with very many links is pre-aggregated and split by the adaptive skew join.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnos.llm.shared import saved


def rooted(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and links between them, the smallest node of each node's component, inside one task."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        for side in (left, right):
            np.minimum.at(root, before[side], low)
            np.minimum.at(root, side, low)
        root = root[root]
        if np.array_equal(root, before):
            return root


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node that links lead to.

    Links of a node with itself count for nothing. Without links the result is empty.
    """
    links = saved(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    while True:
        # large star: each node's larger neighbours move to its smallest neighbour or itself
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # small star: a node and its smaller neighbours move to the smallest of these
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(down, "b").select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("a").alias("b")), F.struct(F.col("m").alias("a"), F.col("b").alias("b")))).alias("l"))
        after = saved(small.select("l.a", "l.b").where("a <> b").distinct(), "links")
        # done when every node has one link, to a node that has no smaller one
        loose = after.groupBy("b").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() or after.join(after.select(F.col("b").alias("a")), "a", "left_semi").limit(1).count()
        links = after
        if not loose:
            return links.select(F.col("b").alias("node"), F.col("a").alias("root")).union(links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
