"""Connected components of a graph given by its links, by alternating stars.

Every round is two joins over the links. A node's smallest neighbour is a minimum, combined before the
shuffle, and joins back to the links of the node; a hub's links are one side of a plain join, which
adaptive execution splits. Each round is written to the shared folder, so that the plan stays short
and a lost executor costs one round. The number of rounds grows with the logarithm of the longest
chain. The driver sees one checksum per round.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialweave.session import remove_folder, scratch_path


def saved(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, read by whoever needs it."""
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.parquet(path)


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node go to the smallest of the node and its neighbours."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    moved = both.filter("b > a").join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them. Links hold a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``links`` has two long columns; returns (node, root) for each node that has a link.

    The root is the smallest node of the component. Links of a node to itself and repeated links
    change nothing; links with a null are left out. Without links the result is empty.
    """
    first, second = links.columns
    ordered = links.select(
        F.greatest(first, second).alias("a"), F.least(first, second).alias("b")
    ).filter(F.col(first).isNotNull() & F.col(second).isNotNull() & (F.col(first) != F.col(second)))
    path = scratch_path(spark, "links")
    ordered.distinct().write.parquet(path)
    current = spark.read.parquet(path)
    before = None
    while True:
        mark = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if mark == before or mark[0] == 0:
            break
        before, old = mark, path
        path = scratch_path(spark, "links")
        _small_star(_large_star(current)).write.parquet(path)
        current = spark.read.parquet(path)
        remove_folder(spark, old)
    pairs = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = pairs.select(F.col("root").alias("node"), "root").distinct()
    return pairs.union(roots)


class Joined:
    """Which of n members of one group are connected already, and the links that did it."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def apart(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        apart = self.label[left] != self.label[right]
        return left[apart], right[apart]

    def one(self, members: np.ndarray) -> bool:
        """Whether the members, one at least, are all connected."""
        label = self.label[members]
        return bool((label == label[0]).all())

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        while True:
            left, right = self.apart(left, right)
            if not len(left):
                return
            a, b = self.label[left], self.label[right]
            low, high = np.minimum(a, b), np.maximum(a, b)
            # Each label joins one smaller label at a time; what is left over comes round again.
            chosen, first = np.unique(high, return_index=True)
            self.links += zip(left[first].tolist(), right[first].tolist())
            to = np.arange(len(self.label))
            to[chosen] = low[first]
            while True:
                further = to[to]
                if np.array_equal(further, to):
                    break
                to = further
            self.label = to[self.label]
