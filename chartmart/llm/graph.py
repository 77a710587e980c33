"""Connected components of a table of links, and blocks that split large groups."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmart.session import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: every node of the links with the least node it reaches.

    Alternates two steps until nothing changes, a number of times that grows with the
    logarithm of the longest path: each node's larger neighbours are linked to its least
    neighbour, then each node and its smaller neighbours. Every step is a grouped minimum
    (combined before the shuffle) and a join, written to the shared folder; no group of
    neighbours is ever held in one place.
    """
    links = links.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where("lo < hi").distinct()
    links = stage(links, "links")
    seen = None
    while True:
        both = links.union(links.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
        least = both.groupBy("lo").agg(F.least(F.min("hi"), F.col("lo")).alias("m")).select(F.col("lo").alias("u"), "m")
        large = links.join(least, links["lo"] == least["u"]).select(F.col("m").alias("lo"), "hi").where("lo < hi").distinct()
        large = stage(large, "large")
        least = large.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("u"), "m")
        small = large.join(least, large["hi"] == least["u"])
        small = small.select(F.col("m").alias("x"), F.col("lo").alias("y")).union(small.select(F.col("m").alias("x"), F.col("hi").alias("y")))
        links = stage(small.where("x < y").select(F.col("x").alias("lo"), F.col("y").alias("hi")).distinct(), "small")
        now = links.agg(F.count("*"), F.sum(F.hash("lo", "hi")), F.sum(F.xxhash64("hi", "lo") % F.lit(1 << 40))).first()
        if now == seen:
            break
        seen = now
    leaf = links.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return leaf.union(links.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())


def block_pairs(rows: DataFrame, group: str, member: str, most: int) -> DataFrame:
    """``rows`` with ``_x, _y, _block``: groups of over ``most`` rows are dealt into blocks by a hash of
    ``member`` and every pair of blocks meets under one (group, _x, _y), a block with itself under
    ``_x = _y``. A group that fits is one block; no group is capped and none lands whole in one task.
    """
    counts = rows.groupBy(group).agg(F.count("*").alias("_n"))
    dealt = rows.join(counts, group).withColumn("_b", F.ceil(F.col("_n") / most).cast("int"))
    dealt = dealt.withColumn("_block", F.pmod(F.xxhash64(member), F.col("_b")).cast("int"))
    dealt = dealt.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_b") - 1)))
    return dealt.withColumn("_x", F.least("_block", "_o")).withColumn("_y", F.greatest("_block", "_o")).drop("_n", "_b", "_o")


class Union:
    """Union of the members 0..n-1 of one block."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def link(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)

    def link_all(self, linked: np.ndarray) -> None:
        """Links the pairs of a boolean matrix, a grown front of rows at a time."""
        n = len(linked)
        left = np.ones(n, dtype=bool)
        for seed in range(n):
            if not left[seed]:
                continue
            left[seed] = False
            front = np.array([seed])
            while len(front):
                reached = np.flatnonzero(linked[front].any(axis=0) & left)
                left[reached] = False
                for x in reached:
                    self.link(seed, int(x))
                front = reached

    def roots(self) -> np.ndarray:
        return np.array([self.find(x) for x in range(len(self.up))], dtype=np.int64)
