"""Connected components of links as Spark jobs.

Each partition first contracts its own links with a union-find (what leaves
it are stars around its local roots); then large-star / small-star rounds
join the stars until no link changes.  A hub with many links is never
gathered in one place: its minimum is aggregated map-side, written, and joined
back, so that Spark can split the hub's side of the join over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonalyze.llm.common import map_arrow, saved


class UnionFind:
    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (up := self.parent.setdefault(root, root)) != root:
            root = up
        while self.parent[x] != root:
            self.parent[x], x = root, self.parent[x]
        return root

    def union(self, a: int, b: int) -> bool:
        """Join two sets under the smaller root; False if they were one."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets = UnionFind()
    for batch in batches:
        for a, b in zip(*(c.to_numpy(zero_copy_only=False).tolist() for c in batch.columns)):
            sets.union(a, b)
    nodes = np.array([x for x in sets.parent if sets.find(x) != x], np.int64)
    roots = np.array([sets.find(x) for x in nodes.tolist()], np.int64)
    if len(nodes):
        yield pa.RecordBatch.from_arrays([pa.array(roots), pa.array(nodes)], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b longs): the
    component is the smallest node that can be reached."""
    stars = map_arrow(links.select("a", "b"), _contract, "a long, b long")
    edges = saved(stars.distinct(), "links")          # a < b
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
                edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
        state = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = saved(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "links-least")
        large = (both.filter("b > a").join(least, "a")
                 .select(F.col("m").alias("a"), "b").filter("a < b").distinct())
        # the star's own centre keeps its link to the minimum
        large = large.unionByName(least.select(F.col("m").alias("a"), F.col("a").alias("b"))
                                  .filter("a < b")).distinct()
        large = saved(large, "links-large")
        down = saved(large.groupBy("b").agg(F.min("a").alias("m")), "links-down")
        small = (large.join(down, "b").select(F.col("m").alias("x"), F.col("a").alias("y"))
                 .unionByName(down.select(F.col("m").alias("x"), F.col("b").alias("y")))
                 .filter("x < y").distinct())
        edges = saved(small.select(F.col("x").alias("a"), F.col("y").alias("b")), "links")
