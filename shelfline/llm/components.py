"""Connected components by alternating large-star and small-star rounds.

Every round is a partial aggregate (the least neighbour of each node) and an
equi-join of the edges with it; no neighbour list is ever gathered. The least
neighbours are staged before the join, so both of its sides are plain
shuffles: the edges of a node of any degree are a skewed key that Spark splits
over tasks. Rounds are staged, about log(n) of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import staged


class UnionFind:
    """Small in-task forest: keeps of many edges only those that join two trees."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        path = []
        while (p := self.up.get(x, x)) != x:
            path.append(x)
            x = p
        for y in path:
            self.up[y] = x
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True

    def stars(self) -> list[tuple[int, int]]:
        return [(x, self.root(x)) for x in list(self.up)]


def _starred(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star round over edges (a > b)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    large = edges.select(F.col("b").alias("a"), F.col("a").alias("b")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = staged(large.filter("a != b").distinct(), "large")
    least = staged(large.groupBy("a").agg(F.min("b").alias("m")), "least")
    small = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Undirected edges (a, b) of longs -> (node, root): root is the least node reachable. Isolated nodes have no row."""
    edges = staged(edges.filter("a is not null and b is not null and a != b")
                   .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if now == seen or now[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = now
        edges = staged(_starred(edges), "stars")
