"""Connected components: of an edge table on the cluster, and of the links that one task sees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenreef.llm._scratch import Scratch


class Forest:
    """Union-find over numbers that reports only the links that join two trees."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (up := self.parent.get(root, root)) != root:
            root = up
        while (up := self.parent.get(x, x)) != root:
            self.parent[x], x = root, up
        return root

    def joins(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a long, b long)``; root is the smallest node.

    Alternates large-star and small-star steps until the edge table stands
    still; each round is written to the shared folder, and the one before is deleted. The minimum of a node's
    neighbours is a partial aggregate and its join side has one row for each
    node, so a node with very many neighbours is split and not gathered.
    Self-loops, repeated and null edges are left out; no edges give no rows.
    """
    scratch = Scratch(edges.sparkSession)
    edges = edges.select("a", "b").where(F.col("a") != F.col("b"))
    edges = scratch.keep(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _fingerprint(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        old, edges = edges, scratch.keep(small.select("e.*").where("a <> b").distinct(), "edges")
        scratch.drop(old)
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return nodes.unionByName(roots)
