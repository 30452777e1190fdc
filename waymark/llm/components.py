"""Connected components of links by alternating large-star and small-star steps; no group is gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow

#: Nodes that a task holds before it sends its stars.
NODES = 500_000


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _contract(edges: DataFrame) -> DataFrame:
    """A partition's links as stars around least nodes: the same components with fewer, shorter paths.

    Stars are sent and forgotten at NODES nodes, so a task's memory does not grow with its partition.
    """

    def run(batches):
        parent: dict[int, int] = {}

        def stars():
            nodes = list(parent)
            for k in range(0, len(nodes), 50_000):
                pairs = [(x, root(x)) for x in nodes[k : k + 50_000] if root(x) != x]
                yield arrow("a long, b long", a=[x for x, _ in pairs], b=[y for _, y in pairs])
            parent.clear()

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up]
                x = up
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) > NODES:
                yield from stars()
        yield from stars()

    return edges.mapInArrow(run, "a long, b long")


def _round(edges: DataFrame, scratch: Scratch) -> DataFrame:
    return scratch.keep(_small_star(_large_star(_contract(edges))), "edges")


def _labels(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def _links(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")


def merged(links: DataFrame, scratch: Scratch, rounds: int = 1) -> tuple[DataFrame, DataFrame]:
    """((node, label), edges) after a few rounds: nodes of one label are connected, but connected nodes may have several labels.

    The edges have the components of the links; a later round takes them in the links' stead.
    """
    edges = _links(links)
    for k in range(rounds):
        done, edges = edges, _round(edges, scratch)
        if k:
            scratch.drop(done)
    return _labels(edges.groupBy("a").agg(F.min("b").alias("b"))), edges


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label) for every node of links (a, b); the label is the least node reached. Null ends are ignored."""
    edges, before, done = _links(links), None, None
    while True:
        last, edges = done, _round(edges, scratch)
        scratch.drop(last)
        done = edges
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            return _labels(edges)
        before = now
