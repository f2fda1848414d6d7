"""Connected components by alternating star contractions (Kiveris et al., 2014), in joins and combinable aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.durable import drop, keep
from ..operators.spread import apart

#: Edges of a partition that a round writes, and partitions at least.
EDGES, LEAST = 100_000, 8


def _large(edges: DataFrame, parts: int) -> DataFrame:
    """Every node's larger neighbours move to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    moved = apart(both.where("b > a"), least, ["a"]).select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.coalesce(parts).distinct()


def _small(edges: DataFrame, parts: int) -> DataFrame:
    """Every node and its smaller neighbours move to the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = apart(edges, least, ["a"]).where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(least.select("a", F.col("low").alias("b"))).coalesce(parts).distinct()


def components(links: DataFrame, left: str, right: str, most_rounds: int = 60) -> DataFrame:
    """(node, root): for every node of ``links`` the least node it is connected with.

    The edges of a round are written to the checkpoint folder, so a lost executor costs one round at most; those of the round before are deleted. A node with very many
    neighbours is no hot group: minima are combined before the shuffle, and the joins are ones that Spark can split. A round writes as many partitions as
    its edges fill, so few edges don't become many small files.
    """
    a, b = F.greatest(left, right), F.least(left, right)
    edges = keep(links.select(a.alias("a"), b.alias("b")).where("a <> b").distinct())
    state = F.struct(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a")))
    before = None
    for _ in range(most_rounds):
        now = edges.agg(state.alias("state")).first()["state"]
        if now == before or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before, old = now, edges
        parts = max(LEAST, -(-now[0] // EDGES))
        edges = keep(_small(_large(old.coalesce(parts), parts), parts).coalesce(parts))
        drop(old)
    raise RuntimeError("components did not settle")
