"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import functions as F

from segment_hours.llm.common import stage


def _with_least(edges):
    """Edges (u, v) with ``m``, the least of u and its neighbours. Minima combine before the shuffle."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def _large_star(edges):
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges):
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    marked = _with_least(down)
    pairs = marked.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return pairs.where("u <> v").distinct()


def _state(edges):
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges, name="components"):
    """(node, root) for every node of ``edges`` (two long columns); root is the least node of the component.

    Each round writes its edges as a stage. Rounds grow with the logarithm of the longest chain. A
    node with very many neighbours is only met in aggregates and equi-joins, which Spark can split.
    """
    a, b = edges.columns
    edges = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    before = _state(edges)
    while before[0]:
        edges = stage(_small_star(_large_star(edges).distinct()), name)
        now = _state(edges)
        if now == before:
            break
        before = now
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(own)
