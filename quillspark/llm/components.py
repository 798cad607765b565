"""Connected components of links, by rounds of large-star and small-star joins (Kiveris et al., 2014).

Each round is a few joins and aggregates on node ids and ends in a table in the shared folder; no task or driver sees
more than its share of links. A node with very many links is a hot join key that adaptive execution splits: the other
side is a table of one row per node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _smallest(pairs: DataFrame, rows: int) -> DataFrame:
    """For each a: the smallest of itself and its partners b, as a table."""
    return cut(pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), rows)


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (long). Returns node, root for every node of edges; root is the smallest node of the component."""
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    n, seen = edges.count(), None  # rounds add no more than they replace: a link per node and link at most
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = both.join(_smallest(both, 2 * n), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        edges = cut(edges, 2 * n)
        low = _smallest(edges, 2 * n)
        small = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        edges = cut(small.where("a <> b").distinct(), 2 * n)
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
