"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import cut_lineage


def connected_components(links: DataFrame) -> DataFrame:
    """Smallest node reachable (``root``) of every node that is not its own root, from links ``a``, ``b``.

    Alternates two star operations: each node hands its larger neighbours, then its smaller ones, to the smallest neighbour. Only
    minima per node are aggregated (and that before the shuffle), so a node with very many links is no hot spot. Every round
    starts from a written table. Ends when a round changes nothing.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = cut_lineage(edges)
    before = None
    while True:
        sign = edges.agg(F.count(F.lit(1)), *(F.sum(F.pmod(F.xxhash64("a", "b", F.lit(i)), F.lit(1 << 31))) for i in (0, 1))).first()
        if sign == before or not sign[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = sign
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = cut_lineage(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = cut_lineage(
            small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        )
