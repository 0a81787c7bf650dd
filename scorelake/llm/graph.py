"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.common import stored


def _links(edges: DataFrame) -> DataFrame:
    """Each link once, from the larger node u to the smaller v."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return _links(both.join(least, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
    joined = links.join(least, F.col("u") == F.col("w"))
    return _links(joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("w").alias("a"), F.col("m").alias("b"))))


def components(edges: DataFrame, label: str = "links") -> DataFrame:
    """node, root for every node of the links (a, b); root is the smallest node reachable. No links give no rows.

    Every round is written to the shared folder; the rounds end when a round changes nothing,
    after about the logarithm of the longest chain.
    """
    links, before = stored(_links(edges), label), None
    while True:
        found = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if found == before or not found[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = found
        links = stored(_small_star(_large_star(links)), label)
