"""Connected components of a graph given as links, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.tables import stored


def _digest(pairs: DataFrame) -> tuple:
    """Number and hash sum: equal sets of links have equal digests."""
    hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(pairs.agg(F.count("*"), F.sum(hashed)).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over the links, for every linked node.

    Each round points every node at the smallest node it or a neighbour points at
    (large star), then joins the neighbours that still point higher to that minimum (small
    star), until nothing changes. Links are kept apart, one row each; a node with very many
    links is reduced by partial minima and its join side can be split, and every round's
    result is stored. The number of rounds grows with the logarithm of the longest chain.

    Null ends, links to oneself and repeated links do not matter; no links, no rows.
    """
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna()
    pairs = pairs.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    pairs = stored(pairs.distinct(), "links")
    digest = _digest(pairs)
    while True:
        # Large star: each larger neighbour (and the node) is joined to the least of all.
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter("a <> b").distinct()
        # Small star: neighbours below a node, and the node, are joined to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        lower = large.join(low, "a")
        small = lower.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = small.unionByName(low.select("a", F.col("low").alias("b"))).distinct()
        after = stored(small, "links")
        before, digest = digest, _digest(after)
        pairs = after
        if digest == before:
            break
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
