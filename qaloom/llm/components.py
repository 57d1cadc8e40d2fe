"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.session import materialise


def _large(links: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest one around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    hooked = both.join(least, "a").select("b", F.least("a", "m").alias("m"), F.col("a"))
    return hooked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small(links: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def connected_components(links: DataFrame) -> DataFrame:
    """Smallest reachable node of every linked node: ``node``, ``component``.

    ``links`` has long columns ``a`` and ``b``; order, repeats and self links don't
    matter, and links with a null end are ignored. Alternates large-star and
    small-star rounds (Kiveris et al., 2014), whose number grows with the logarithm
    of the longest chain. Each round is written to shared storage, so a lost
    executor costs one round at most. A hub's links are combined before the shuffle
    and joined back by a join whose skewed side Spark can split. An empty table
    gives an empty table.
    """
    now = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    mark = None
    while True:
        found = now.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if mark == tuple(found) or not found["n"]:
            break
        mark = tuple(found)
        now = materialise(_small(_large(now).distinct()).distinct())
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
