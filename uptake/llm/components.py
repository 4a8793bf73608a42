"""Connected components of a graph given as links, by alternating star contractions.

Every round is a few joins and aggregations over the links. The neighbours of a node are never
brought together: a node only learns its smallest neighbour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.llm.common import stored


def _nearest(links: DataFrame) -> DataFrame:
    """The smallest of each node ``a`` and its neighbours ``b``."""
    return links.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    larger = both.where("b > a").join(_nearest(both), "a")
    return larger.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Takes links to smaller nodes only."""
    least = _nearest(links)
    moved = links.join(least, "a").where("b <> least").select(
        F.col("b").alias("a"), F.col("least").alias("b")
    )
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """The smallest reachable node (``root``) of every node (``node``) that has a larger or
    smaller neighbour; roots themselves are not listed.

    ``links`` has integer columns ``a`` and ``b``, in either order. Links of a node with itself
    and repeated links are ignored. No links give no rows. The rounds grow with the logarithm
    of the longest path; each writes its links to the shared folder, so a lost executor repeats
    one round at most.
    """
    links = stored(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        after = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if after == before or after[0] == 0:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after
        links = stored(_small_star(_large_star(links)), "links")
