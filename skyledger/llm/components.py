"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import common

#: Links that one task takes on.
LINKS_PER_TASK = 200_000


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a``, ``b``): the root is the least node it is linked with.

    Each round hooks the larger neighbours of a node to its least one, then the smaller ones, until all links lead to
    a root; every round is written to the shared folder. Links are summed by node, so a node with very many is no
    burden for one task beyond its own list of them, which is never gathered.
    """
    links = common.stored(links, "links")
    tasks = max(1, math.ceil(links.count() / LINKS_PER_TASK))

    def stored(df: DataFrame, name: str) -> DataFrame:
        """Written by as many tasks as the links ask for: most rounds are small."""
        return common.stored(df.coalesce(tasks), name)

    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stored(large, "large-star")
        low = stored(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = large.join(low, "a")
        following = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        following = stored(following.distinct(), "small-star")
        # done when every node hangs on one root and no root hangs on another
        links = following
        several = links.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").coalesce(tasks)
        if several.isEmpty() and links.join(links.select(F.col("a").alias("b")).distinct(), "b", "left_semi").coalesce(tasks).isEmpty():
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root"))
            ).distinct()
