"""Connected components of a link table, by star contraction on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftide.session import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node but the roots themselves; a root is the smallest node.

    ``links`` has columns a and b (bigint). Rounds of two steps: every node hands its smallest
    neighbour to its larger neighbours, then to its smaller ones, until the table is a star for each
    component; a few rounds do even for long chains, as distances shrink by a factor. The minima
    are written before they are joined, so that both sides of the join are plain exchanges, of
    which Spark splits the hot ones.
    """
    stars = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("node"),
                                     F.least("a", "b").alias("root")).distinct(), "stars")
    before = None
    while True:
        mark = stars.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if mark == before:
            return stars
        before = mark
        both = stars.unionAll(stars.select(F.col("root"), F.col("node")))
        low = materialise(both.groupBy("node").agg(F.min("root").alias("low"))
                          .withColumn("low", F.least("node", "low")), "minima")
        large = materialise(both.where("root > node").join(low, "node")
                            .select(F.col("root").alias("node"), F.col("low").alias("root"))
                            .distinct(), "stars")
        low = materialise(large.groupBy("node").agg(F.min("root").alias("low")), "minima")
        small = (large.join(low, "node").where("root <> low")
                 .select(F.col("root").alias("node"), F.col("low").alias("root"))
                 .unionAll(low).distinct())
        stars = materialise(small, "stars")
