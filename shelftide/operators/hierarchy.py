"""Root-to-node paths of a parent/child tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from shelftide.session import materialise


def hierarchy_paths(edges: DataFrame, node: str, parent: str, name: str,
                    delimiter: str = "/") -> DataFrame:
    """For every node: ids and names from the root down, and the joined name path.

    A node's list of ancestors doubles in every round: it takes the list of the node that its own ends
    below, so a tree of any depth is followed to its roots in as many rounds as the depth has binary digits;
    ids must be unique. Nodes on or under a cycle have no root and raise an error. A round is one join,
    written so that the next starts from a table; what it found is counted while it is written.
    """
    for column in (node, parent, name):
        if column not in edges.columns:
            raise ValueError(f"edges have no column {column!r}: {edges.columns}")
    paths = edges.select(
        F.col(node).alias("LevelId"), F.col(parent).alias("ParentLevelId"), F.col(name).alias("LevelName"),
        F.array(F.col(node)).alias("Ids"), F.array(F.col(name)).alias("Names"), F.col(parent).alias("Next"))
    while True:
        found = Observation()
        paths = materialise(paths.observe(
            found, F.count_if(F.col("Next").isNotNull()).alias("climbing"),
            F.max(F.when(F.size(F.array_distinct("Ids")) < F.size("Ids"), F.col("LevelId").cast("string")))
            .alias("looped")), "paths")
        if found.get["looped"] is not None:
            raise ValueError(f"the tree has a cycle at or above node {found.get['looped']!r}")
        if not found.get["climbing"]:
            break
        above = paths.select(F.col("LevelId").alias("Above"), F.col("Ids").alias("AboveIds"),
                             F.col("Names").alias("AboveNames"), F.col("Next").alias("Over"))
        climbed = paths.where("Next is not null").join(above, F.col("Next") == F.col("Above"), "left").select(
            "LevelId", "ParentLevelId", "LevelName",
            F.when(F.col("Above").isNull(), F.col("Ids")).otherwise(F.concat("AboveIds", "Ids")).alias("Ids"),
            F.when(F.col("Above").isNull(), F.col("Names")).otherwise(F.concat("AboveNames", "Names"))
            .alias("Names"), F.col("Over").alias("Next"))
        paths = paths.where("Next is null").unionAll(climbed)

    def filled(column: str):
        return F.filter(column, lambda x: x.isNotNull() & (F.length(x.cast("string")) > 0))

    return (paths.select("LevelId", "ParentLevelId", "LevelName",
                         filled("Ids").alias("LevelIdList"), filled("Names").alias("LevelNameList"))
            .withColumn("LevelNameTree", F.array_join("LevelNameList", delimiter)))
