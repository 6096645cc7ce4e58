"""Running totals and ranks over groups of any size.

A window ordered over a whole group puts that group into one task. Here the rows are range
partitioned by (group, order), so a big group spreads over many blocks; each block sums on its
own and takes the total of the blocks before it from a small table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelftide.session import materialise

_BLOCK = "__block"


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str,
                  name: str, total: str | None = None, blocks: int | None = None) -> DataFrame:
    """Add the inclusive running total of `value` in `order` within `keys`.

    `keys` must not be null and `order` must be total. The placed rows are written once:
    which block a row is in must not change between the two uses below.
    """
    spark = df.sparkSession
    count = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialise(
        df.repartitionByRange(count, *keys, *order).withColumn(_BLOCK, F.spark_partition_id()),
        "running-total")

    sums = placed.groupBy(*keys, _BLOCK).agg(F.sum(value).alias("__sum"))
    # One row per group and block: at most `blocks` rows in a group.
    earlier = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(
        Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    zero = F.lit(0).cast(placed.schema[value].dataType)
    offsets = sums.select(
        *keys, _BLOCK, F.coalesce(F.sum("__sum").over(earlier), zero).alias("__before"),
        *([F.sum("__sum").over(whole).alias(total)] if total else []))

    inside = Window.partitionBy(*keys, _BLOCK).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (
        placed.withColumn("__inside", F.sum(value).over(inside))
        .join(offsets, [*keys, _BLOCK])
        .withColumn(name, F.col("__before") + F.col("__inside"))
        .drop(_BLOCK, "__inside", "__before"))
