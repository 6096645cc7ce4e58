"""Daily series: pair summary, stores, pairs, marked days and gap-filled arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelftide.functions import labels
from shelftide.functions.expressions import (
    branch_of, flag, is_active, scope_of, threshold_of)
from shelftide.params import Params

PAIR_COLUMNS = ("ItemLocationId", *labels.PAIR_ATTRIBUTES, "IsEmpty", "FirstActive",
                "LastActive", "Cohort", "SrcRows", "MatrixDays", "ReturnRows")

DAY_COLUMNS = (
    "TransDate", "ItemLocationId", "LocationId", "ItemId", "ItemMeasure", "Branch",
    "ItemIdLevel2", "ItemIdLevel3", "LocationNetwork", "LocationFormatTT", "Scope", "Cohort",
    "OutlierStore", "IsEmpty", "IsMatrix", "InLife", "IsDeficit", "StockStartQty",
    "StockEndQty", "SalesQty", "SalesAmount", "IsReturn", "ValueSales", "ValueDemand")


def pair_summary(facts: DataFrame, params: Params) -> DataFrame:
    """One scan of the facts: everything the pair and store layers need.

    Aggregated in two steps. The first groups by pair and attributes and keeps only
    fixed-width buffers, so it stays a hash aggregation with map-side combine (a string
    max would turn it into a sort of the whole input). The second, on pair-sized data,
    settles attributes that changed over time.
    """
    active = is_active()
    by_attributes = facts.groupBy("ItemLocationId", *labels.PAIR_ATTRIBUTES).agg(
        F.min(F.when(active, F.col("TransDate"))).alias("FirstActive"),
        F.max(F.when(active, F.col("TransDate"))).alias("LastActive"),
        F.count(F.lit(1)).alias("SrcRows"),
        F.sum("IsMatrix").alias("MatrixDays"),
        F.sum("IsReturn").alias("ReturnRows"),
        F.sum("SalesAmount").alias("Revenue"))
    merged = by_attributes.groupBy("ItemLocationId").agg(
        *[F.max(a).alias(a) for a in labels.PAIR_ATTRIBUTES],
        F.min("FirstActive").alias("FirstActive"), F.max("LastActive").alias("LastActive"),
        *[F.sum(c).alias(c) for c in ("SrcRows", "MatrixDays", "ReturnRows", "Revenue")])
    first = F.col("FirstActive")
    return (
        merged
        .withColumn("IsEmpty", flag(first.isNull()))
        .withColumn("Cohort", F.when(first.isNull(), labels.NOT_APPLICABLE)
                    .when(first < F.lit(params.cohort_date), labels.BEFORE)
                    .otherwise(labels.AFTER)))


def stores(summary: DataFrame, params: Params) -> DataFrame:
    """Store revenue and the mark of stores far below the rest (strict comparison)."""
    limit = float(params.outlier_revenue_mln) * 1e6
    return (
        summary.groupBy("LocationId", "LocationNetwork", "LocationFormatTT")
        .agg(F.sum("Revenue").alias("Revenue"))
        .groupBy("LocationId")
        .agg(F.max("LocationNetwork").alias("LocationNetwork"),
             F.max("LocationFormatTT").alias("LocationFormatTT"),
             F.sum("Revenue").alias("Revenue"))
        .withColumn("OutlierStore", flag(F.col("Revenue") < F.lit(limit))))


def pairs(summary: DataFrame) -> DataFrame:
    return summary.select(*PAIR_COLUMNS)


def days(facts: DataFrame, pair_layer: DataFrame, store_layer: DataFrame,
         params: Params) -> DataFrame:
    """Fact rows with their marks; attributes come from the pair.

    The stores meet the pairs first, so the facts join once, on the pair id. No broadcast
    hint: pairs grow with the data, and adaptive execution broadcasts them only where the
    measured size allows it, otherwise splits skewed partitions of the sort-merge join.
    """
    pair_side = (
        pair_layer.select(
            "ItemLocationId", F.col("LocationId").alias("PairStore"), "ItemIdLevel2",
            "ItemIdLevel3", "LocationNetwork", "LocationFormatTT", "IsEmpty", "FirstActive",
            "LastActive", "Cohort")
        .join(store_layer.select(F.col("LocationId").alias("PairStore"), "OutlierStore"),
              "PairStore", "left"))
    in_matrix = F.col("IsMatrix") == 1
    in_life = F.col("InLife") == 1
    # The guard inside the threshold must only meet rows that need a threshold.
    below = F.when(in_matrix & in_life,
                   F.col("StockEndQty") < threshold_of(F.col("Branch"), params.thresholds))
    return (
        facts.drop("ItemIdLevel2", "ItemIdLevel3", "LocationNetwork", "LocationFormatTT")
        .join(pair_side, "ItemLocationId", "left")
        .withColumns({
            "Branch": branch_of(F.col("ItemMeasure"), params.branches),
            "Scope": scope_of(F.col("ItemIdLevel2"), params.disputed),
            "InLife": flag((F.col("IsEmpty") == 0) & F.col("TransDate").between(
                F.col("FirstActive"), F.col("LastActive")))})
        .withColumns({
            "IsDeficit": flag(below),
            "ValueSales": F.when(in_matrix & in_life, F.col("SalesQty"))})
        .withColumn("ValueDemand", F.when(F.col("IsDeficit") == 0, F.col("ValueSales")))
        .select(*DAY_COLUMNS))


def _filled(point: str, gap: Column) -> Column:
    """Array over every calendar day: each row's value, then `gap` for the days after it
    that have no row. One pass over the sorted rows, no lookup per day; values are put
    together once, by the outer flatten, not row by row before it."""
    def stretch(row: Column, i: Column) -> Column:
        # get() past the last row gives NULL, and a NULL repeat count must not null the array.
        following = F.get("Points", i + 1)["TransDate"]
        missing = F.coalesce(F.datediff(following, row["TransDate"]) - 1, F.lit(0))
        return F.array(F.array(row[point]), F.array_repeat(gap, missing))

    return F.flatten(F.flatten(F.transform("Points", stretch)))


def arrays(day_layer: DataFrame) -> DataFrame:
    """Series as arrays over the days of the pair's life, in both variants.

    Needs a unique (day, pair) key, which `days_key_unique` guards; a group then holds at
    most one row per day of the period. Rows are shuffled once; both variants and the
    calendar gaps are made afterwards inside the row, before it is unfolded: what stands
    beside an explode is worked out again for each of its rows.
    """
    collected = (
        day_layer.where((F.col("IsEmpty") == 0) & (F.col("InLife") == 1))
        .groupBy("ItemLocationId")
        .agg(F.sort_array(F.collect_list(F.struct(
            "TransDate", "ValueSales", "ValueDemand", "IsDeficit"))).alias("Points")))
    no_value = F.lit(None).cast("double")
    filled = collected.select(
        "ItemLocationId",
        F.get("Points", F.lit(0))["TransDate"].alias("FirstDay"),
        F.element_at("Points", -1)["TransDate"].alias("LastDay"),
        _filled("IsDeficit", F.lit(0)).alias("Deficit"),
        _filled("ValueSales", no_value).alias("ValueSales"),
        _filled("ValueDemand", no_value).alias("ValueDemand"))
    variants = F.explode(F.array(
        F.struct(F.lit(labels.SALES).alias("Variant"), F.col("ValueSales").alias("Values")),
        F.struct(F.lit(labels.DEMAND).alias("Variant"), F.col("ValueDemand").alias("Values"))))
    return (
        filled
        .select("ItemLocationId", "FirstDay", "LastDay", "Deficit", variants.alias("Series"))
        .select("ItemLocationId", "Series.Variant", "FirstDay", "LastDay",
                "Series.Values", "Deficit"))


def positions(array_layer: DataFrame) -> DataFrame:
    """Array layer as rows, one per series and day of life."""
    return (
        array_layer
        .select("ItemLocationId", "Variant", "FirstDay",
                F.posexplode(F.arrays_zip("Values", "Deficit")))
        .select("ItemLocationId", "Variant", F.col("pos").alias("Position"),
                F.date_add("FirstDay", F.col("pos")).alias("TransDate"),
                F.col("col.Values").alias("Value"), F.col("col.Deficit").alias("Deficit")))
