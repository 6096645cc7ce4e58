"""What-if order frontier: how much is on the shelf and left over at each order quantile.

The order is a quantile of the pair's own series, so it looks ahead: an upper bound for any
model, marked as such in the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from shelftide.functions import labels
from shelftide.functions.expressions import ratio, threshold_of
from shelftide.params import Params

Q_GRID = tuple(Decimal(q) for q in ("0.40", "0.50", "0.60", "0.70", "0.80", "0.90", "0.95"))
TARGETS = (0.75, 0.80)
#: Attributes of a pair by which the curve is cut: the six ABC rules, subgroup and store format.
CUTS = (*labels.ABC_COLUMNS, "ItemIdLevel2", "LocationFormatTT")


def _points(values: Column, threshold: Column, q_grid: Sequence[Decimal]) -> Column:
    """One struct per quantile. The order is the smallest value v with F(v) >= q: the element
    number ceil(q * n) of the sorted values, in exact arithmetic."""
    n = F.size(values)

    def point(q: Column) -> Column:
        order = F.element_at(values, F.ceil(q * n).cast("int"))
        return F.struct(
            q.alias("Q"), order.alias("OrderQty"),
            F.size(F.filter(values, lambda v: order - v >= threshold)).alias("AvailableDays"),
            n.alias("Days"),
            F.aggregate(values, F.lit(0.0),
                        lambda total, v: total + F.greatest(order - v, F.lit(0.0)))
            .alias("Leftover"),
            (order * n).alias("Output"))

    return F.transform(F.array(*[F.lit(q) for q in q_grid]), point)


def order_frontier(day_layer: DataFrame, params: Params,
                   q_grid: Sequence[Decimal] = Q_GRID) -> DataFrame:
    """Frontier rows per pair, variant and quantile, after a single shuffle by pair.

    Only observed values are collected: at most one per day of the period and pair.
    """
    observed = F.col("ValueSales").isNotNull()
    series = (
        day_layer.where(observed).groupBy("ItemLocationId", "Branch")
        .agg(F.sort_array(F.collect_list("ValueSales")).alias(labels.SALES),
             F.sort_array(F.collect_list("ValueDemand")).alias(labels.DEMAND)))
    threshold = threshold_of(F.col("Branch"), params.thresholds)
    variants = F.explode(F.array(*[
        F.struct(F.lit(v).alias("Variant"), F.col(v).alias("V"))
        for v in (labels.SALES, labels.DEMAND)]))
    return (
        series.select("ItemLocationId", threshold.alias("Threshold"), variants.alias("S"))
        .where(F.size("S.V") > 0)
        .select("ItemLocationId", "S.Variant",
                F.inline(_points(F.col("S.V"), F.col("Threshold"), q_grid)))
        .withColumn("Lookahead", F.lit(1)))


def frontier_curve(frontier: DataFrame, profile: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Availability and leftover share of a segment: ratios of sums, not means of shares."""
    attributes = profile.where(F.col("Variant") == labels.SALES).select("ItemLocationId", *keys)
    return (
        frontier.join(attributes, "ItemLocationId")
        .groupBy(*keys, "Variant", "Q")
        .agg(F.sum("AvailableDays").alias("AvailableDays"), F.sum("Days").alias("Days"),
             F.sum("Leftover").alias("Leftover"), F.sum("Output").alias("Output"))
        .withColumn("Availability", ratio(F.col("AvailableDays"), F.col("Days")))
        .withColumn("LeftoverShare", ratio(F.col("Leftover"), F.col("Output"))))


def frontier_cuts(frontier: DataFrame, profile: DataFrame, cuts: Sequence[str] = CUTS) -> DataFrame:
    """The curve of every branch by each cut (one attribute of the pair) and as a whole.

    The rows of pairs are first added up by all attributes together, then all cuts come from those few
    sums in one aggregation over grouping sets. The values of a cut are shown as text.
    """
    attributes = profile.where(F.col("Variant") == labels.SALES).select("ItemLocationId", "Branch", *cuts)
    sums = [F.sum(c).alias(c) for c in ("AvailableDays", "Days", "Leftover", "Output")]
    axes = ["Branch", "Variant", "Q"]
    fine = frontier.join(attributes, "ItemLocationId").groupBy(*axes, *cuts).agg(*sums)
    by = {c: F.grouping(c) == 0 for c in cuts}
    return (
        fine.groupingSets([axes, *[[*axes, c] for c in cuts]], *axes, *cuts)
        .agg(F.coalesce(*[F.when(here, c) for c, here in by.items()], F.lit(labels.TOTAL)).alias("Cut"),
             F.coalesce(*[F.when(here, F.col(c).cast("string")) for c, here in by.items()]).alias("CutValue"),
             *sums)
        .withColumn("Availability", ratio(F.col("AvailableDays"), F.col("Days")))
        .withColumn("LeftoverShare", ratio(F.col("Leftover"), F.col("Output")))
        .drop(*cuts))


def actual_point(day_layer: DataFrame, params: Params, keys: Sequence[str]) -> DataFrame:
    """Where the segment really was, by the same definitions, over matrix days of life."""
    enough = F.col("StockEndQty") >= threshold_of(F.col("Branch"), params.thresholds)
    return (
        day_layer.where((F.col("IsMatrix") == 1) & (F.col("InLife") == 1))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("Days"),
             F.sum(F.when(enough, 1).otherwise(0)).alias("AvailableDays"),
             F.sum("StockEndQty").alias("Leftover"),
             F.sum(F.col("SalesQty") + F.col("StockEndQty")).alias("Output"))
        .withColumn("Availability", ratio(F.col("AvailableDays"), F.col("Days")))
        .withColumn("LeftoverShare", ratio(F.col("Leftover"), F.col("Output"))))


def target_quantiles(curve: DataFrame, keys: Sequence[str],
                     targets: Sequence[float] = TARGETS) -> DataFrame:
    """Smallest quantile that reaches each availability target and the leftover there;
    NULL where the grid never reaches it."""
    reached = F.col("Availability") >= F.col("Target")
    return (
        curve.withColumn("Target", F.explode(F.array(*[F.lit(float(t)) for t in targets])))
        .groupBy(*keys, "Variant", "Target")
        .agg(F.min(F.when(reached, F.col("Q"))).alias("Q"),
             F.min_by("LeftoverShare", F.when(reached, F.col("Q"))).alias("LeftoverShare")))
