"""How the ABC rules agree: with each other, between stores and from quarter to quarter."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window, functions as F

from shelftide.functions import labels
from shelftide.functions.expressions import ratio
from shelftide.operators.abc import abc_classes
from shelftide.params import Params
from shelftide.session import materialise


def top_overlap(base: DataFrame) -> DataFrame:
    """Jaccard overlap of the class-A sets of every two rules, by branch: one aggregation
    with two counters per rule pair."""
    pairs = list(combinations(labels.ABC_COLUMNS, 2))
    counters = []
    for i, (a, b) in enumerate(pairs):
        in_a, in_b = F.col(a) == "A", F.col(b) == "A"
        counters += [F.sum(F.when(in_a & in_b, 1).otherwise(0)).alias(f"Both{i}"),
                     F.sum(F.when(in_a | in_b, 1).otherwise(0)).alias(f"Either{i}")]
    counted = base.where(F.col("Variant") == labels.SALES).groupBy("Branch").agg(*counters)
    rows = F.array(*[
        F.struct(F.lit(a).alias("RuleA"), F.lit(b).alias("RuleB"),
                 F.col(f"Both{i}").alias("Both"), F.col(f"Either{i}").alias("Either"))
        for i, (a, b) in enumerate(pairs)])
    return (counted.select("Branch", F.inline(rows))
            .withColumn("Jaccard", ratio(F.col("Both"), F.col("Either"))))


def store_agreement(base: DataFrame, rule: str) -> DataFrame:
    """Per item: how many stores share its most common class, and the entropy of classes.

    Stores are counted by class first, so an item sold everywhere is three rows, not one
    group of all its stores.
    """
    counts = (
        base.where((F.col("Variant") == labels.SALES) & (F.col(rule) != labels.NOT_APPLICABLE))
        .groupBy("ItemId", F.col(rule).alias("Class")).agg(F.count(F.lit(1)).alias("n")))
    n = F.col("n").cast("double")
    total = F.sum(n)
    return counts.groupBy("ItemId").agg(
        total.cast("long").alias("Stores"), (F.max(n) / total).alias("ModalShare"),
        # Entropy in bits: log2 N - sum(n log2 n) / N.
        (F.log2(total) - F.sum(n * F.log2(n)) / total).alias("Entropy"))


def quarter_classes(day_layer: DataFrame, pair_profile: DataFrame, params: Params) -> DataFrame:
    """Six classes per pair and calendar quarter, by the same rules, from written sums of the quarters."""
    matrix_life = (F.col("IsMatrix") == 1) & (F.col("InLife") == 1)
    quarters = day_layer.groupBy(
        F.trunc("TransDate", "quarter").alias("Quarter"), "ItemLocationId").agg(
        F.sum("SalesAmount").alias("Revenue"), F.sum("SalesQty").alias("SalesQtyTotal"),
        F.sum(F.when(matrix_life, 1).otherwise(0)).alias("MatrixDays"),
        F.sum(F.when(matrix_life & (F.col("SalesQty") > 0), 1).otherwise(0)).alias("SalesDays"))
    attributes = pair_profile.where(F.col("Variant") == labels.SALES).select(
        "ItemLocationId", "LocationId", "ItemIdLevel2", "Branch", "IsEmpty", "Variant")
    written = materialise(quarters.join(attributes, "ItemLocationId"), "quarters")
    return abc_classes(written, params, keys_before=("Quarter",))


def transitions(classes: DataFrame, rule: str) -> DataFrame:
    """Pairs by class in a quarter and class in the next one. A pair has one row for a quarter of the period."""
    by_pair = Window.partitionBy("ItemLocationId").orderBy("Quarter")
    return (classes.select(
                "Quarter", F.col(rule).alias("FromClass"), F.lead(rule).over(by_pair).alias("ToClass"),
                F.lead("Quarter").over(by_pair).alias("Following"))
            .where((F.col("Following") == F.add_months("Quarter", 3))
                   & (F.col("FromClass") != labels.NOT_APPLICABLE)
                   & (F.col("ToClass") != labels.NOT_APPLICABLE))
            .groupBy("FromClass", "ToClass").agg(F.count(F.lit(1)).alias("Pairs")))


def cramers_v(table: DataFrame) -> DataFrame:
    """Strength of the link in a (FromClass, ToClass, Pairs) table of at most 3 x 3 rows."""
    rows = table.groupBy("FromClass").agg(F.sum("Pairs").alias("RowSum"))
    columns = table.groupBy("ToClass").agg(F.sum("Pairs").alias("ColSum"))
    joined = table.join(rows, "FromClass").join(columns, "ToClass")
    term = F.col("Pairs") * F.col("Pairs") / (F.col("RowSum") * F.col("ColSum"))
    smaller = F.least(F.count_distinct("FromClass"), F.count_distinct("ToClass")) - 1
    return joined.agg(
        F.sum("Pairs").alias("Pairs"),
        F.sqrt(F.try_divide(F.sum(term) - 1, smaller.cast("double"))).alias("CramersV"))
