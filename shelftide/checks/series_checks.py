"""Checks of the day and array layers against the raw facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelftide.checks.journal import check, relative_gap, rows_of, text
from shelftide.functions import labels
from shelftide.functions.expressions import branch_of
from shelftide.params import Params
from shelftide.session import materialise
from shelftide.sources.facts import clean_measure, in_period

SUM_TOLERANCE = 1e-9
EXAMPLES = 10


def branch_frame(like: DataFrame, params: Params) -> DataFrame:
    """Branches come from the parameters: a branch lost from the data must still show up."""
    return like.sparkSession.createDataFrame([(b,) for b in params.branches], "Branch string")


def source_branches(facts: DataFrame, params: Params) -> DataFrame:
    return facts.groupBy(branch_of(F.col("ItemMeasure"), params.branches).alias("Branch")).agg(
        F.sum("SalesQty").alias("SrcQty"), F.sum("SalesAmount").alias("SrcAmount"),
        F.count(F.lit(1)).alias("SrcRows"))


def branch_totals(facts: DataFrame, day_layer: DataFrame, params: Params) -> DataFrame:
    layer = day_layer.groupBy("Branch").agg(
        F.sum("SalesQty").alias("Qty"), F.sum("SalesAmount").alias("Amount"),
        F.count(F.lit(1)).alias("Rows"))
    return (branch_frame(facts, params).join(layer, "Branch", "left")
            .join(source_branches(facts, params), "Branch", "left").na.fill(0))


def branch_checks(totals: DataFrame, prefix: str, counted: str = "rows") -> DataFrame:
    """Quantity, amount and count of the layer against the source, by branch."""
    b, what = F.col("Branch"), counted.capitalize()
    def named(kind: str):
        return F.concat(F.lit(f"{prefix}_{kind}_"), b)
    def both(value: str):
        return text("layer ", F.col(value), ", source ", F.col(f"Src{value}"))
    return rows_of(totals, [
        check(named("sales_qty"), labels.ERROR, relative_gap(F.col("Qty"), F.col("SrcQty")),
              both("Qty"), SUM_TOLERANCE),
        check(named("sales_amount"), labels.ERROR,
              relative_gap(F.col("Amount"), F.col("SrcAmount")), both("Amount"), SUM_TOLERANCE),
        check(named(counted), labels.ERROR, F.abs(F.col(what) - F.col(f"Src{what}")),
              both(what)),
    ])


def source_totals(raw: DataFrame, params: Params) -> DataFrame:
    """Rows and items whose measure no branch claims. The distinct items are found by a
    grouping, so only their counts and the first examples reach the single totals row."""
    rows = raw.where(in_period(params)).select(
        F.coalesce(F.col("ItemId"), F.lit("")).alias("ItemId"), clean_measure().alias("Measure"))
    known = F.col("Measure").isin(params.measures)
    counted = materialise(rows.groupBy("ItemId", "Measure").agg(F.count(F.lit(1)).alias("n"))
                          .withColumn("Unknown", ~known), "source-items")
    unknown = counted.where("Unknown")
    totals = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("SrcRowsAll"),
        F.coalesce(F.sum(F.when(F.col("Unknown"), F.col("n"))), F.lit(0)).alias("UnknownRows"))
    items = unknown.select("ItemId").distinct().agg(F.count(F.lit(1)).alias("UnknownItems"))
    measures = unknown.select("Measure").distinct().orderBy("Measure").limit(EXAMPLES).agg(
        F.array_join(F.sort_array(F.collect_list("Measure")), ", ").alias("UnknownMeasures"))
    examples = (
        unknown.select(F.concat("ItemId", F.lit(" ("), "Measure", F.lit(")")).alias("e"))
        .distinct().orderBy("e").limit(EXAMPLES)
        .agg(F.array_join(F.sort_array(F.collect_list("e")), ", ").alias("UnknownExamples")))
    return totals.crossJoin(items).crossJoin(measures).crossJoin(examples)


def _branch_code(params: Params) -> Column:
    """Number of the branch from 1, 0 for none or an unknown one."""
    code = F.lit(0)
    for i, b in enumerate(params.branches, 1):
        code = F.when(F.col("Branch") == b, i).otherwise(code)
    return code


def day_totals(day_layer: DataFrame, params: Params) -> DataFrame:
    """Counters of every pair, by a grouping on day and pair and one on the pair: rows, keys, branches,
    matrix days of life, and rows, quantity and amount by branch. Branches go by numbers, as a text
    minimum would make a sort of the grouping."""
    code, one = F.col("Code"), F.lit(1)
    observed = (F.col("IsEmpty") == 0) & (F.col("IsMatrix") == 1) & (F.col("InLife") == 1)

    def total(condition: Column, value: Column | int = 1) -> Column:
        zero = 0 if isinstance(value, int) else 0.0
        return F.sum(F.when(condition, value).otherwise(zero))

    counters = {
        "Rows": F.count(one), "UnknownBranch": total(code == 0), "ReturnRows": F.sum("IsReturn"),
        "LowBranch": F.min(code), "HighBranch": F.max(code), "Filled": F.max(F.when(F.col("IsEmpty") == 0, 1).otherwise(0)),
        "MatrixLifeDays": total(observed)}
    for i, _ in enumerate(params.branches, 1):
        counters |= {f"Rows{i}": total(code == i), f"Qty{i}": total(code == i, F.col("SalesQty")),
                     f"Amount{i}": total(code == i, F.col("SalesAmount"))}
    by_key = day_layer.withColumn("Code", _branch_code(params)).groupBy("ItemLocationId", "TransDate").agg(
        *[c.alias(n) for n, c in counters.items()])
    merge = {"LowBranch": F.min, "HighBranch": F.max, "Filled": F.max}
    return by_key.groupBy("ItemLocationId").agg(
        F.count(one).alias("Keys"), *[merge.get(n, F.sum)(n).alias(n) for n in counters])


def array_totals(array_layer: DataFrame) -> DataFrame:
    """Of every pair: arrays of a wrong length, and the points of the sales series."""
    def broken(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    return array_layer.groupBy("ItemLocationId").agg(
        broken(F.size("Values") != F.datediff("LastDay", "FirstDay") + 1).alias("BadLength"),
        broken(F.size("Values") != F.size("Deficit")).alias("BadDeficit"),
        F.max(F.when(F.col("Variant") == labels.SALES,
                     F.size(F.filter("Values", lambda v: v.isNotNull())))).alias("ArrayPoints"))


def layer_totals(day_layer: DataFrame, array_layer: DataFrame | None, params: Params) -> DataFrame:
    """All counters of the days and arrays in one row."""
    pairs = day_totals(day_layer, params)
    added = [c for c in pairs.columns if c not in ("ItemLocationId", "LowBranch", "HighBranch", "Filled",
                                                   "MatrixLifeDays")]
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in added]

    def counted(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0))

    sums.append(counted(F.col("LowBranch") < F.col("HighBranch")).alias("MultiBranchPairs"))
    if array_layer is not None:
        pairs = pairs.join(array_totals(array_layer), "ItemLocationId", "full")
        wrong = F.col("ArrayPoints").isNull() | (F.col("ArrayPoints") != F.col("MatrixLifeDays"))
        sums += [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("BadLength", "BadDeficit")]
        sums.append(counted((F.col("Filled") == 1) & wrong).alias("BadPoints"))
    return pairs.agg(*sums)


def series_checks(raw: DataFrame, facts: DataFrame, day_layer: DataFrame,
                  array_layer: DataFrame | None, params: Params) -> list[DataFrame]:
    """Journal parts of the day layer and, where given, of the array layer."""
    c = F.col
    counted = materialise(layer_totals(day_layer, array_layer, params), "layer-totals")
    totals = counted.crossJoin(source_totals(raw, params))
    by_branch = counted.select(F.inline(F.array(*[
        F.struct(F.lit(b).alias("Branch"), *[c(f"{n}{i}").alias(n) for n in ("Qty", "Amount", "Rows")])
        for i, b in enumerate(params.branches, 1)])))
    source = source_branches(facts, params)
    parts = [
        branch_checks(by_branch.join(source, "Branch", "left").na.fill(0), "days"),
        rows_of(totals, [
            check("days_rows_total", labels.ERROR,
                  F.abs(c("Rows") + c("UnknownRows") - c("SrcRowsAll")),
                  text(c("SrcRowsAll"), " source rows; days hold ", c("Rows"), ", ", c("UnknownRows"),
                       " have no known measure")),
            check("source_measures_known", labels.WARNING, c("UnknownRows"),
                  text(c("UnknownRows"), " rows of ", c("UnknownItems"),
                       " items are measured in units of no branch (first ones: ",
                       c("UnknownMeasures"), "), such as ", c("UnknownExamples"))),
            check("days_rows_positive", labels.ERROR, c("Rows") == 0,
                  text("the day layer has ", c("Rows"), " rows")),
            check("days_key_unique", labels.ERROR, c("Rows") - c("Keys"),
                  text(c("Rows"), " rows for ", c("Keys"), " combinations of day and pair")),
            check("days_branch_known", labels.ERROR, c("UnknownBranch"),
                  text(c("UnknownBranch"), " rows belong to no branch")),
            check("days_pair_one_branch", labels.ERROR, c("MultiBranchPairs"),
                  text(c("MultiBranchPairs"), " pairs change their branch")),
            check("days_returns_zeroed", labels.WARNING, c("ReturnRows"),
                  text(c("ReturnRows"), " rows were returns and count as no sale")),
        ])]
    if array_layer is not None:
        parts.append(array_checks(counted))
    return parts


def array_checks(totals: DataFrame) -> DataFrame:
    c = F.col
    return rows_of(totals, [
        check("arrays_length_life", labels.ERROR, c("BadLength"),
              text("series whose length is not their days of life: ", c("BadLength"))),
        check("arrays_deficit_length", labels.ERROR, c("BadDeficit"),
              text("series whose deficit array has another length: ", c("BadDeficit"))),
        check("arrays_points_match_days", labels.ERROR, c("BadPoints"),
              text("pairs whose observed points are not their matrix days of life: ",
                   c("BadPoints"))),
    ])
