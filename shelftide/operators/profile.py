"""Series profile: history, demand quadrant and deficit of every pair and variant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelftide.functions import labels
from shelftide.functions.expressions import demand_quadrant, ratio
from shelftide.params import Params

ATTRIBUTES = ("LocationId", "ItemId", "ItemMeasure", "Branch", "ItemIdLevel2", "ItemIdLevel3",
              "LocationNetwork", "LocationFormatTT", "Scope", "Cohort", "OutlierStore",
              "IsEmpty")

PROFILE_COLUMNS = (
    "ItemLocationId", "Variant", *ATTRIBUTES, "FirstActive", "LastActive", "LifeDays",
    "MatrixDays", "MatrixDaysOutLife", "SrcRows", "SalesQtyTotal", "Revenue",
    "RevenueOutMatrixShare", "Price", "VariantDays", "SalesDays", "VariantQty", "SalesLevel",
    "SalesDayShare", "ZeroShare", "Adi", "Cv2", "Quadrant", "DeficitDays", "DeficitDayShare",
    "DeficitSalesShare")

_MIN, _MAX = ("FirstActive",), ("LastActive",)


def _count(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def _total(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(0.0))


def _accumulators() -> dict[str, Column]:
    qty, amount = F.col("SalesQty"), F.col("SalesAmount")
    matrix, life = F.col("IsMatrix") == 1, F.col("InLife") == 1
    deficit, sold = F.col("IsDeficit") == 1, F.col("SalesQty") > 0
    observed = matrix & life
    out = {
        "FirstActive": F.min(F.when(life, F.col("TransDate"))),
        "LastActive": F.max(F.when(life, F.col("TransDate"))),
        "MatrixDays": _count(observed),
        "MatrixOut": _count(matrix & ~life),
        "SrcRows": F.count(F.lit(1)),
        "SalesQtyTotal": F.sum(qty),
        "Revenue": F.sum(amount),
        "AmountOutMatrix": _total(~matrix, amount),
        "SoldQty": _total(sold, qty),
        "SoldAmount": _total(sold, amount),
        "DeficitDays": _count(observed & deficit),
        "ObservedQty": _total(observed, qty),
        "DeficitQty": _total(observed & deficit, qty),
    }
    for suffix, population in ((labels.SALES, observed), (labels.DEMAND, observed & ~deficit)):
        out[f"Days_{suffix}"] = _count(population)
        out[f"Sold_{suffix}"] = _count(population & sold)
        out[f"Qty_{suffix}"] = _total(population, qty)
        out[f"Sq_{suffix}"] = _total(population, qty * qty)
    return out


def _variant_struct(name: str) -> Column:
    return F.struct(F.lit(name).alias("Variant"), F.col(f"Days_{name}").alias("VariantDays"),
                    F.col(f"Sold_{name}").alias("SalesDays"),
                    F.col(f"Qty_{name}").alias("Qty"), F.col(f"Sq_{name}").alias("Sq"))


def profile_pairs(day_layer: DataFrame, params: Params) -> DataFrame:
    """Aggregates of the pair in both series variants, one pass over the day layer.

    Both variants accumulate side by side and are unfolded afterwards, so a day row is
    shuffled at most once and only as part of its map-side partial sums. Attributes are
    grouping keys of the first step (see `series.pair_summary` for why).
    """
    columns = _accumulators()
    by_attributes = (day_layer.groupBy("ItemLocationId", *ATTRIBUTES)
                     .agg(*[c.alias(n) for n, c in columns.items()]))
    merge = {n: (F.min if n in _MIN else F.max if n in _MAX else F.sum)(n) for n in columns}
    merged = by_attributes.groupBy("ItemLocationId").agg(
        *[F.max(a).alias(a) for a in ATTRIBUTES], *[c.alias(n) for n, c in merge.items()])

    empty = F.col("IsEmpty") == 1
    unfolded = merged.select("*", F.inline(F.array(_variant_struct(labels.SALES),
                                                   _variant_struct(labels.DEMAND))))
    days, sold, qty = F.col("VariantDays"), F.col("SalesDays"), F.col("Qty")
    # Sample variance of the non-zero values over their squared mean, as one division of sums: whole quantities
    # give whole terms, so a series right on the bound of jumpy demand meets it.
    spread = F.greatest(sold * F.col("Sq") - qty * qty, F.lit(0.0))
    measured = unfolded.withColumns({
        "LifeDays": F.when(~empty, F.datediff("LastActive", "FirstActive") + 1),
        "MatrixDaysOutLife": F.when(empty, 0).otherwise(F.col("MatrixOut")),
        "RevenueOutMatrixShare": ratio(F.col("AmountOutMatrix"), F.col("Revenue")),
        "Price": ratio(F.col("SoldAmount"), F.col("SoldQty")),
        "DeficitDayShare": ratio(F.col("DeficitDays"), F.col("MatrixDays")),
        "DeficitSalesShare": ratio(F.col("DeficitQty"), F.col("ObservedQty")),
        "VariantQty": F.when(days > 0, qty),
        "SalesLevel": ratio(qty, days),
        "SalesDayShare": ratio(sold, days),
        "ZeroShare": 1 - ratio(sold, days),
        "Adi": ratio(days, sold),
        "Cv2": F.when(sold >= 2, sold * spread / ((sold - 1) * qty * qty))})
    return measured.withColumn(
        "Quadrant", demand_quadrant(F.col("Adi"), F.col("Cv2"), params)).select(*PROFILE_COLUMNS)


def profile_base(pair_profile: DataFrame, abc_layer: DataFrame) -> DataFrame:
    """Profile: variant aggregates plus the ABC classes of the pair."""
    return (pair_profile.join(abc_layer, "ItemLocationId", "left")
            .select(*PROFILE_COLUMNS, *labels.ABC_COLUMNS))
