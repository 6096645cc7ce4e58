"""Deficits and links between series: other stores, other items, neighbours, price.

Totals of a store, item or subgroup day are aggregated (combined before the shuffle) and
joined back, and a row's own value is taken off. A window over such a group would bring a very
large store or item into one task; the join lets adaptive execution split it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelftide.functions import labels
from shelftide.functions.expressions import ratio


def _others(df: DataFrame, on: Sequence[str], value: str, name: str) -> DataFrame:
    """Add the total of `value` over the group without the row itself, NULL for a group of
    one row."""
    totals = df.groupBy(*on).agg(F.sum(value).alias("__t"), F.count(F.lit(1)).alias("__n"))
    return (df.join(totals, list(on))
            .withColumn(name, F.when(F.col("__n") > 1, F.col("__t") - F.col(value)))
            .drop("__t", "__n"))


def _corr(x: Column, y: Column) -> Column:
    """Correlation over the rows where both are known, NULL where either does not vary."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    scale = F.sqrt(F.var_samp(a) * F.var_samp(b))
    return F.when(scale > 1e-9, F.covar_samp(a, b) / scale)


def deficit_frequency(day_layer: DataFrame, base: DataFrame, rule: str) -> DataFrame:
    """Deficit days by branch, ABC class and weekday."""
    by_weekday = (
        day_layer.where((F.col("IsMatrix") == 1) & (F.col("InLife") == 1))
        .groupBy("ItemLocationId", F.dayofweek("TransDate").alias("Weekday"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("IsDeficit").alias("d"),
             F.sum("SalesQty").alias("q"),
             F.sum(F.col("SalesQty") * F.col("IsDeficit")).alias("dq")))
    classes = base.where(F.col("Variant") == labels.SALES).select(
        "ItemLocationId", "Branch", F.col(rule).alias("Class"))
    return (
        by_weekday.join(classes, "ItemLocationId").groupBy("Branch", "Class", "Weekday")
        .agg(F.sum("n").alias("MatrixDays"), F.sum("d").alias("DeficitDays"),
             ratio(F.sum("dq"), F.sum("q")).alias("DeficitSalesShare"))
        .withColumn("DeficitShare", ratio(F.col("DeficitDays"), F.col("MatrixDays"))))


def deficit_effect(profile: DataFrame, measures: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """What days without stock do to the measures: the difference of a pair's sales and demand variant, by
    segment and measure, over the pairs that have both, and how many pairs change their demand class."""
    def of(variant: str, name: str) -> Column:
        return F.max(F.when(F.col("Variant") == variant, F.col(name)))

    pairs = profile.where("IsEmpty = 0").groupBy("ItemLocationId", *keys).agg(
        *[(of(labels.SALES, m) - of(labels.DEMAND, m)).alias(m) for m in measures],
        F.max(F.struct("Variant", "Quadrant")).alias("high"), F.min(F.struct("Variant", "Quadrant")).alias("low"))
    changed = (F.col("high.Quadrant") != F.col("low.Quadrant")).cast("int")
    rows = pairs.select(*keys, changed.alias("Changed"), F.inline(F.array(*[
        F.struct(F.lit(m).alias("Measure"), F.col(m).alias("Difference")) for m in measures])))
    d = F.col("Difference")
    return rows.where(d.isNotNull()).groupBy(*keys, "Measure").agg(
        F.count(F.lit(1)).alias("Pairs"), F.sum("Changed").alias("ClassChanged"),
        F.avg(d).alias("MeanEffect"), F.sum(F.when(F.abs(d) > 1e-9, 1).otherwise(0)).alias("PairsMoved"),
        F.max(F.abs(d)).alias("LargestEffect"))


def weekly_profile_similarity(day_layer: DataFrame) -> DataFrame:
    """Cosine between the weekday profile of a pair and that of its item in all stores."""
    pair = (day_layer.where(F.col("ValueSales").isNotNull())
            .groupBy("ItemLocationId", "ItemId", F.dayofweek("TransDate").alias("Weekday"))
            .agg(F.sum("ValueSales").alias("s"), F.count(F.lit(1)).alias("n")))
    item = pair.groupBy("ItemId", "Weekday").agg(
        (F.sum("s") / F.sum("n")).alias("ItemMean"))
    own = F.col("s") / F.col("n")
    both = pair.join(item, ["ItemId", "Weekday"]).withColumn("Own", own)
    return both.groupBy("ItemLocationId").agg(
        F.count(F.lit(1)).alias("Weekdays"),
        F.try_divide(F.sum(F.col("Own") * F.col("ItemMean")),
                     F.sqrt(F.sum(F.col("Own") * F.col("Own"))
                            * F.sum(F.col("ItemMean") * F.col("ItemMean")))).alias("Cosine"))


def other_stores_correlation(day_layer: DataFrame) -> DataFrame:
    """Correlation of a pair's days with the same item in all other stores that day."""
    rows = day_layer.where(F.col("ValueSales").isNotNull()).select(
        "ItemLocationId", "TransDate", "ItemId", "ValueSales")
    both = _others(rows, ["TransDate", "ItemId"], "ValueSales", "Others")
    return both.groupBy("ItemLocationId").agg(
        F.count("Others").alias("Days"), _corr(F.col("ValueSales"), F.col("Others"))
        .alias("Correlation"))


def common_factors(day_layer: DataFrame) -> DataFrame:
    """Share of a pair's variation explained by the rest of its store and of its subgroup
    that day: R squared of two factors from three correlations."""
    rows = day_layer.select("ItemLocationId", "TransDate", "LocationId", "ItemIdLevel2",
                            "Branch", "SalesQty", "SalesAmount", "ValueSales")
    store = _others(rows, ["TransDate", "LocationId"], "SalesAmount", "StoreRest")
    both = _others(store, ["TransDate", "LocationId", "ItemIdLevel2", "Branch"], "SalesQty",
                   "GroupRest")
    return _two_factors(both, ["ItemLocationId"])


def _two_factors(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Correlations of ValueSales, StoreRest and GroupRest where all are known, and R squared of the two."""
    known = (F.col("ValueSales").isNotNull() & F.col("StoreRest").isNotNull()
             & F.col("GroupRest").isNotNull())
    r = rows.where(known).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("Days"),
        _corr(F.col("ValueSales"), F.col("StoreRest")).alias("StoreCorr"),
        _corr(F.col("ValueSales"), F.col("GroupRest")).alias("GroupCorr"),
        _corr(F.col("StoreRest"), F.col("GroupRest")).alias("FactorCorr"))
    a, b, ab = F.col("StoreCorr"), F.col("GroupCorr"), F.col("FactorCorr")
    free = 1 - ab * ab
    return r.withColumn("R2", F.when(free > 1e-9, (a * a + b * b - 2 * a * b * ab) / free))


def lagged_factors(day_layer: DataFrame, lags: int = 7) -> DataFrame:
    """The two factors of ``common_factors`` some days before, which a forecast may know: one row for every
    pair and lag of 1 to ``lags`` days that has days with both factors that far back.

    The totals of a store or subgroup day carry the days they will explain, all lags side by side, so the
    facts meet them once; the pair's own part of the earlier day, which may have no row, comes from
    windows over the pair's days. Lags are unfolded only then, where rows lie by pair already.
    """
    days = range(1, lags + 1)

    def ahead(on: Sequence[str], value: str, name: str) -> DataFrame:
        totals = day_layer.groupBy("TransDate", *on).agg(F.sum(value).alias("t"), F.count(F.lit(1)).alias("n"))
        carried = totals.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(lags))))
        return carried.groupBy(F.date_add("TransDate", F.col("k")).alias("TransDate"), *on).agg(
            *[F.max(F.when(F.col("k") == k, F.col(c))).alias(f"{name}_{c}{k}") for k in days for c in ("t", "n")])

    store, group = ["LocationId"], ["LocationId", "ItemIdLevel2", "Branch"]
    rows = (
        day_layer.select("ItemLocationId", "TransDate", *group, "SalesQty", "SalesAmount", "ValueSales")
        .join(ahead(store, "SalesAmount", "Store"), ["TransDate", *store], "left")
        .join(ahead(group, "SalesQty", "Group"), ["TransDate", *group], "left"))
    pair = Window.partitionBy("ItemLocationId").orderBy(F.datediff("TransDate", F.lit(dt.date(1970, 1, 1))))

    def before(value: str, k: int) -> Column:
        return F.max(value).over(pair.rangeBetween(-k, -k))

    own = rows.select("*", *[before(v, k).alias(f"{v}{k}") for k in days for v in ("SalesAmount", "SalesQty")])

    def rest(name: str, value: str, k: int) -> Column:
        mine = F.col(f"{value}{k}")
        others = F.col(f"{name}_n{k}") > F.when(mine.isNull(), 0).otherwise(1)
        return F.when(others, F.col(f"{name}_t{k}") - F.coalesce(mine, F.lit(0.0)))

    lagged = own.where(F.col("ValueSales").isNotNull()).select("ItemLocationId", "ValueSales", F.inline(F.array(*[
        F.struct(F.lit(k).alias("Lag"), rest("Store", "SalesAmount", k).alias("StoreRest"),
                 rest("Group", "SalesQty", k).alias("GroupRest")) for k in days])))
    return _two_factors(lagged, ["ItemLocationId", "Lag"])


def substitution(day_layer: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sales of an item while its neighbours are in deficit, against the same weekday without
    neighbour deficits. Days with a deficit of its own are left out."""
    rows = day_layer.where((F.col("IsMatrix") == 1) & (F.col("InLife") == 1)).select(
        "ItemLocationId", "TransDate", "LocationId", "ItemIdLevel3", "Branch", "IsDeficit",
        "ValueDemand", *[k for k in keys if k not in ("ItemIdLevel3", "Branch", "LocationId")])
    near = _others(rows, ["TransDate", "LocationId", "ItemIdLevel3", "Branch"], "IsDeficit",
                   "NearDeficits")
    empty_near = F.col("NearDeficits") > 0
    value = F.col("ValueDemand")
    weekdays = near.where(value.isNotNull()).groupBy(
        "ItemLocationId", *keys, F.dayofweek("TransDate").alias("Weekday")).agg(
        F.sum(F.when(empty_near, 1).otherwise(0)).alias("n1"),
        F.sum(F.when(empty_near, value).otherwise(0.0)).alias("s1"),
        F.sum(F.when(F.coalesce(empty_near, F.lit(False)), 0).otherwise(1)).alias("n0"),
        F.sum(F.when(F.coalesce(empty_near, F.lit(False)), 0.0).otherwise(value)).alias("s0"))
    return (
        weekdays.where((F.col("n0") > 0) & (F.col("n1") > 0)).groupBy(*keys)
        .agg(F.sum("n1").alias("Days"), F.sum("s1").alias("Sales"),
             F.sum(F.col("s0") / F.col("n0") * F.col("n1")).alias("Expected"))
        .withColumn("Effect", ratio(F.col("Sales"), F.col("Expected"))))


def _weekly_prices(day_layer: DataFrame) -> DataFrame:
    week = F.floor(F.datediff("TransDate", F.lit(dt.date(1970, 1, 5))) / 7).cast("int")
    return (
        day_layer.groupBy("ItemLocationId", week.alias("Week"))
        .agg(F.sum("SalesQty").alias("Qty"), F.sum("SalesAmount").alias("Amount"))
        .where((F.col("Qty") > 0) & (F.col("Amount") > 0))
        .withColumn("Price", F.col("Amount") / F.col("Qty")))


def price_elasticity(day_layer: DataFrame, step: float = 0.05) -> DataFrame:
    """Slope of log quantity on log weekly price, and lasting price steps, per pair.

    A step counts where the price moved by more than `step` from the week before and stayed
    within `step` in the following sold week.
    """
    weeks = _weekly_prices(day_layer)
    by_week = Window.partitionBy("ItemLocationId").orderBy("Week")
    moved = F.abs(F.col("Price") / F.lag("Price").over(by_week) - 1) > step
    held = F.abs(F.lead("Price").over(by_week) / F.col("Price") - 1) <= step
    p, q = F.log("Price"), F.log("Qty")
    rows = weeks.select("ItemLocationId", p.alias("p"), q.alias("q"),
                        F.coalesce(moved & held, F.lit(False)).cast("int").alias("Step"))
    spread = F.var_samp("p")
    return rows.groupBy("ItemLocationId").agg(
        F.count(F.lit(1)).alias("Weeks"), F.sum("Step").alias("PriceSteps"),
        F.when(spread > 1e-9, F.covar_samp("q", "p") / spread).alias("Elasticity"))
