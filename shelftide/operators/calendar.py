"""Calendar effects: weekday indices, special days, year over year, many tests at once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from shelftide.functions import labels
from shelftide.functions.expressions import exact, ratio
from shelftide.operators.running import running_total


def weekday_index(day_layer: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sales of a weekday relative to the mean of the pair, by segment, from sums.

    The days become at most seven rows per pair first; the mean of the pair is a window over
    those rows.
    """
    by_weekday = day_layer.where(F.col("ValueSales").isNotNull()).groupBy(
        "ItemLocationId", *keys, F.dayofweek("TransDate").alias("Weekday")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("ValueSales").alias("s"))
    pair = Window.partitionBy("ItemLocationId")
    expected = F.col("n") * F.sum("s").over(pair) / F.sum("n").over(pair)
    return (
        by_weekday.withColumn("Expected", expected).groupBy(*keys, "Weekday")
        .agg(F.sum("n").alias("Days"), F.sum("s").alias("Sales"),
             F.sum("Expected").alias("Expected"))
        .withColumn("WeekdayIndex", ratio(F.col("Sales"), F.col("Expected"))))


def special_days(day_layer: DataFrame, calendar: DataFrame, weeks: int = 4) -> DataFrame:
    """Each pair's special day against the same weekday of the weeks around it, special days
    left out. `calendar` (TransDate, DayType) has at most one row per day of the period."""
    day = F.datediff("TransDate", F.lit(dt.date(1970, 1, 1)))
    around = Window.partitionBy("ItemLocationId", F.dayofweek("TransDate")).orderBy(
        day).rangeBetween(-7 * weeks, 7 * weeks)
    usual = F.avg(F.when(F.col("DayType").isNull(), F.col("ValueSales"))).over(around)
    return (
        day_layer.where(F.col("ValueSales").isNotNull())
        .join(calendar, "TransDate", "left").withColumn("Usual", usual)
        .where(F.col("DayType").isNotNull() & (F.col("Usual") > 0))
        .withColumn("Ratio", F.col("ValueSales") / F.col("Usual")))


def special_day_effect(special: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (special.groupBy(*keys, "DayType")
            .agg(F.count(F.lit(1)).alias("Days"), F.sum("ValueSales").alias("Sales"),
                 F.sum("Usual").alias("Usual"))
            .withColumn("Effect", ratio(F.col("Sales"), F.col("Usual"))))


def special_day_quantiles(special: DataFrame, keys: Sequence[str],
                          quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Quantiles of the special-day ratio, weighted by the usual sales: the smallest ratio
    that, with all below it, holds the share q of the weight."""
    group = [*keys, "DayType"]
    values = special.groupBy(*group, "Ratio").agg(F.sum(exact(F.col("Usual"))).alias("__w"))
    ranked = running_total(values, group, [F.col("Ratio").asc()], "__w", "__upto",
                           total="__all")
    share = F.col("__upto").cast("double") / F.col("__all").cast("double")
    return ranked.groupBy(*group).agg(*[
        F.min(F.when(share >= q, F.col("Ratio"))).alias(f"Q{int(q * 100)}") for q in quantiles])


def year_over_year(day_layer: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Level and zero share of the same month in consecutive years, pairs active before the
    cohort date only. The comparison joins the small monthly table with itself."""
    value = F.col("ValueSales")
    months = (
        day_layer.where(value.isNotNull() & (F.col("Cohort") == labels.BEFORE))
        .groupBy(*keys, F.year("TransDate").alias("Year"), F.month("TransDate").alias("Month"))
        .agg(F.count(F.lit(1)).alias("Days"), F.avg(value).alias("Level"),
             F.avg(F.when(value == 0, 1.0).otherwise(0.0)).alias("ZeroShare")))
    earlier = months.select(
        *keys, (F.col("Year") + 1).alias("Year"), "Month", F.col("Level").alias("LevelBefore"),
        F.col("ZeroShare").alias("ZeroShareBefore"))
    return months.join(earlier, [*keys, "Year", "Month"]).select(
        *keys, "Year", "Month", "Days", ratio(F.col("Level"), F.col("LevelBefore"))
        .alias("LevelRatio"), (F.col("ZeroShare") - F.col("ZeroShareBefore"))
        .alias("ZeroShareChange"))


def benjamini_hochberg(tests: DataFrame, p: str, alpha: float,
                       keys: Sequence[str] = ("Branch",)) -> DataFrame:
    """Mark the tests that stay significant among all tests of their group.

    Ranks come from distinct p-values in range blocks; only the cut-off, one row per group,
    is joined back.
    """
    values = tests.where(F.col(p).isNotNull()).groupBy(*keys, p).agg(
        F.count(F.lit(1)).alias("__n"))
    ranked = running_total(values, keys, [F.col(p).asc()], "__n", "__rank", total="__m")
    cut = ranked.groupBy(*keys).agg(F.max(F.when(
        F.col(p) <= alpha * F.col("__rank") / F.col("__m"), F.col(p))).alias("__cut"))
    return (tests.join(cut, list(keys), "left")
            .withColumn("Significant", F.coalesce(F.col(p) <= F.col("__cut"), F.lit(False)))
            .drop("__cut"))
