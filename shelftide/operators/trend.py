"""Trend of weekly sums and the shift at a known date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelftide.functions.expressions import ratio


def _size(values: Column) -> Column:
    return F.size(values).cast("double")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def _slopes(points: Column) -> Column:
    """Slope between every two weeks of a series; its sign is that of the rise, as weeks ascend."""
    def from_week(p: Column, i: Column) -> Column:
        return F.transform(F.slice(points, i + 2, F.size(points)),
                           lambda q: (q["Qty"] - p["Qty"]) / (q["Week"] - p["Week"]))
    return F.flatten(F.transform(points, from_week))


def _median(ordered: Column) -> Column:
    n = F.size(ordered)
    return (F.get(ordered, F.floor((n - 1) / 2).cast("int")) + F.get(ordered, F.floor(n / 2).cast("int"))) / 2


def _lag_weight(c: Column, spread: Column, n: Column, significant: float) -> Column:
    """Hamed and Rao's sum over the lags whose rank autocorrelation is significant."""
    def lag(k: Column) -> Column:
        both = F.zip_with(F.slice(c, F.lit(1), F.size(c) - k), F.slice(c, k + 1, F.size(c) - k), lambda x, y: x * y)
        r = F.try_divide(_total(both), spread)
        return F.when(F.abs(r) > significant / F.sqrt(n), (n - k) * (n - k - 1) * (n - k - 2) * r).otherwise(0.0)
    return _total(F.transform(F.sequence(F.lit(1), F.size(c) - 1), lag))


def weekly_trend(day_layer: DataFrame, min_weeks: int = 8, significant: float = 1.96) -> DataFrame:
    """Kendall tau with time, Sen slope and Mann-Kendall z per pair over the weeks that have matrix days.

    Weekly sums follow each other closely, which makes a trend look surer than it is. `ZCorrected` takes the
    variance times Hamed and Rao's factor: from the autocorrelations, beyond `significant` standard errors, of
    the ranks of the sums without their Sen slope. It is NULL where the factor is not positive.

    Days are reduced to weekly sums and one array per pair, as long as the calendar at most; all that follows
    are array expressions inside that row. Every array that a lambda reads is a column of its own: written into
    the lambda as an expression it would be made anew for each element.
    """
    week = F.floor(F.datediff("TransDate", F.lit(dt.date(1970, 1, 5))) / 7).cast("int")
    weekly = (day_layer.where(F.col("ValueSales").isNotNull())
              .groupBy("ItemLocationId", week.alias("Week"))
              .agg(F.sum("ValueSales").alias("Qty")))
    series = (
        weekly.groupBy("ItemLocationId")
        .agg(F.sort_array(F.collect_list(F.struct("Week", "Qty"))).alias("Points"))
        .where(F.size("Points") >= max(2, min_weeks)))
    n, score = F.col("n"), F.col("Score")

    def place(x: Column) -> Column:
        return F.array_position("Up", x)

    def place_from_above(x: Column) -> Column:
        return F.array_position("Down", x)

    def sorted_both_ways(values: Column) -> dict[str, Column]:
        return {"Up": F.sort_array(values), "Down": F.sort_array(values, asc=False)}

    # A value that occurs t times adds (t - 1)(2t + 5) at each of its places.
    ties = _total(F.transform("Points.Qty", lambda v: (n + 1 - place(v) - place_from_above(v))
                              * (2 * (n + 2 - place(v) - place_from_above(v)) + 5)))
    first = F.get("Points", F.lit(0))["Week"]
    # Equal sums around the slope must be equal to the last bit to share a rank.
    around = F.transform("Points", lambda p: F.round(p["Qty"] - F.col("SenSlope") * (p["Week"] - first), 9))
    # Ranks around their mean; equal values share the mean of their ranks.
    ranks = F.transform("Around", lambda x: (place(x) - place_from_above(x)) / 2)
    z = score - F.signum(score)
    corrected = F.col("Variance") * (1 + F.try_divide(2 * F.col("LagWeight"), n * (n - 1) * (n - 2)))
    return (
        series.withColumn("n", _size(F.col("Points")))
        .withColumn("Slopes", F.sort_array(_slopes(F.col("Points"))))
        .withColumns({
            "Steps": _size(F.col("Slopes")),
            "Score": _total(F.transform("Slopes", lambda s: F.signum(s))),
            "Untied": _size(F.filter("Slopes", lambda s: s != 0)),
            "SenSlope": _median(F.col("Slopes"))}).drop("Slopes")
        .withColumns(sorted_both_ways(F.col("Points.Qty")))
        .withColumns({"Variance": (n * (n - 1) * (2 * n + 5) - ties) / 18, "Around": around})
        .withColumns(sorted_both_ways(F.col("Around")))
        .withColumn("Ranks", ranks).drop("Around", "Up", "Down")
        .withColumn("Spread", _total(F.transform("Ranks", lambda c: c * c)))
        .withColumn("LagWeight", _lag_weight(F.col("Ranks"), F.col("Spread"), n, significant))
        .select("ItemLocationId", F.size("Points").alias("Weeks"),
                F.when(F.col("Untied") > 0, score / F.sqrt(F.col("Steps") * F.col("Untied"))).alias("Tau"),
                "SenSlope", F.when(F.col("Variance") > 0, z / F.sqrt("Variance")).alias("Z"),
                F.when(corrected > 0, z / F.sqrt(corrected)).alias("ZCorrected")))


def known_shift(day_layer: DataFrame, date: dt.date, keys: Sequence[str]) -> DataFrame:
    """Level from a known date on against the level before it, weekday by weekday: a pair
    counts on the weekdays it has on both sides, with the days after the date as weights."""
    after = F.col("TransDate") >= F.lit(date)
    value = F.col("ValueSales")
    by_weekday = day_layer.where(value.isNotNull()).groupBy(
        "ItemLocationId", *keys, F.dayofweek("TransDate").alias("Weekday")).agg(
        F.sum(F.when(after, 1).otherwise(0)).alias("n1"),
        F.sum(F.when(after, value).otherwise(0.0)).alias("s1"),
        F.sum(F.when(~after, 1).otherwise(0)).alias("n0"),
        F.sum(F.when(~after, value).otherwise(0.0)).alias("s0"))
    return (
        by_weekday.where((F.col("n0") > 0) & (F.col("n1") > 0))
        .groupBy(*keys)
        .agg(F.count_distinct("ItemLocationId").alias("Pairs"), F.sum("n1").alias("DaysAfter"),
             F.sum("s1").alias("SalesAfter"),
             F.sum(F.col("s0") / F.col("n0") * F.col("n1")).alias("ExpectedAfter"))
        .withColumn("Shift", ratio(F.col("SalesAfter"), F.col("ExpectedAfter"))))
