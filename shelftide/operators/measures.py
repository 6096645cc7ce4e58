"""Predictability measures that are aggregates over the days of a series."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelftide.functions import labels
from shelftide.functions.expressions import ratio

_VALUES = {labels.SALES: "ValueSales", labels.DEMAND: "ValueDemand"}


def _by_variant(columns: dict[str, dict[str, str]]) -> Column:
    """Unfold columns computed side by side into one row per variant."""
    return F.inline(F.array(*[
        F.struct(F.lit(variant).alias("Variant"),
                 *[F.col(source).alias(name) for name, source in named.items()])
        for variant, named in columns.items()]))


def weekday_strength(day_layer: DataFrame) -> DataFrame:
    """Share of the variance of a series that lies between weekdays (eta squared)."""
    by_weekday = day_layer.where(F.col("ValueSales").isNotNull()).groupBy(
        "ItemLocationId", F.dayofweek("TransDate").alias("Weekday")).agg(*[
            part for v, name in _VALUES.items() for part in (
                F.count(name).cast("double").alias(f"n_{v}"), F.sum(name).alias(f"s_{v}"),
                F.sum(F.col(name) * F.col(name)).alias(f"q_{v}"))])
    totals = by_weekday.groupBy("ItemLocationId").agg(*[
        part for v in _VALUES for part in (
            F.count_if(F.col(f"n_{v}") > 0).alias(f"d_{v}"),
            F.sum(f"n_{v}").alias(f"n_{v}"), F.sum(f"s_{v}").alias(f"s_{v}"),
            F.sum(f"q_{v}").alias(f"q_{v}"),
            F.sum(F.try_divide(F.col(f"s_{v}") * F.col(f"s_{v}"), F.col(f"n_{v}")))
            .alias(f"b_{v}"))])
    rows = totals.select("ItemLocationId", _by_variant({
        v: {"d": f"d_{v}", "n": f"n_{v}", "s": f"s_{v}", "q": f"q_{v}", "b": f"b_{v}"} for v in _VALUES}))
    level = ratio(F.col("s") * F.col("s"), F.col("n"))
    spread = F.col("q") - level
    # A constant series leaves only rounding noise as its variance.
    varies = spread > 1e-9 * F.col("q")
    return rows.where(F.col("n") > 0).select(
        "ItemLocationId", "Variant", F.col("n").cast("long").alias("Points"),
        F.col("d").alias("Weekdays"), F.when(varies, (F.col("b") - level) / spread).alias("WeekdayShare"))


def weekday_significance(strength: DataFrame) -> DataFrame:
    """Chance of a weekday share at least this large if weekdays did not matter (F test).

    With all seven weekdays the tail of F(6, n - 7) is closed: with e the share and a = (n - 7) / 2,
    p = (1 - e)^a (1 + a e + a (a + 1) e^2 / 2).
    """
    e, a = F.col("WeekdayShare"), (F.col("Points") - 7) / F.lit(2.0)
    e = F.greatest(F.lit(0.0), F.least(F.lit(1.0), e))
    return strength.where((F.col("Weekdays") == 7) & (F.col("Points") > 7)
                          & F.col("WeekdayShare").isNotNull()).withColumn(
        "P", F.pow(1 - e, a) * (1 + a * e + a * (a + 1) * e * e / 2))


def _at_lag(name: str, lag: int) -> Column:
    """Value exactly `lag` calendar days earlier, NULL where that day was not observed."""
    day = F.datediff("TransDate", F.lit(dt.date(1970, 1, 1)))
    frame = Window.partitionBy("ItemLocationId").orderBy(day).rangeBetween(-lag, -lag)
    return F.max(name).over(frame)


def lag_measures(day_layer: DataFrame) -> DataFrame:
    """Autocorrelation at 1 and 7 days, variance ratio at 7, and error of the lag forecasts.

    Only days observed on both ends count. One shuffle by pair serves the lag frames of both
    variants and the aggregation after them.
    """
    observed = day_layer.where(F.col("ValueSales").isNotNull()).select(
        "ItemLocationId", "TransDate", *_VALUES.values())
    lagged = observed.select(
        "*", *[_at_lag(name, k).alias(f"{v}_{k}") for v, name in _VALUES.items() for k in (1, 7)])
    columns, named = [], {}
    for v, name in _VALUES.items():
        value = F.col(name)
        named[v] = {}
        for k in (1, 7):
            earlier = F.col(f"{v}_{k}")
            both = value.isNotNull() & earlier.isNotNull()
            columns += [
                F.sum(F.when(both, 1).otherwise(0)).alias(f"n_{v}_{k}"),
                F.var_samp(F.when(both, value)).alias(f"vx_{v}_{k}"),
                F.var_samp(F.when(both, earlier)).alias(f"vy_{v}_{k}"),
                F.covar_samp(F.when(both, value), F.when(both, earlier)).alias(f"c_{v}_{k}"),
                F.var_samp(value - earlier).alias(f"d_{v}_{k}"),
                F.try_divide(F.sum(F.abs(value - earlier)), F.sum(F.when(both, value)))
                .alias(f"w_{v}_{k}")]
            named[v] |= {f"n{k}": f"n_{v}_{k}", f"vx{k}": f"vx_{v}_{k}",
                         f"vy{k}": f"vy_{v}_{k}", f"c{k}": f"c_{v}_{k}",
                         f"d{k}": f"d_{v}_{k}", f"w{k}": f"w_{v}_{k}"}
    rows = lagged.groupBy("ItemLocationId").agg(*columns).select(
        "ItemLocationId", _by_variant(named))
    out = [F.col("n1").alias("Pairs1"), F.col("n7").alias("Pairs7")]
    for k in (1, 7):
        scale = F.sqrt(F.col(f"vx{k}") * F.col(f"vy{k}"))
        out.append(F.when(scale > 0, F.col(f"c{k}") / scale).alias(f"Acf{k}"))
    return rows.select(
        "ItemLocationId", "Variant", *out,
        F.try_divide(F.col("d7"), 7 * F.col("d1")).alias("VarianceRatio7"),
        F.col("w1").alias("NaiveWape"), F.col("w7").alias("SeasonalWape"))


def permutation_entropy(day_layer: DataFrame, order: int = 3) -> DataFrame:
    """Entropy and statistical complexity of the ordinal patterns of `order` days in a row.

    A window with an unobserved day is left out; equal values keep their time order. Patterns
    are counted per series before the entropy, so a group holds at most order! rows.
    """
    observed = day_layer.where(F.col("ValueSales").isNotNull()).select(
        "ItemLocationId", "TransDate", *_VALUES.values())
    windows = observed.select("ItemLocationId", *[
        F.array(*[F.struct((_at_lag(name, k) if k else F.col(name)).alias("v"),
                           F.lit(order - 1 - k).alias("i")) for k in range(order - 1, -1, -1)])
        .alias(v) for v, name in _VALUES.items()])
    rows = windows.select("ItemLocationId", _by_variant({v: {"w": v} for v in _VALUES}))
    pattern = F.array_join(F.transform(F.sort_array("w"), lambda x: x["i"].cast("string")), "")
    counts = (
        rows.where(F.forall("w", lambda x: x["v"].isNotNull()))
        .groupBy("ItemLocationId", "Variant", pattern.alias("Pattern"))
        .agg(F.count(F.lit(1)).cast("double").alias("n")))

    states = math.factorial(order)
    total = F.sum("n").over(Window.partitionBy("ItemLocationId", "Variant"))
    p = F.col("n") / F.col("Total")
    mixed = p / 2 + 1 / (2 * states)
    even = 1 / (2 * states)
    sums = counts.withColumn("Total", total).groupBy("ItemLocationId", "Variant").agg(
        F.sum("n").cast("long").alias("Windows"), F.count(F.lit(1)).alias("Patterns"),
        (-F.sum(p * F.log(p))).alias("S"), (-F.sum(mixed * F.log(mixed))).alias("SMixed"))
    q0 = -2 / ((states + 1) / states * math.log(states + 1) - 2 * math.log(2 * states)
               + math.log(states))
    s_mixed = F.col("SMixed") - (states - F.col("Patterns")) * (even * math.log(even))
    divergence = s_mixed - F.col("S") / 2 - math.log(states) / 2
    entropy = F.abs(F.col("S")) / math.log(states)
    return sums.select("ItemLocationId", "Variant", "Windows", "Patterns",
                       entropy.alias("Entropy"),
                       (q0 * divergence * entropy).alias("Complexity"))
