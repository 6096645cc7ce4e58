"""Rolling-origin baseline forecasts on the array layer, and their errors.

Every day of a window is an origin; the forecast for days 1..horizon uses only the days before
the origin. The work stays inside the series row: no join, and only scalars are unfolded.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shelftide.functions.expressions import ratio

MODELS = {"mean": "Mean", "median": "Median", "median_dow": "MedianDow"}


@dataclass(frozen=True)
class Backtest:
    window_start: dt.date
    window_days: int = 84
    horizon: int = 7
    history_days: int = 91
    min_history: int = 28
    data_lag_days: int = 0
    quantiles: Sequence[float] = (0.5, 0.8, 0.9)


def _element(values: Column, q: float) -> Column:
    """Exact quantile of sorted values: the element at position floor(q * n)."""
    n = F.size(values)
    return F.get(values, F.least(F.floor(F.lit(q) * n).cast("int"), n - 1))


def forecasts(array_layer: DataFrame, test: Backtest) -> DataFrame:
    """One row per series, origin and horizon, with the observed value of the target day.

    A series with fewer than `min_history` observed days before the origin gets no forecast.
    """
    # Position of the first origin inside the series; negative before its first day.
    series = array_layer.select(
        "ItemLocationId", "Variant", "FirstDay", "Values",
        F.datediff(F.lit(test.window_start), "FirstDay").alias("Offset"))
    offset, values = F.col("Offset"), F.col("Values")

    def first_used(k: Column) -> Column:
        return F.greatest(offset + k - test.data_lag_days - test.history_days, F.lit(0))

    def last_used(k: Column) -> Column:
        return offset + k - test.data_lag_days - 1

    def history(k: Column) -> Column:
        length = F.greatest(last_used(k) - first_used(k) + 1, F.lit(0))
        window = F.slice(values, first_used(k) + 1, length)
        return F.sort_array(F.filter(window, lambda v: v.isNotNull()))

    def summary(sorted_values: Column, k: Column) -> Column:
        n = F.size(sorted_values)
        enough = n >= test.min_history
        total = F.aggregate(sorted_values, F.lit(0.0), lambda a, v: a + v)
        return F.struct(
            k.alias("K"), n.alias("HistoryDays"),
            F.when(enough, total / n).alias("Mean"),
            F.when(enough, _element(sorted_values, 0.5)).alias("Median"),
            *[F.when(enough, _element(sorted_values, q)).alias(f"Q{i}")
              for i, q in enumerate(test.quantiles)])

    weeks = math.ceil((test.history_days + test.data_lag_days + test.horizon) / 7)

    def target(point: Column, h: Column) -> Column:
        position = offset + point["K"] + h - 1
        same_weekday = F.transform(F.sequence(F.lit(1), F.lit(weeks)), lambda w: F.when(
            (position - w * 7).between(first_used(point["K"]), last_used(point["K"])),
            F.get(values, position - w * 7)))
        observed = F.sort_array(F.filter(same_weekday, lambda v: v.isNotNull()))
        return F.struct(
            F.date_add(F.lit(test.window_start), point["K"]).alias("Origin"),
            h.alias("Horizon"), point["HistoryDays"].alias("HistoryDays"),
            F.date_add("FirstDay", last_used(point["K"])).alias("LastUsed"),
            point["Mean"].alias("Mean"), point["Median"].alias("Median"),
            F.when(point["HistoryDays"] >= test.min_history, _element(observed, 0.5))
            .alias("MedianDow"),
            *[point[f"Q{i}"].alias(f"Q{i}") for i in range(len(test.quantiles))],
            F.get(values, position).alias("Actual"))

    histories = F.transform(F.sequence(F.lit(0), F.lit(test.window_days - 1)), history)
    origins = F.transform(histories, summary)
    horizons = F.sequence(F.lit(1), F.lit(test.horizon))
    rows = F.flatten(F.transform(
        origins, lambda point: F.transform(horizons, lambda h: target(point, h))))
    return series.select("ItemLocationId", "Variant", F.inline(rows))


def forecast_errors(forecast: DataFrame, test: Backtest) -> DataFrame:
    """Error sums per series, model and horizon. Only observed target days count, and WAPE
    is NULL where nothing was sold."""
    actual = F.col("Actual")
    scored = forecast.where(actual.isNotNull() & F.col("Mean").isNotNull())
    columns = []
    for model, name in MODELS.items():
        known = F.col(name).isNotNull()
        columns += [
            F.sum(F.when(known, 1).otherwise(0)).alias(f"n_{model}"),
            F.sum(F.when(known, actual).otherwise(0.0)).alias(f"y_{model}"),
            F.sum(F.when(known, F.abs(actual - F.col(name))).otherwise(0.0)).alias(f"e_{model}")]
    for i, q in enumerate(test.quantiles):
        gap = actual - F.col(f"Q{i}")
        columns.append(F.sum(F.greatest(gap * q, gap * (q - 1))).alias(f"p_{i}"))
    sums = scored.groupBy("ItemLocationId", "Variant", "Horizon").agg(*columns)

    nothing = F.lit(None).cast("double")
    models = [F.struct(F.lit(m).alias("Model"), F.col(f"n_{m}").alias("Days"),
                       F.col(f"y_{m}").alias("Actual"), F.col(f"e_{m}").alias("AbsError"),
                       nothing.alias("Pinball")) for m in MODELS]
    quantiles = [F.struct(F.lit(f"q{q}").alias("Model"), F.col("n_mean").alias("Days"),
                          F.col("y_mean").alias("Actual"), nothing.alias("AbsError"),
                          F.col(f"p_{i}").alias("Pinball"))
                 for i, q in enumerate(test.quantiles)]
    return (sums.select("ItemLocationId", "Variant", "Horizon",
                        F.inline(F.array(*models, *quantiles)))
            .withColumn("Wape", ratio(F.col("AbsError"), F.col("Actual"))))


def errors_by_horizons(errors: DataFrame, groups: Mapping[str, tuple[int, int]],
                       keys: Sequence[str]) -> DataFrame:
    """Error sums of `forecast_errors` over groups of horizons (first, last), by any keys."""
    name = F.lit(None).cast("string")
    for label, (first, last) in groups.items():
        name = F.when(F.col("Horizon").between(first, last), F.lit(label)).otherwise(name)
    return (errors.withColumn("Horizons", name).where("Horizons is not null")
            .groupBy(*keys, "Variant", "Model", "Horizons")
            .agg(*[F.sum(c).alias(c) for c in ("Days", "Actual", "AbsError", "Pinball")])
            .withColumn("Wape", ratio(F.col("AbsError"), F.col("Actual"))))


def calibration(forecast: DataFrame, attributes: DataFrame, keys: Sequence[str],
                test: Backtest) -> DataFrame:
    """Coverage of every quantile and bias of the mean, by segment and horizon."""
    actual = F.col("Actual")
    return (
        forecast.where(actual.isNotNull() & F.col("Mean").isNotNull())
        .join(attributes, "ItemLocationId")
        .groupBy(*keys, "Variant", "Horizon")
        .agg(F.count(F.lit(1)).alias("Days"),
             *[F.avg(F.when(actual <= F.col(f"Q{i}"), 1.0).otherwise(0.0)).alias(f"Coverage{i}")
               for i in range(len(test.quantiles))],
             F.try_divide(F.sum(F.col("Mean") - actual), F.sum(actual)).alias("Bias")))
