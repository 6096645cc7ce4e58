"""Checks of baseline forecasts: no leakage, sane values, full horizon."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from shelftide.checks.journal import check, rows_of, text
from shelftide.functions import labels
from shelftide.operators.baselines import MODELS, Backtest


def forecast_checks(forecast: DataFrame, test: Backtest) -> list[DataFrame]:
    c = F.col
    quantiles = [c(f"Q{i}") for i in range(len(test.quantiles))]
    negative = reduce(lambda a, b: a | b, [
        F.coalesce(v < 0, F.lit(False)) for v in [c(n) for n in MODELS.values()] + quantiles])
    crossed = reduce(lambda a, b: a | b, [
        F.coalesce(low > high, F.lit(False)) for low, high in zip(quantiles, quantiles[1:])],
        F.lit(False))
    # Map-side combine to one row per origin before the totals.
    origins = forecast.groupBy("ItemLocationId", "Variant", "Origin").agg(
        F.count(F.lit(1)).alias("Rows"),
        F.bit_or(F.expr("shiftleft(1, Horizon - 1)")).alias("Seen"),
        *[F.sum(F.when(cond, 1).otherwise(0)).alias(n) for n, cond in (
            ("Leaks", c("LastUsed") >= c("Origin")), ("Negative", negative),
            ("Crossed", crossed))],
        F.max(F.when(c("Mean").isNull(), 1).otherwise(0)).alias("Short"))
    every = (1 << test.horizon) - 1
    zero = F.lit(0)
    totals = origins.agg(
        *[F.coalesce(F.sum(n), zero).alias(n) for n in ("Leaks", "Negative", "Crossed", "Short")],
        F.coalesce(F.sum(F.when((c("Seen") != every) | (c("Rows") != test.horizon), 1)
                         .otherwise(0)), zero).alias("Partial"))
    def counted(name: str, column: str, words: str, level: str = labels.ERROR):
        return check(f"forecast_{name}", level, c(column), text(f"{words}: ", c(column)))
    return [rows_of(totals, [
        counted("no_leakage", "Leaks", "rows built from the origin day or later"),
        counted("not_negative", "Negative", "rows with a negative forecast"),
        counted("quantiles_monotone", "Crossed", "rows whose quantiles cross"),
        counted("full_horizon", "Partial", "origins without every horizon day"),
        counted("short_history", "Short", "origins with too little history", labels.WARNING)])]
