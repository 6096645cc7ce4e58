"""Checks journal: every check is a value against a threshold."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F

from shelftide.functions import labels

JOURNAL_COLUMNS = ("CheckName", "Level", "Value", "Threshold", "Status", "Details", "RunAt")


class CheckFailed(ValueError):
    """An error-level check did not pass, or nothing was checked at all."""


def check(name: str | Column, level: str, value: Column, details: Column,
          threshold: float = 0.0) -> Column:
    """One check as a struct, computed from a row of totals."""
    name = F.lit(name) if isinstance(name, str) else name
    return F.struct(
        name.alias("CheckName"), F.lit(level).alias("Level"),
        value.cast("double").alias("Value"),
        F.lit(float(threshold)).alias("Threshold"), details.alias("Details"))


def text(*parts) -> Column:
    """Concatenate literals and columns into the details of a check."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def rows_of(totals: DataFrame, checks: Sequence[Column]) -> DataFrame:
    """Unfold the checks of every totals row; the totals are aggregated only once."""
    return totals.select(F.explode(F.array(*checks)).alias("c")).select("c.*")


def assemble(parts: Sequence[DataFrame], run_at: dt.datetime | None = None) -> DataFrame:
    """Journal of all checks: failures first, then warnings, then the rest by name."""
    body = reduce(DataFrame.unionByName, parts)
    rank = (F.when(F.col("Status") == labels.ERROR, 0)
            .when(F.col("Status") == labels.WARNING, 1).otherwise(2))
    stamp = (run_at or dt.datetime.now()).strftime("%Y-%m-%d %H:%M:%S")
    return (
        body
        .withColumn("Status", F.when(F.col("Value") <= F.col("Threshold"), labels.OK)
                    .otherwise(F.col("Level")))
        .withColumn("RunAt", F.lit(stamp))
        .orderBy(rank, "CheckName").select(*JOURNAL_COLUMNS))


def enforce(journal: DataFrame, layer: str) -> list[Row]:
    """The journal's rows (a few tens), if there are any and none of them is an error."""
    rows = journal.collect()
    failed = {r.CheckName: r.Details for r in rows if r.Status == labels.ERROR}
    if failed or not rows:
        raise CheckFailed("\n".join(
            [f"{layer}: {len(failed)} of {len(rows)} checks failed"
             if rows else f"{layer}: nothing was checked, its journal is empty",
             *[f"  {name}: {details}" for name, details in sorted(failed.items())]]))
    return rows


def relative_gap(value: Column, expected: Column) -> Column:
    return F.abs(value - expected) / F.greatest(F.abs(expected), F.lit(1.0))
