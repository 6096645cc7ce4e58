"""Life cycle of a pair: matrix runs and the ramp-up to a stable level."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def matrix_runs(day_layer: DataFrame) -> DataFrame:
    """Unbroken stretches of matrix days of a pair: how often it entered, the longest stay.

    A calendar day without a row is outside the matrix, so a gap ends the stretch.
    """
    by_day = Window.partitionBy("ItemLocationId").orderBy("TransDate")
    marked = (
        day_layer.where((F.col("IsMatrix") == 1) & (F.col("InLife") == 1))
        .select("ItemLocationId", "TransDate", F.coalesce(
            F.datediff("TransDate", F.lag("TransDate").over(by_day)) > 1, F.lit(True))
            .cast("int").alias("Starts")))
    runs = (
        marked.withColumn("Run", F.sum("Starts").over(
            by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy("ItemLocationId", "Run").agg(F.count(F.lit(1)).alias("Days")))
    return runs.groupBy("ItemLocationId").agg(
        F.count(F.lit(1)).alias("Runs"), F.sum("Days").alias("MatrixDays"),
        F.max("Days").alias("LongestRun"))


def matrix_entries(day_layer: DataFrame, keys: Sequence[str], start: dt.date, end: dt.date) -> DataFrame:
    """Entries into the matrix, exits from it and pairs on it, for every segment and day of the period.

    A sweep over the ends of the pairs' unbroken stretches: +1 on a stretch's first day, -1 on the day behind
    its last one, added up by segment and day; a running total over the days of the calendar is the number of
    pairs on the matrix. A stretch that begins on the first day counts as an entry of that day.
    """
    by_day = Window.partitionBy("ItemLocationId").orderBy("TransDate")
    inside = day_layer.where((F.col("IsMatrix") == 1) & (F.col("InLife") == 1)
                             & F.col("TransDate").between(F.lit(start), F.lit(end)))
    day = F.col("TransDate")
    ends = inside.select(
        *keys, "TransDate",
        F.coalesce(F.datediff(day, F.lag(day).over(by_day)) > 1, F.lit(True)).cast("int").alias("Starts"),
        F.coalesce(F.datediff(F.lead(day).over(by_day), day) > 1, F.lit(True)).cast("int").alias("Ends"))
    changes = (
        ends.where("Starts = 1 or Ends = 1")
        .select(*keys, F.inline(F.array(
            F.struct(day.alias("TransDate"), F.col("Starts").alias("In"), F.lit(0).alias("Out")),
            F.struct(F.date_add(day, 1).alias("TransDate"), F.lit(0).alias("In"), F.col("Ends").alias("Out")))))
        .groupBy(*keys, "TransDate").agg(F.sum("In").alias("In"), F.sum("Out").alias("Out")))
    calendar = inside.select(*keys).distinct().withColumn(
        "TransDate", F.explode(F.sequence(F.lit(start), F.lit(end))))
    # One row for a day of the calendar: the window over a segment is bounded by the period.
    so_far = Window.partitionBy(*keys).orderBy("TransDate").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    zero = F.lit(0).cast("bigint")
    return (
        calendar.join(changes, [*keys, "TransDate"], "left")
        .select(*keys, "TransDate", F.coalesce("In", zero).alias("Entries"), F.coalesce("Out", zero).alias("Exits"))
        .withColumn("OnMatrix", F.sum(F.col("Entries") - F.col("Exits")).over(so_far)))


def ramp_up(day_layer: DataFrame, corridor: float = 0.25, smooth: int = 4,
            level_weeks: tuple[int, int] = (9, 16), born_from: dt.date | None = None) -> DataFrame:
    """First week from which the moving mean stays near the level of weeks 9-16 of life.

    With `born_from`, only of pairs whose life begins on that day or later: of those on sale when the facts
    begin, the true start is not known.

    Weeks become conditional sums of one aggregation, a fixed-length array per pair; pairs
    that did not live through the last of these weeks are left out.
    """
    first, last = level_weeks
    births = F.min(F.when(F.col("InLife") == 1, F.col("TransDate"))).over(
        Window.partitionBy("ItemLocationId"))
    weeks = (
        day_layer.where((F.col("IsEmpty") == 0) & (F.col("InLife") == 1))
        .select("ItemLocationId", "TransDate", "SalesQty", births.alias("Birth"))
        .where(F.lit(True) if born_from is None else F.col("Birth") >= F.lit(born_from))
        .withColumn("Week", F.floor(F.datediff("TransDate", "Birth") / 7).cast("int")))
    sums = weeks.groupBy("ItemLocationId").agg(
        F.max("Week").alias("LastWeek"),
        F.array(*[F.sum(F.when(F.col("Week") == w, F.col("SalesQty")).otherwise(0.0))
                  for w in range(last)]).alias("W"))

    def mean(values: Column, n: int) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / n

    moving = F.transform(F.sequence(F.lit(smooth), F.lit(last)),
                         lambda end: mean(F.slice("W", end - smooth + 1, smooth), smooth))
    inside = F.transform("Moving", lambda m: F.abs(m - F.col("Level"))
                         <= corridor * F.col("Level"))
    # Weeks after the last one outside the corridor are stable to the end.
    last_outside = F.array_max(F.transform("Inside", lambda ok, i: F.when(ok, 0).otherwise(i + 1)))
    return (
        sums.where(F.col("LastWeek") >= last - 1)
        .withColumn("Level", mean(F.slice("W", first, last - first + 1), last - first + 1))
        .withColumn("Moving", moving).withColumn("Inside", inside)
        .withColumn("Stable", last_outside)
        .select("ItemLocationId", "Level", F.when(
            (F.col("Level") > 0) & (F.col("Stable") < F.size("Moving")),
            F.col("Stable") + smooth).alias("StableWeek")))
