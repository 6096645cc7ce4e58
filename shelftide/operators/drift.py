"""Drift of the input: level against the same weekday, distribution shift, shares."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelftide.functions.expressions import ratio
from shelftide.operators.frontier import actual_point
from shelftide.operators.running import running_total
from shelftide.params import Params


def weekday_level(day_layer: DataFrame, keys: Sequence[str], weeks: int = 4) -> DataFrame:
    """Daily sales of a segment against the mean of the same weekday in the weeks before.
    The window runs over one row per segment and day."""
    daily = day_layer.groupBy(*keys, "TransDate").agg(F.sum("SalesQty").alias("Qty"))
    day = F.datediff("TransDate", F.lit(dt.date(1970, 1, 1)))
    before = Window.partitionBy(*keys, F.dayofweek("TransDate")).orderBy(day).rangeBetween(
        -7 * weeks, -7)
    return (daily.withColumn("Usual", F.avg("Qty").over(before))
            .withColumn("Level", ratio(F.col("Qty"), F.col("Usual"))))


def _window(base: tuple[dt.date, dt.date], recent: tuple[dt.date, dt.date]) -> Column:
    """Which window a day belongs to; other days belong to none."""
    day = F.col("TransDate")
    return (F.when(day.between(F.lit(base[0]), F.lit(base[1])), "base")
            .when(day.between(F.lit(recent[0]), F.lit(recent[1])), "recent"))


def population_stability(day_layer: DataFrame, value: str, edges: Sequence[float],
                         base: tuple[dt.date, dt.date], recent: tuple[dt.date, dt.date],
                         keys: Sequence[str], floor: float = 1e-4) -> DataFrame:
    """PSI of a column between two windows over fixed bins; an empty bin counts as `floor`."""
    bin_no = F.lit(0)
    for edge in edges:
        bin_no = bin_no + F.when(F.col(value) >= F.lit(float(edge)), 1).otherwise(0)
    counts = (
        day_layer.withColumn("Period", _window(base, recent))
        .where(F.col("Period").isNotNull() & F.col(value).isNotNull())
        .groupBy(*keys, bin_no.alias("Bin"))
        .agg(*[F.sum(F.when(F.col("Period") == p, 1).otherwise(0)).alias(p)
               for p in ("base", "recent")]))
    # Bins are few: windows and the sum below see at most len(edges) + 1 rows per segment.
    segment = Window.partitionBy(*keys)

    def share(p: str) -> Column:
        return F.greatest(F.try_divide(F.col(p).cast("double"),
                                       F.sum(p).over(segment).cast("double")), F.lit(floor))

    shares = counts.select(*keys, share("base").alias("b"), share("recent").alias("r"),
                           "base", "recent")
    return shares.groupBy(*keys).agg(
        F.sum("base").alias("BaseRows"), F.sum("recent").alias("RecentRows"),
        F.sum((F.col("r") - F.col("b")) * F.log(F.col("r") / F.col("b"))).alias("Psi"))


def window_shares(day_layer: DataFrame, base: tuple[dt.date, dt.date],
                  recent: tuple[dt.date, dt.date], keys: Sequence[str]) -> DataFrame:
    """Zero sales, deficit and out-of-matrix sales, and the mean price, by window."""
    observed = (F.col("IsMatrix") == 1) & (F.col("InLife") == 1)
    def days(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))
    return (
        day_layer.withColumn("Period", _window(base, recent))
        .where(F.col("Period").isNotNull()).groupBy(*keys, "Period")
        .agg(F.count_distinct("ItemLocationId").alias("Pairs"),
             ratio(days(observed & (F.col("SalesQty") == 0)), days(observed)).alias("ZeroShare"),
             ratio(days(observed & (F.col("IsDeficit") == 1)), days(observed))
             .alias("DeficitShare"),
             ratio(F.sum(F.when(F.col("IsMatrix") == 0, F.col("SalesQty")).otherwise(0.0)),
                   F.sum("SalesQty")).alias("OutMatrixShare"),
             ratio(F.sum("SalesAmount"), F.sum("SalesQty")).alias("Price")))


#: Windows that fit into the bits of one long value.
MAX_WINDOWS = 62


class MonthWindows:
    """Consecutive windows of whole months, numbered from 0; windows that hold a known event are no base of
    comparison, so the base of a window is the last one before it without an event."""

    def __init__(self, start: dt.date, months: int, count: int, known_events: Sequence[dt.date] = ()):
        if not 1 < count <= MAX_WINDOWS:
            raise ValueError(f"{count} windows, 2 to {MAX_WINDOWS} can be compared")
        self.first, self.months, self.count = start.year * 12 + start.month - 1, months, count
        self.known = {self._place(d) for d in known_events}
        bases = {w: [b for b in range(w) if b not in self.known] for w in range(count)}
        self.base = {w: b[-1] for w, b in bases.items() if b}

    def _place(self, day: dt.date) -> int:
        return (day.year * 12 + day.month - 1 - self.first) // self.months

    def start(self, window: int) -> dt.date:
        month = self.first + window * self.months
        return dt.date(month // 12, month % 12 + 1, 1)

    def number(self, day: str = "TransDate") -> Column:
        """The window of a day, NULL outside all of them."""
        w = F.floor((F.year(day) * 12 + F.month(day) - 1 - self.first) / self.months)
        return F.when((w >= 0) & (w < self.count), w).cast("int")

    def compared(self) -> list[Column]:
        """(Window, Base, both as days, and whether the window holds a known event) of every comparison."""
        return [F.struct(F.lit(w).alias("w"), F.lit(b).alias("b"), F.lit(self.start(w)).alias("Window"),
                         F.lit(self.start(b)).alias("Base"), F.lit(int(w in self.known)).alias("KnownEvent"))
                for w, b in self.base.items()]


def composition(day_layer: DataFrame, windows: MonthWindows) -> DataFrame:
    """Stores, items and pairs on the matrix by branch and window, against the window's base.

    One pass marks the windows of each pair as the bits of one value; the bits of stores and items are joined
    from those of their pairs, and every comparison reads them. `New` was never there before, `Returned` was,
    but not in the base; `Withdrawn` was in the base and is gone.
    """
    on_matrix = day_layer.where((F.col("IsMatrix") == 1) & (F.col("InLife") == 1)).withColumn("w", windows.number())
    pairs = on_matrix.where("w is not null").groupBy("Branch", "LocationId", "ItemId", "ItemLocationId").agg(
        F.bit_or(F.expr("shiftleft(1L, w)")).alias("Bits"))
    entities = F.inline(F.array(*[
        F.struct(F.lit(kind).alias("Entity"), F.col(c).cast("string").alias("Key"))
        for kind, c in (("store", "LocationId"), ("item", "ItemId"), ("pair", "ItemLocationId"))]))
    bits = (pairs.select("Branch", "Bits", entities).groupBy("Branch", "Entity", "Key")
            .agg(F.bit_or("Bits").alias("Bits")))
    rows = bits.select("Branch", "Entity", "Bits", F.inline(F.array(*windows.compared())))
    now, base = F.expr("shiftright(Bits, w) & 1L") == 1, F.expr("shiftright(Bits, b) & 1L") == 1
    earlier = F.expr("Bits & (shiftleft(1L, w) - 1L)") != 0

    def count(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    return (
        rows.groupBy("Branch", "Entity", "Window", "Base", "KnownEvent")
        .agg(count(now).alias("Present"), count(base).alias("InBase"), count(now & base).alias("Stayed"),
             count(now & ~earlier).alias("New"), count(now & ~base & earlier).alias("Returned"),
             count(base & ~now).alias("Withdrawn"))
        .withColumn("Turnover", ratio(F.col("New") + F.col("Returned") + F.col("Withdrawn"), F.col("InBase"))))


def target_windows(day_layer: DataFrame, params: Params, windows: MonthWindows, keys: Sequence[str],
                   availability: float, leftover: float) -> DataFrame:
    """Availability and leftover share of every window against their targets and against the base window."""
    points = actual_point(day_layer.withColumn("w", windows.number()).where("w is not null"), params, [*keys, "w"])
    was = points.select(*keys, F.col("w").alias("b"), F.col("Availability").alias("BaseAvailability"),
                        F.col("LeftoverShare").alias("BaseLeftoverShare"))
    return (
        points.withColumn("c", F.filter(F.array(*windows.compared()), lambda c: c["w"] == F.col("w")))
        .select("*", F.inline_outer(F.transform("c", lambda c: c.dropFields("w"))))
        .join(was, [*keys, "b"], "left")
        .withColumns({
            "AvailabilityMissed": (F.col("Availability") < availability).cast("int"),
            "LeftoverMissed": (F.col("LeftoverShare") > leftover).cast("int"),
            "AvailabilityChange": F.col("Availability") - F.col("BaseAvailability"),
            "LeftoverChange": F.col("LeftoverShare") - F.col("BaseLeftoverShare")})
        .where("Window is not null").drop("c", "w", "b", "AvailableDays", "Leftover", "Output"))


def distribution_distance(day_layer: DataFrame, value: str, windows: MonthWindows,
                          keys: Sequence[str]) -> DataFrame:
    """Wasserstein distance of a column between every window and its base, without bins.

    The rows are counted by value, each window's counts also standing as the base of those compared with it.
    Along the merged values the difference D of both running shares changes by a step at each of them; the
    area between the two curves is the sum of v * (|D before the step| - |D after it|). Steps are whole numbers
    (counts of one side times all rows of the other), so D comes back to zero exactly; running totals take
    segments of any size (`running`).
    """
    counts = (
        day_layer.withColumn("w", windows.number()).where(F.col("w").isNotNull() & F.col(value).isNotNull())
        .groupBy(*keys, "w", F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n")))
    roles = F.inline(F.filter(F.transform(F.array(*windows.compared()), lambda c: F.struct(
        c["Window"].alias("Window"), c["Base"].alias("Base"), c["KnownEvent"].alias("KnownEvent"),
        F.when(c["w"] == F.col("w"), F.col("n")).otherwise(0).alias("now"),
        F.when(c["b"] == F.col("w"), F.col("n")).otherwise(0).alias("was"))),
        lambda c: c["now"] + c["was"] > 0))
    on = [*keys, "Window", "Base", "KnownEvent"]
    merged = counts.select(*keys, "v", roles).groupBy(*on, "v").agg(
        F.sum("now").alias("now"), F.sum("was").alias("was"))
    totals = merged.groupBy(*on).agg(F.sum("now").alias("RecentRows"), F.sum("was").alias("BaseRows")).where(
        "RecentRows > 0 and BaseRows > 0")
    steps = merged.join(totals, on).withColumn("step", F.expr(
        "cast(cast(now as decimal(18,0)) * cast(BaseRows as decimal(18,0))"
        " - cast(was as decimal(18,0)) * cast(RecentRows as decimal(18,0)) as decimal(38,0))"))
    swept = running_total(steps, on, [F.col("v")], "step", "D")
    area = F.col("v") * (F.abs(F.col("D") - F.col("step")) - F.abs("D")).cast("double")
    return swept.groupBy(*on, "RecentRows", "BaseRows").agg(F.sum(area).alias("a")).withColumn(
        "Distance", F.col("a") / F.col("RecentRows") / F.col("BaseRows")).drop("a")
