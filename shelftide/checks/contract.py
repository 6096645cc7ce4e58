"""Contract of the raw facts: one journal row per rule."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelftide.checks.journal import check, relative_gap, rows_of, text
from shelftide.functions import labels
from shelftide.params import Params
from shelftide.session import materialise
from shelftide.sources.facts import RAW_SCHEMA, clean_measure, in_period

KEY = ("TransDate", "LocationId", "ItemId", "ItemLocationId")
FILLED = ("ItemMeasure", "ItemIdLevel1", "ItemIdLevel2", "ItemIdLevel3", "LocationNetwork",
          "LocationFormatTT")


@dataclass(frozen=True)
class ContractRules:
    """Fixed values of the contract that are not run parameters."""
    top_group: str
    median_days: int = 28
    corridor: tuple[float, float] = (0.5, 1.5)
    known_events: Sequence[dt.date] = ()
    stock_tolerance: float = 1e-6
    sum_tolerance: float = 1e-9


def schema_mismatches(raw: DataFrame) -> list[str]:
    """Columns that are absent, unexpected or of another type."""
    want = {f.name: f.dataType for f in RAW_SCHEMA}
    have = {f.name: f.dataType for f in raw.schema}
    return sorted(n for n in want.keys() | have.keys() if want.get(n) != have.get(n))


def _bad(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0))


def _places(rows: DataFrame, params: Params, rules: ContractRules) -> DataFrame:
    """One row for each store x item x id: what its rows show on their own, and the range of the hashes of
    the attributes its item and store should keep. As many rows as pairs; all but the key rule, the
    calendar and the stock read no more than these."""
    qty = F.coalesce(F.col("SalesQty"), F.lit(0.0))
    amount = F.coalesce(F.col("SalesAmount"), F.lit(0.0))
    blank = [F.trim(F.coalesce(F.col(c), F.lit(""))) == "" for c in FILLED]
    any_blank, any_null = blank[0], F.col(KEY[0]).isNull()
    for other in blank[1:]:
        any_blank = any_blank | other
    for name in KEY[1:]:
        any_null = any_null | F.col(name).isNull()

    def kinds(name: str, *columns: str) -> list[Column]:
        # A null is a value of its own, so its mark is hashed beside it.
        mark = F.xxhash64(*[c for n in columns for c in (F.col(n).isNull(), F.col(n))])
        return [F.min(mark).alias(f"{name}Low"), F.max(mark).alias(f"{name}High")]

    return rows.groupBy("LocationId", "ItemId", "ItemLocationId").agg(
        F.count(F.lit(1)).alias("Rows"),
        _bad(any_null).alias("NullKeys"),
        _bad(~F.col("ItemIdLevel1").eqNullSafe(F.lit(rules.top_group))).alias("OtherGroup"),
        _bad(F.col("StockEndQty") < 0).alias("NegativeStock"),
        _bad(any_blank).alias("BlankAttributes"),
        _bad(~clean_measure().isin(params.measures)).alias("UnknownMeasure"),
        _bad(qty < 0).alias("NegativeQty"),
        _bad((qty > 0) != (amount > 0)).alias("MoneyWithoutQty"),
        *kinds("Item", "ItemMeasure", "ItemIdLevel3"),
        *kinds("Store", "LocationNetwork", "LocationFormatTT"))


ROW_COUNTERS = ("Rows", "NullKeys", "OtherGroup", "NegativeStock", "BlankAttributes", "UnknownMeasure",
                "NegativeQty", "MoneyWithoutQty")


def _place_counters(places: DataFrame) -> DataFrame:
    """Sums of the rows' own faults, store x item against pair id both ways, and attributes that change."""
    one = F.count(F.lit(1)).alias("n")
    ids = places.groupBy("LocationId", "ItemId").agg(one).agg(_bad(F.col("n") > 1).alias("PairManyIds"))
    back = places.groupBy("ItemLocationId").agg(one).agg(_bad(F.col("n") > 1).alias("IdManyPairs"))

    def changing(owner: str, kind: str) -> DataFrame:
        return (places.groupBy(owner).agg(F.min(f"{kind}Low").alias("low"), F.max(f"{kind}High").alias("high"))
                .agg(_bad(F.col("low") != F.col("high")).alias(f"{kind}Changed")))

    sums = places.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ROW_COUNTERS])
    return (sums.crossJoin(ids).crossJoin(back).crossJoin(changing("ItemId", "Item"))
            .crossJoin(changing("LocationId", "Store")))


def _key_counters(rows: DataFrame) -> DataFrame:
    keys = rows.groupBy("TransDate", "LocationId", "ItemId").agg(F.count(F.lit(1)).alias("n"))
    return keys.agg(_bad(F.col("n") > 1).alias("RepeatedKeys"))


def _store_and_item_days(rows: DataFrame) -> DataFrame:
    """Rows and amounts of every store day (ofStore 1) and rows of every item day (ofStore 0), in one pass."""
    stored = F.col("SalesByLocationAmount")
    return rows.groupingSets(
        [["TransDate", "LocationId"], ["TransDate", "ItemId"]], "TransDate", "LocationId", "ItemId").agg(
        (1 - F.grouping("LocationId")).cast("int").alias("ofStore"), F.count(F.lit(1)).alias("n"),
        F.sum("SalesAmount").alias("Total"), F.min(stored).alias("Low"), F.max(stored).alias("High"))


def _missing_days(rows: DataFrame, params: Params) -> DataFrame:
    wanted = rows.sparkSession.range(1).select(F.explode(F.sequence(
        F.lit(params.start), F.lit(params.end), F.expr("interval 1 day"))).alias("TransDate"))
    missing = wanted.join(rows.select("TransDate").distinct(), "TransDate", "left_anti")
    month = F.trunc("TransDate", "month")
    months = (wanted.select(month.alias("m")).distinct()
              .join(rows.select(month.alias("m")).distinct(), "m", "left_anti"))
    return (missing.agg(F.count(F.lit(1)).alias("MissingDays"))
            .crossJoin(months.agg(F.count(F.lit(1)).alias("MissingMonths"))))


def _stock_breaks(rows: DataFrame, rules: ContractRules) -> DataFrame:
    """Morning stock against the evening of the day before, where that day has a row."""
    by_day = Window.partitionBy("ItemLocationId").orderBy("TransDate")
    gap = F.abs(F.col("StockStartQty") - F.lag("StockEndQty").over(by_day))
    follows = F.datediff("TransDate", F.lag("TransDate").over(by_day)) == 1
    return (rows.select((follows & (gap > rules.stock_tolerance)).alias("Broken"))
            .agg(_bad(F.col("Broken")).alias("StockBreaks")))


def _rollup_breaks(days: DataFrame, rules: ContractRules) -> DataFrame:
    """The stored store-day amount against the sum of its rows."""
    off = (F.col("Low").isNull()
           | (relative_gap(F.col("Low"), F.col("Total")) > rules.sum_tolerance)
           | (relative_gap(F.col("High"), F.col("Total")) > rules.sum_tolerance))
    return days.where("ofStore = 1").agg(_bad(off).alias("RollupBreaks"))


def daily_volume(rows: DataFrame) -> DataFrame:
    """Rows, stores and items of every day, without distinct aggregates."""
    return _volume_of(_store_and_item_days(rows))


def _volume_of(days: DataFrame) -> DataFrame:
    of_store = F.col("ofStore") == 1
    return days.groupBy("TransDate").agg(
        F.sum(F.when(of_store, F.col("n"))).alias("DayRows"), F.count_if(of_store).alias("Stores"),
        F.count_if(~of_store).alias("Items"))


def volume_outliers(volume: DataFrame, rules: ContractRules) -> DataFrame:
    """Days whose volume leaves the corridor around the median of the days before. The
    window runs over one row per calendar day."""
    seen = volume.withColumn("DayNo", F.datediff("TransDate", F.lit(dt.date(1970, 1, 1))))
    before = Window.orderBy("DayNo").rangeBetween(-rules.median_days, -1)
    low, high = rules.corridor
    out = None
    for name in ("DayRows", "Stores", "Items"):
        share = F.try_divide(F.col(name).cast("double"),
                             F.percentile(name, F.lit(0.5)).over(before))
        outside = F.coalesce(~share.between(low, high), F.lit(False))
        out = outside if out is None else out | outside
    days = seen.select("TransDate", out.alias("Outside")).where("Outside").select("TransDate")
    if rules.known_events:
        days = days.where(~F.col("TransDate").isin(list(rules.known_events)))
    return days


def contract_checks(raw: DataFrame, params: Params, rules: ContractRules,
                    files: DataFrame | None = None) -> list[DataFrame]:
    """One journal row per rule. With `files`, the raw facts as read from their files, also whether each month of
    the period has one."""
    mismatched = schema_mismatches(raw)
    rows = raw.where(in_period(params))
    places = materialise(_places(rows, params, rules), "places")
    days = materialise(_store_and_item_days(rows), "store-and-item-days")
    totals = (
        _place_counters(places).crossJoin(_key_counters(rows))
        .crossJoin(_missing_days(days, params))
        .crossJoin(_stock_breaks(rows, rules))
        .crossJoin(_rollup_breaks(days, rules))
        .crossJoin(volume_outliers(_volume_of(days), rules)
                   .agg(F.count(F.lit(1)).alias("VolumeDays"))))

    if files is not None:
        totals = totals.crossJoin(months_without_file(files, params).agg(
            F.count(F.lit(1)).alias("MonthsWithoutFile")))

    def counted(name: str, column: str, words: str, level: str = labels.ERROR) -> Column:
        return check(f"contract_{name}", level, F.col(column), text(f"{words}: ", F.col(column)))

    return [rows_of(totals, [
        check("contract_schema", labels.ERROR, F.lit(len(mismatched)),
              text("columns that differ: ", ", ".join(mismatched) or "none")),
        counted("key_unique", "RepeatedKeys", "repeated day x store x item keys"),
        counted("key_filled", "NullKeys", "rows with an empty key column"),
        check("contract_pair_id", labels.ERROR, F.col("PairManyIds") + F.col("IdManyPairs"),
              text("pairs with several ids ", F.col("PairManyIds"), ", ids of several pairs ",
                   F.col("IdManyPairs"))),
        check("contract_calendar", labels.ERROR,
              F.col("MissingDays") + F.col("MissingMonths"),
              text("days without rows ", F.col("MissingDays"), ", months without rows ",
                   F.col("MissingMonths"))),
        counted("top_group", "OtherGroup", "rows outside the top group"),
        counted("stock_continuity", "StockBreaks", "mornings unlike the evening before"),
        counted("stock_not_negative", "NegativeStock", "rows with negative evening stock"),
        counted("attributes_filled", "BlankAttributes", "rows with a blank attribute"),
        counted("item_constant", "ItemChanged", "items with several measures or subgroups",
                labels.WARNING),
        counted("store_constant", "StoreChanged", "stores with several networks or formats",
                labels.WARNING),
        counted("measure_known", "UnknownMeasure", "rows whose measure has no branch",
                labels.WARNING),
        counted("qty_not_negative", "NegativeQty", "rows with negative quantity",
                labels.WARNING),
        counted("qty_and_amount", "MoneyWithoutQty", "rows with only one of quantity and amount",
                labels.WARNING),
        counted("store_rollup", "RollupBreaks", "store-days whose roll-up is not their sum",
                labels.WARNING),
        counted("daily_volume", "VolumeDays", "days outside the volume corridor",
                labels.WARNING),
        *([counted("file_per_month", "MonthsWithoutFile", "months without a file")] if files is not None else []),
    ])]


def months_without_file(raw_files: DataFrame, params: Params) -> DataFrame:
    """Months of the period that no file of the raw folder covers (file sources only)."""
    covered = (raw_files.where(in_period(params))
               .groupBy(F.trunc("TransDate", "month").alias("Month"))
               .agg(F.max(F.col("_metadata.file_modification_time")).alias("Seen")))
    wanted = raw_files.sparkSession.range(1).select(F.explode(F.sequence(
        F.trunc(F.lit(params.start), "month"), F.lit(params.end),
        F.expr("interval 1 month"))).alias("Month"))
    return wanted.join(covered, "Month", "left_anti")
