"""Raw daily facts: schema, reading, normalisation, same-day roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelftide.functions.expressions import flag
from shelftide.params import Params

RAW_SCHEMA = T.StructType([
    T.StructField("TransDate", T.DateType()),
    T.StructField("LocationId", T.StringType()),
    T.StructField("ItemId", T.StringType()),
    T.StructField("ItemLocationId", T.LongType()),
    T.StructField("isMatrix", T.IntegerType()),
    T.StructField("StockStartQty", T.DoubleType()),
    T.StructField("StockEndQty", T.DoubleType()),
    T.StructField("SalesQty", T.DoubleType()),
    T.StructField("SalesAmount", T.DoubleType()),
    T.StructField("LocationNetwork", T.StringType()),
    T.StructField("LocationFormatTT", T.StringType()),
    T.StructField("ItemMeasure", T.StringType()),
    T.StructField("ItemIdLevel1", T.StringType()),
    T.StructField("ItemIdLevel2", T.StringType()),
    T.StructField("ItemIdLevel3", T.StringType()),
    T.StructField("SalesByLevel1Qty", T.DoubleType()),
    T.StructField("SalesByLevel2Qty", T.DoubleType()),
    T.StructField("SalesByLevel3Qty", T.DoubleType()),
    T.StructField("SalesByLocationAmount", T.DoubleType()),
])


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def in_period(params: Params) -> Column:
    """Both ends of the period are inclusive; plain column comparison, so it is pushed down."""
    return F.col("TransDate").between(F.lit(params.start), F.lit(params.end))


def clean_measure() -> Column:
    return F.trim(F.coalesce(F.col("ItemMeasure"), F.lit("")))


def _required(name: str) -> Column:
    value = F.col(name)
    return (F.when(value.isNotNull(), value)
            .otherwise(F.raise_error(F.lit(f"null {name} in raw facts")).cast("bigint"))
            .alias(name))


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")).alias(name)


def normalise(raw: DataFrame, params: Params) -> DataFrame:
    """Raw rows of the period in profile measures, without nulls and with returns zeroed.

    A return (negative quantity) loses quantity and amount but keeps its row: its stock and
    matrix mark are right, and dropping it would leave a false gap in the series.
    """
    def number(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0.0)).cast("double")

    is_return = number("SalesQty") < 0
    return (
        raw.where(in_period(params))
        .where(clean_measure().isin(params.measures))
        .select(
            "TransDate", _required("ItemLocationId"), _text("LocationId"), _text("ItemId"),
            clean_measure().alias("ItemMeasure"),
            _text("ItemIdLevel2"), _text("ItemIdLevel3"),
            _text("LocationNetwork"), _text("LocationFormatTT"),
            F.coalesce(F.col("isMatrix"), F.lit(0)).cast("int").alias("IsMatrix"),
            number("StockStartQty").alias("StockStartQty"),
            number("StockEndQty").alias("StockEndQty"),
            F.when(is_return, 0.0).otherwise(number("SalesQty")).alias("SalesQty"),
            F.when(is_return, 0.0).otherwise(number("SalesAmount")).alias("SalesAmount"),
            flag(is_return).alias("IsReturn")))


ROLLUPS = {
    "SalesByLevel1Qty": ("SalesQty", ("ItemIdLevel1", "ItemMeasure")),
    "SalesByLevel2Qty": ("SalesQty", ("ItemIdLevel2", "ItemMeasure")),
    "SalesByLevel3Qty": ("SalesQty", ("ItemIdLevel3", "ItemMeasure")),
    "SalesByLocationAmount": ("SalesAmount", ()),
}


def with_rollups(raw: DataFrame, names: Sequence[str] = tuple(ROLLUPS)) -> DataFrame:
    """Add same-day roll-ups by store, and by store, group level and measure.

    Aggregate and join back rather than a window: the sums are combined before the shuffle
    and a store-day with very many items never sits in one task.
    """
    out = raw
    for name in names:
        value, keys = ROLLUPS[name]
        on = ["TransDate", "LocationId", *keys]
        out = out.drop(name).join(raw.groupBy(*on).agg(F.sum(value).alias(name)), on, "left")
    return out.select(*RAW_SCHEMA.names)
