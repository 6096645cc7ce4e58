"""Daily store x item facts derived from order lines and from event streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelftide.params import EVENTS_PARAMS, LINEITEM_PARAMS
from shelftide.sources.facts import RAW_SCHEMA

# Columns used from each table. A given schema spares the schema-reading job per file.
SCHEMAS = {
    "lineitem": "l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_brand string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _raw_columns(df: DataFrame) -> DataFrame:
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in RAW_SCHEMA])


def facts_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as daily facts: supplier = store, brand = item.

    Lines are combined to (day, supplier, brand) first, because the join to parts repeats
    day keys; only the combined rows meet the supplier attributes.
    """
    start = dt.datetime.combine(LINEITEM_PARAMS.start, dt.time())
    end = dt.datetime.combine(LINEITEM_PARAMS.end + dt.timedelta(days=1), dt.time())
    lines = (_table(spark, sf_dir, "lineitem")
             .where((F.col("l_shipdate") >= F.lit(start).cast("timestamp_ntz"))
                    & (F.col("l_shipdate") < F.lit(end).cast("timestamp_ntz"))))
    # Brands are "Brand#<number>"; the number keeps the grouping keys fixed-width.
    parts = _table(spark, sf_dir, "part").select(
        "p_partkey", F.expr("cast(substr(p_brand, 7) as int)").alias("BrandNo"))

    is_return = (F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.09)
    def signed(value: str):
        return F.sum(F.when(F.col("l_linenumber") <= 2, 0.0)
                     .when(is_return, -F.col(value)).otherwise(F.col(value)))

    daily = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("l_shipdate").cast("date").alias("TransDate"), "l_suppkey", "BrandNo")
        .agg(signed("l_quantity").alias("SalesQty"),
             signed("l_extendedprice").alias("SalesAmount"),
             F.max(F.when((F.col("l_linestatus") == "O") | (F.col("l_linenumber") == 1), 1)
                   .otherwise(0)).alias("isMatrix"),
             (F.min("l_linenumber") - 1).cast("double").alias("StockStartQty"),
             (F.max("l_linenumber") - 1).cast("double").alias("StockEndQty")))

    stores = (
        _table(spark, sf_dir, "supplier")
        .join(_table(spark, sf_dir, "nation"),
              F.col("s_nationkey") == F.col("n_nationkey"))
        .join(_table(spark, sf_dir, "region"),
              F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", F.col("r_name").alias("LocationNetwork"),
                F.col("n_name").alias("LocationFormatTT")))

    return _raw_columns(
        daily.join(stores, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .select(
            "TransDate", F.col("l_suppkey").cast("string").alias("LocationId"),
            F.concat(F.lit("Brand#"), F.col("BrandNo")).alias("ItemId"),
            (F.col("l_suppkey") * 100 + F.col("BrandNo")).alias("ItemLocationId"),
            "isMatrix", "StockStartQty", "StockEndQty", "SalesQty", "SalesAmount",
            "LocationNetwork", "LocationFormatTT",
            F.when(F.col("BrandNo") % 5 == 0, "pack").when(F.col("BrandNo") % 2 == 1, "kg")
            .otherwise("pcs").alias("ItemMeasure"),
            F.lit("L1").alias("ItemIdLevel1"),
            F.concat(F.lit("L2-"), F.col("BrandNo") % 4).alias("ItemIdLevel2"),
            F.concat(F.lit("L3-"), F.col("BrandNo") % 8).alias("ItemIdLevel3")))


def facts_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as daily facts: user = store, event type = item; dense short series."""
    start = dt.datetime.combine(EVENTS_PARAMS.start, dt.time())
    end = dt.datetime.combine(EVENTS_PARAMS.end + dt.timedelta(days=1), dt.time())
    # Fixed order of the event types: the item's position in its pair id.
    position = F.array_position(
        F.array(*[F.lit(t) for t in ("click", "error", "purchase", "signup", "view")]),
        F.col("event_type"))
    sold = F.sum(F.when(F.col("event_type") == "error", 0.0).otherwise(F.col("value")))
    return _raw_columns(
        _table(spark, sf_dir, "events")
        .where((F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
               & (F.col("ts") < F.lit(end).cast("timestamp_ntz")))
        .groupBy(F.col("ts").cast("date").alias("TransDate"), "user_id", "event_type")
        .agg(sold.alias("SalesQty"), (sold * 2).alias("SalesAmount"),
             F.count(F.lit(1)).cast("double").alias("StockStartQty"),
             (F.count(F.lit(1)) - 1).cast("double").alias("StockEndQty"),
             F.max(F.when(F.col("event_id") % 4 != 0, 1).otherwise(0)).alias("isMatrix"))
        .select(
            "TransDate", F.col("user_id").cast("string").alias("LocationId"),
            F.col("event_type").alias("ItemId"),
            (F.col("user_id") * 10 + position).alias("ItemLocationId"),
            "isMatrix", "StockStartQty", "StockEndQty", "SalesQty", "SalesAmount",
            F.concat(F.lit("N"), F.col("user_id") % 3).alias("LocationNetwork"),
            F.concat(F.lit("F"), F.col("user_id") % 5).alias("LocationFormatTT"),
            F.col("event_type").alias("ItemMeasure"),
            F.lit("E1").alias("ItemIdLevel1"), F.lit("E2").alias("ItemIdLevel2"),
            F.lit("E3").alias("ItemIdLevel3")))


def hierarchy_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region -> nation -> supplier as an edge list with prefixed ids."""
    def edges(name: str, node: str, parent: str, title: str) -> DataFrame:
        return _table(spark, sf_dir, name).selectExpr(
            f"{node} as NodeId", f"{parent} as ParentId", f"{title} as NodeName")

    return (
        edges("region", "concat('R', r_regionkey)", "cast(null as string)", "r_name")
        .unionByName(edges("nation", "concat('N', n_nationkey)", "concat('R', n_regionkey)",
                           "n_name"))
        .unionByName(edges("supplier", "concat('S', s_suppkey)", "concat('N', s_nationkey)",
                           "s_name")))
