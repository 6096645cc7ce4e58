"""Fingerprint of the data behind a report: one row of counts and a content hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelftide.functions import labels


#: Half the 60 bits of a row's mark. Halves are added up as whole numbers, far from overflow in one file.
_HALF = 30


def _as_text(df: DataFrame, column: str) -> Column:
    """A value as text that any engine writes alike; a null stays null."""
    value, kind = F.col(f"`{column}`"), df.schema[column].dataType.typeName()
    if kind in ("double", "float"):
        # Millionths as a whole number, which is far cheaper to write than a decimal.
        return F.coalesce(F.rint(value * 1e6).try_cast("bigint").cast("string"), value.cast("string"))
    if kind == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{column}`)").cast("string")
    if kind == "timestamp":
        return F.unix_micros(value).cast("string")
    return value.cast("string")


def _row_mark(texts: Sequence[Column]) -> Column:
    """The first 60 bits of the digest of a row's texts, each with its length; a null is marked as such."""
    marked = [F.coalesce(F.concat(F.lit("v"), F.length(t), F.lit(":"), t), F.lit("n")) for t in texts]
    return F.conv(F.substring(F.md5(F.concat(*marked)), 1, 15), 16, 10).cast("bigint")


def _added_up(mark: Column) -> Column:
    high = F.sum(F.shiftright(mark, _HALF)).cast("decimal(38,0)")
    low = F.sum(mark.bitwiseAND(F.lit((1 << _HALF) - 1)))
    return (high * F.lit(1 << _HALF).cast("decimal(11,0)") + low).cast("decimal(38,0)")


def content_mark(df: DataFrame, columns: list[str]) -> Column:
    """Order-independent mark of the rows, an aggregate: the marks of the rows added up."""
    return F.coalesce(_added_up(_row_mark([_as_text(df, c) for c in columns])), F.lit(0)).cast("string")


def row_marks(df: DataFrame, columns: list[str], *keep: Column) -> DataFrame:
    """The marks of the rows as `RowMark` beside the named columns `keep`.

    Texts are columns of a step of their own: in one expression each would be written out anew for every
    use, in a method too long for the JVM to compile.
    """
    names = [f"__text{i}" for i in range(len(columns))]
    texts = df.select(*keep, *[_as_text(df, c).alias(n) for c, n in zip(columns, names)])
    return texts.select(*texts.columns[:len(keep)], _row_mark([F.col(n) for n in names]).alias("RowMark"))


def source_mark(raw_in_period: DataFrame, columns: list[str]) -> DataFrame:
    """Files, bytes, rows and content mark in one scan: partial sums by file, then over the files."""
    per_file = (
        row_marks(raw_in_period, columns, F.col("_metadata.file_path").alias("File"),
                  F.col("_metadata.file_size").alias("FileSize"))
        .groupBy("File")
        .agg(F.max("FileSize").alias("Bytes"), F.count(F.lit(1)).alias("Rows"),
             _added_up(F.col("RowMark")).alias("Mark")))
    return per_file.agg(
        F.count(F.lit(1)).alias("SrcFiles"), F.coalesce(F.sum("Bytes"), F.lit(0)).alias("SrcBytes"),
        F.coalesce(F.sum("Rows"), F.lit(0)).alias("SrcRows"),
        F.coalesce(F.sum("Mark"), F.lit(0)).cast("string").alias("SrcHash"))


def fingerprint(raw_in_period: DataFrame, day_layer: DataFrame, base_layer: DataFrame,
                pair_column: str = "ItemLocationId") -> DataFrame:
    """Counts of the raw rows of the period (before the measure filter) and of the layers."""
    columns = raw_in_period.columns
    source = source_mark(raw_in_period, columns)
    source_pairs = raw_in_period.agg(F.count_distinct(pair_column).alias("SrcPairs"))
    return (
        source.crossJoin(source_pairs)
        .crossJoin(layer_counts(day_layer, base_layer)))


def layer_counts(day_layer: DataFrame, base_layer: DataFrame) -> DataFrame:
    """Row and pair counts of the layers; each side is a single aggregated row."""
    day_pairs = day_layer.groupBy("ItemLocationId").agg(
        F.count(F.lit(1)).alias("n"), F.min("TransDate").alias("lo"),
        F.max("TransDate").alias("hi"))
    base_pairs = base_layer.groupBy("ItemLocationId").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when((F.col("Variant") == labels.SALES) & (F.col("IsEmpty") == 1), 1)
              .otherwise(0)).alias("empty"))
    return (
        day_pairs.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("DayRows"),
            F.count(F.lit(1)).alias("DayPairs"),
            F.min("lo").cast("string").alias("DayFirst"),
            F.max("hi").cast("string").alias("DayLast"))
        .crossJoin(base_pairs.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("BaseRows"),
            F.count(F.lit(1)).alias("BasePairs"),
            F.coalesce(F.sum("empty"), F.lit(0)).alias("BaseEmptyPairs"))))
