"""Layer sinks and delimited-text / JSON-lines exchange."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

CODEC = "zstd"


def write_layer(df: DataFrame, path: str, keys: Sequence[str],
                globally: bool = False) -> DataFrame:
    """Write a layer as zstd parquet sorted by its key and return it as read back.

    Rows are sorted inside the partitions they are already in: layers come out of a join or
    a grouping on their key, so its rows lie together without another shuffle. `globally`
    adds a range exchange (and its sampling pass over the plan) for an order across files.
    Overwriting drops the old files before the job, so a failed stage leaves no stale layer.
    """
    placed = df.repartitionByRange(*keys) if globally else df
    (placed.sortWithinPartitions(*keys)
     .write.mode("overwrite").option("compression", CODEC).parquet(path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int,
                   order: Sequence[str]) -> DataFrame:
    """Write a layer bucketed by its key: later groupings and joins on the key need no
    shuffle. Rows hashed on the key into `buckets` partitions beforehand give one file per
    bucket."""
    (df.write.mode("overwrite").format("parquet")
     .option("compression", CODEC).option("path", path)
     .bucketBy(buckets, key).sortBy(*order).saveAsTable(table))
    return df.sparkSession.table(table)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    try:
        spark.read.text(f"{path}/_SUCCESS").schema  # hidden from listings, readable by name
        return spark.read.parquet(path)
    except AnalysisException as missing:
        raise FileNotFoundError(f"layer {path} is not built; build it first") from missing


#: How a null is written; a text of just this control character would be read as null.
NULL_TEXT = "\x01"


def _text_options(delimiter: str) -> dict[str, object]:
    """One set of options for writing and reading: line breaks and quotes stay inside quoted
    fields, an empty text is quoted, a null has its own mark, and a bare empty field is null too."""
    return {"sep": delimiter, "quote": '"', "escape": '"', "multiLine": True,
            "nullValue": NULL_TEXT, "ignoreLeadingWhiteSpace": False,
            "ignoreTrailingWhiteSpace": False, "lineSep": "\n"}


def write_text(df: DataFrame, path: str, delimiter: str = ";", header: bool = True) -> None:
    options = _text_options(delimiter)
    options.pop("multiLine")  # an option of readers only
    df.write.mode("overwrite").options(**options, emptyValue='""', header=header).csv(path)


def write_text_with_types(df: DataFrame, path: str, delimiter: str = ";") -> None:
    """Named columns plus their types. The types go beside the data as one schema file:
    many writers cannot share a second header line."""
    write_text(df, path, delimiter)
    spark = df.sparkSession
    spark.createDataFrame([(df.schema.json(),)], "schema string").coalesce(1).write.mode(
        "overwrite").text(f"{path}_schema")


def read_text_with_types(spark: SparkSession, path: str, delimiter: str = ";") -> DataFrame:
    line = spark.read.text(f"{path}_schema").first()[0]
    return read_text(spark, path, T.StructType.fromJson(json.loads(line)),
                     delimiter)


def read_text(spark: SparkSession, path: str, schema: T.StructType, delimiter: str = ";",
              header: bool = True) -> DataFrame:
    """Delimited text by column name: extra fields of the file are skipped, absent ones are
    null. Without a header the columns are taken by position."""
    if not header:
        return spark.read.schema(schema).options(**_text_options(delimiter)).csv(path)
    named = spark.read.options(**_text_options(delimiter), header=True).csv(path)
    present = set(named.columns)
    return named.select(*[
        (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType)
        .alias(f.name) for f in schema])


def discard(df: DataFrame) -> None:
    """Run the plan and drop its rows."""
    df.write.format("noop").mode("overwrite").save()


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path, ignoreNullFields=False)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def literal_rows(spark: SparkSession, rows: Sequence, schema: T.StructType) -> DataFrame:
    """Small typed literal table (fixtures, dictionaries)."""
    return spark.createDataFrame(list(rows), schema)
