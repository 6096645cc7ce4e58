"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows handled at a time inside a task, so that a worker's memory does not follow Spark's batch size.
ROWS = 1000
#: Bits of the filter over wanted rows, a fixed 4 MB; more rows only make it let more through.
FILTER_BITS = 1 << 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_columns(df: DataFrame, inputs: Sequence[str], added: str, start: Callable[[], Callable],
                 carry: Sequence[str] = ("doc_id",), rows: int = ROWS) -> DataFrame:
    """Add columns made in Python from ``inputs``, row by row in Arrow slices.

    ``start()`` runs once in a task and returns a function from the input columns (Arrow arrays)
    to the added columns; if that has an attribute ``finish``, it is called when the task is done. Only ``carry`` is kept of the other columns; an added column replaces a
    carried one of the same name (names match without case, as Spark resolves them).
    """
    fields = StructType.fromDDL(added)
    taken = {f.name.lower() for f in fields}
    kept = [c for c in carry if c.lower() not in taken]
    sent = df.select(*[column(c).alias(f"k{i}") for i, c in enumerate(kept)],
                     *[column(c).alias(f"i{i}") for i, c in enumerate(inputs)])
    out = StructType([f for f in sent.schema.fields[:len(kept)]] + list(fields))
    n = len(kept)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                columns = part.columns
                yield pa.RecordBatch.from_arrays(
                    [*columns[:n], *work(*columns[n:])], names=[f.name for f in out])
        getattr(work, "finish", lambda: None)()
        del work
        release()

    made = sent.mapInArrow(run, out)
    return made.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(kept)],
                       *[column(f.name) for f in fields])


def release() -> None:
    """Give freed memory back to the machine, as a worker lives on for other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim:
        trim(0)


def column(name: str) -> Column:
    """A column by its whole name, whatever signs it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    """A text column as Python strings; null is empty."""
    return [x or "" for x in column.to_pylist()]


def id_filter(ids: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A fixed-size bit table of the hashes (column h) of wanted rows; it may let others through."""
    place = F.pmod(F.col("h"), F.lit(bits))
    words = (ids.select(F.floor(place / 63).alias("w"), F.expr(f"shiftleft(1L, cast(pmod(pmod(h, {bits}), 63) as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
    out = np.zeros(bits // 63 + 1, np.int64)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return out


def passes(table: np.ndarray, h: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    place = h % bits
    return (table[place // 63] >> (place % 63)) & 1 == 1
