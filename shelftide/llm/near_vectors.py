"""Near-duplicate vectors by Euclidean p-stable hashing with exact cosine checks.

Vectors are scaled to length one, so a cosine of at least ``COSINE`` is a distance of at most
sqrt(2 - 2 COSINE). A table hashes a vector to the whole parts of k Gaussian projections divided by
``WIDTH``, k being large enough that vectors at right angles seldom share a bucket of the
fullest label. As many tables are used as bring the chance that a pair right at the threshold meets
in none below ``MISS``; nearer pairs meet more surely.

Equal vectors of a label are one vector with a multiplicity. Inside a bucket all cosines are taken as
matrix products, a pair counts in the first table that brings it together, and only counts and the
links of a spanning forest leave the task. A bucket of more than ``BLOCK`` vectors is dealt out as
pairs of blocks, so no task holds a whole one.

Defined results: a vector that is null, empty, of zero length, or with null or non-finite components
links with nothing, as does any vector without a label; vectors of different dimension never link;
repeated rows are vectors of their own; a cosine right at the threshold links; a vector of any length is
compared whole; columns other than id, vector and label are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, erf, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftide.llm.common import with_columns
from shelftide.llm.components import components
from shelftide.session import materialise

COSINE = 0.93
WIDTH = 2.0
MISS = 1e-3
BLOCK = 512
SEED = 20


def collision(distance: float, width: float = WIDTH) -> float:
    """The chance that one projection puts two vectors at this distance in the same bucket."""
    r = width / distance
    return erf(r / sqrt(2)) - 2 / (sqrt(2 * pi) * r) * (1 - exp(-r * r / 2))


def tables_for(rows: int, cosine: float = COSINE) -> tuple[int, int]:
    """(projections of a table, tables) for the largest number of vectors of one label."""
    near, far = collision(sqrt(2 - 2 * cosine)), collision(sqrt(2))
    k = max(1, ceil(log(max(rows, 2)) / log(1 / far)))
    return k, max(1, ceil(log(MISS) / log(1 - near ** k)))


def unit(raw: list[bytes], kind: str = "<f8") -> np.ndarray:
    """Rows of equal dimension as vectors of length one, in double precision."""
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # lengths of huge or tiny components stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def kind_of(vectors: DataFrame) -> str:
    """The components' own type: they are carried as they are and computed with as doubles."""
    return "<f4" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8"


def usable(vectors: DataFrame, kind: str) -> DataFrame:
    """vec_id, label and raw (components as bytes; null where nothing can link)."""
    def start():
        def work(column, labels):
            out = []
            for v, label in zip(column.to_pylist(), labels.to_pylist(), strict=True):
                if v is None or label is None or not v or None in v:
                    out.append(None)
                    continue
                x = np.array(v, kind) + 0  # -0.0 is 0.0
                out.append(x.tobytes() if np.isfinite(x).all() and x.any() else None)
            return [pa.array(out, pa.binary())]
        return work

    return with_columns(vectors, ["embedding", "label"], "raw binary", start, ["vec_id", "label"])


def keys_of(raw: list[bytes], k: int, tables: int, kind: str = "<f8") -> np.ndarray:
    """One 32-bit key for each table. Computed once for a vector and carried along, so a rounding
    at a bucket's edge cannot differ between two places."""
    x = unit(raw, kind)
    rng = np.random.default_rng([SEED, x.shape[1]])
    a = rng.standard_normal((x.shape[1], tables * k))
    b = rng.uniform(0, WIDTH, tables * k)
    cell = np.floor((x @ a + b) / WIDTH).astype(np.int64).reshape(len(x), tables, k)
    key = np.zeros(cell.shape[:2], np.uint64)
    for j in range(k):
        key = (key ^ cell[:, :, j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return (key & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)


def hashed(reps: DataFrame, k: int, tables: int, kind: str) -> DataFrame:
    def start():
        def work(column):
            raw = column.to_pylist()
            keys = [None] * len(raw)
            for size in {len(r) for r in raw}:
                at = [i for i, r in enumerate(raw) if len(r) == size]
                for i, row in zip(at, keys_of([raw[i] for i in at], k, tables, kind).tolist(), strict=True):
                    keys[i] = row
            return [pa.array(keys, pa.list_(pa.int32()))]
        return work

    return with_columns(reps, ["raw"], "keys array<int>", start, ["rep", "label", "raw", "times"])


def bucket_links(x: np.ndarray, times: np.ndarray, keys: np.ndarray, t: int, side: np.ndarray,
                 cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """For a bucket of table t: new links of every row, weighted, and its root in the bucket.

    ``side``: 0 for all rows where the bucket is whole; else 1 and 2, and only pairs across count.
    """
    n = len(x)
    links, root = np.zeros(n, np.int64), np.arange(n)
    near = x @ x.T >= cosine
    np.fill_diagonal(near, False)
    if side.any():
        near &= side[:, None] != side[None, :]
    if not near.any():
        return links, root
    first = near.copy()
    for a in range(0, n, 256):  # pairs that an earlier table has brought together count there
        i, j = np.nonzero(near[a:a + 256])
        for b in range(0, len(i), 100_000):
            p, q = i[b:b + 100_000], j[b:b + 100_000]
            met = (keys[a + p, :t] == keys[q, :t]).any(1)
            first[a + p[met], q[met]] = False
    links = first @ times
    while True:
        lower = np.minimum(root, np.where(near, root[None, :], n).min(1))
        lower = lower[lower]
        if (lower == root).all():
            return links, root
        root = lower


def linked(buckets: DataFrame, cosine: float, kind: str) -> DataFrame:
    """rep, links, root for every row of a bucket that gained a link or a root.

    Rows come sorted by bucket; a batch's last bucket waits for the next batch.
    """
    def found(table: pa.Table) -> list[np.ndarray]:
        raw = table.column("raw").to_pylist()
        rep, times, t, own, i, j, size = (
            table.column(n).to_numpy() for n in ("rep", "times", "t", "own", "i", "j", "size"))
        keys = table.column("keys").combine_chunks().flatten().to_numpy().reshape(len(raw), -1)
        side = np.where(i == j, 0, np.where(own == i, 1, 2))
        cut = [0, *(np.flatnonzero(changed(table)) + 1).tolist(), len(raw)]
        out = []
        x = unit(raw, kind) if len(raw) and (size == size[0]).all() else None
        for a, b in zip(cut, cut[1:]):
            if b - a < 2:
                continue
            y = x[a:b] if x is not None else unit(raw[a:b], kind)
            links, root = bucket_links(y, times[a:b], keys[a:b], int(t[a]), side[a:b], cosine)
            some = np.flatnonzero((links > 0) | (root != np.arange(b - a)))
            if len(some):
                own_rep = rep[a:b]
                out.append(np.stack([own_rep[some], links[some], own_rep[root[some]]]))
        return out

    def changed(table: pa.Table) -> np.ndarray:
        differs = np.zeros(max(0, table.num_rows - 1), bool)
        for n in ("label", "t", "key", "i", "j", "size"):
            values = table.column(n).to_numpy()
            differs |= values[1:] != values[:-1]
        return differs

    def made(out: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate([*out, np.zeros((3, 0), np.int64)], 1)
        return pa.RecordBatch.from_arrays([pa.array(r) for r in rows], names=["rep", "links", "root"])

    def run(batches) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            ends = np.flatnonzero(changed(table))
            whole = int(ends[-1]) + 1 if len(ends) else 0
            yield made(found(table.slice(0, whole)) if whole else [])
            held = table.slice(whole)
        yield made(found(held) if held is not None else [])

    return buckets.mapInArrow(run, "rep bigint, links bigint, root bigint")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id, kept."""
    kind = kind_of(vectors)
    rows = materialise(usable(vectors, kind), "vectors")
    reps = (rows.where("raw is not null").groupBy("label", "raw")
            .agg(F.min("vec_id").alias("first"), F.count("*").alias("times"))
            .withColumn("rep", F.monotonically_increasing_id()))
    reps = materialise(reps, "distinct-vectors")
    largest = reps.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    k, tables = tables_for(largest, cosine)
    reps_hashed = materialise(hashed(reps, k, tables, kind), "hashed-vectors")
    spread = reps_hashed.select("rep", "label", F.length("raw").alias("size"),
                                F.posexplode("keys").alias("t", "key"))
    full = materialise(spread.groupBy("label", "size", "t", "key").agg(F.count("*").alias("n"))
                       .where("n > 1"), "buckets")
    places = spread.join(full, ["label", "size", "t", "key"]).withColumn(
        "blocks", F.ceil(F.col("n") / block).cast("int"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = (places.withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("rep", "label", "t", "key", "own", F.least("own", "other").alias("i"),
                     F.greatest("own", "other").alias("j")))
    filled = dealt.join(reps_hashed.select("rep", "raw", "times", "keys"), "rep")
    dealt_out = (filled.repartition("label", "t", "key", "i", "j", F.length("raw"))
                 .sortWithinPartitions("label", "t", "key", "i", "j", F.length("raw"), "rep"))
    found = materialise(linked(dealt_out.select(
        "label", "t", "key", "i", "j", F.length("raw").alias("size"), "own", "rep", "times", "raw",
        "keys"), cosine, kind), "links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    # a component is named by its smallest vec_id, which need not be its smallest rep
    classes = materialise(
        reps.select("rep", "label", "raw", "first", "times")
        .join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
        .join(counts, "rep", "left")
        .select("label", "raw", "first", F.coalesce("root", "rep").alias("root"),
                (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("links")), "classes")
    names = materialise(classes.groupBy("root").agg(F.min("first").alias("name")), "names")
    named = classes.join(names, "root").select("label", "raw", "name", "links")
    inside = rows.where("raw is not null").join(named, ["label", "raw"]).select(
        "vec_id", F.col("links").alias("n_links"), F.col("name").alias("component_id"))
    outside = rows.where("raw is null").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return inside.unionAll(outside).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
