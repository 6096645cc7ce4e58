"""Near-duplicate documents by BagMinHash over multisets of word shingles.

A document is the multiset of its runs of ``SHINGLE`` words (A-Z in lower case; letters, digits and
non-ASCII characters form words). The weight line of a shingle is cut into the dyadic intervals
[0,1), [1,2), [2,4), ...; each carries its own Poisson process, seeded by shingle and interval, with a
rate of one for each register and unit of weight. A point has a time, a register and a place on the
weight line, and counts in a document if its place lies under the shingle's count there. The earliest
time in every register is the signature: two documents agree in a register with a chance equal to
their weighted Jaccard similarity, exactly. Points are drawn in order of time and only until they
come later than all registers' values, so a document of n distinct shingles costs about
n + m ln m draws.

``BANDS`` bands of ``ROWS`` registers make the buckets. A pair at the threshold of 0.8 misses all of
them with a chance of 1.5e-4. Every link is verified on the exact multisets. Inside a bucket each
document is first compared with the bucket's first document, and the components of those links are
taken; after that only buckets that still hold several components are looked at again, in blocks that
keep their pairs to themselves. Links that are passed on grow with the documents, not with the
pairs, and no link between different components is lost.

Documents with the same words are one class from the start; so are repeated rows.

Defined results: a document of fewer words than a shingle, but at least one, is one shingle; one
without words (null or empty, too) links with nothing and is always kept; a null doc_id is a name like
any other and is never kept in the place of another; a similarity right at the threshold links; a text of any
length is read whole; the documents' own columns may have any names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftide.llm.common import id_filter, passes, utf8, with_columns
from shelftide.llm.components import components
from shelftide.llm.decontaminate import WORD_BYTES
from shelftide.session import materialise

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 48, 8
BLOCK = 512

_TABLE = np.random.default_rng(11).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses modulo 2**64, kept from call to call."""
    if len(_POWERS["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            made = np.full(size, base, np.uint64)
            made[0] = 1
            _POWERS[name] = np.multiply.accumulate(made)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix_hash(a: np.ndarray) -> np.ndarray:
    """h with hash of a[i:j] = (h[j] - h[i]) * inverse power i."""
    h = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_TABLE[a] * powers(len(a))[0], out=h[1:])
    return h


def shingles(texts: list[bytes], size: int = SHINGLE):
    """Over a slice of documents: words of each, hashes of all words, and (doc, shingle) pairs."""
    data = b" ".join([t.translate(WORD_BYTES) for t in texts]) + b" "
    ends = np.cumsum([len(t) + 1 for t in texts])
    a = np.frombuffer(data, np.uint8)
    edge = np.diff(np.concatenate([[0], (a != 32).astype(np.int8)]))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    h = prefix_hash(a)
    words = mix((h[stops] - h[starts]) * powers(len(a))[1][starts] + (stops - starts).astype(np.uint64))
    doc = np.searchsorted(ends, starts, "right")
    n_words = np.bincount(doc, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(n_words)])
    n = len(words) - size + 1
    if n > 0:
        whole = np.flatnonzero(doc[:n] == doc[size - 1:])
        value = np.zeros(len(whole), np.uint64)
        for k in range(size):
            value = mix(value * np.uint64(_BASE) + words[whole + k])
        owner = doc[whole]
    else:
        value, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = [(i, int(first[i]), int(first[i + 1])) for i in np.flatnonzero((n_words > 0) & (n_words < size))]
    if short:
        extra = []
        for _, s, e in short:
            v = np.full(1, e - s, np.uint64)
            for w in words[s:e]:
                v = mix(v * np.uint64(_BASE) + w)
            extra.append(v[0])
        value = np.concatenate([value, np.array(extra, np.uint64)])
        owner = np.concatenate([owner, [i for i, _, _ in short]])
    return n_words, words, first, owner, value


def counted(owner: np.ndarray, value: np.ndarray):
    """Distinct (doc, shingle) with their counts, in order."""
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])]) \
        if len(owner) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return owner[at], value[at], np.diff(np.concatenate([at, [len(owner)]]))


def elements(owner: np.ndarray, value: np.ndarray, weight: np.ndarray):
    """The multisets as plain sets, sorted: the k-th occurrence of a shingle is an element of its own."""
    nth = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
    owner, value = np.repeat(owner, weight), np.repeat(value, weight)
    value = mix(value + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.lexsort((value, owner))
    return owner[order], value[order]


def bag_minhash(docs: int, owner: np.ndarray, value: np.ndarray, weight: np.ndarray,
                registers: int) -> np.ndarray:
    """The earliest time in every register of every document (infinite where it has no shingle)."""
    seeds, owners, lows, widths, tops = [], [], [], [], []
    low, level = 0, 0
    while len(weight) and (weight > low).any():  # the dyadic intervals under each weight
        at = np.flatnonzero(weight > low)
        width = max(1, low)
        seeds.append(mix(value[at] + np.uint64((level * 0xD1B54A32D192ED03) % 2**64)))
        owners.append(owner[at])
        lows.append(np.full(len(at), low))
        widths.append(np.full(len(at), width))
        tops.append(weight[at])
        low, level = low + width, level + 1
    times = np.full(docs * registers, np.inf)
    if not seeds:
        return times.reshape(docs, registers)
    seed, doc = np.concatenate(seeds), np.concatenate(owners)
    low, width, top = np.concatenate(lows), np.concatenate(widths), np.concatenate(tops)
    now, limit, step = np.zeros(len(seed)), np.full(docs, np.inf), 0
    while len(seed):
        step += 1
        draw = mix(seed + np.uint64((step * _BASE) % 2**64))
        now = now - np.log(((draw >> np.uint64(11)).astype(float) + 1) * 2.0**-53) / (registers * width)
        live = now < limit[doc]
        if not live.all():
            seed, doc, now, draw = seed[live], doc[live], now[live], draw[live]
            low, width, top = low[live], width[live], top[live]
        other = mix(draw ^ np.uint64(0xA0761D6478BD642F))
        register = ((other >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
        place = low + ((other & np.uint64(0xFFFFFFFF)).astype(float) * 2.0**-32 * width).astype(np.int64)
        hit = place < top
        np.minimum.at(times, doc[hit] * registers + register[hit], now[hit])
        active = np.unique(doc)
        limit[active] = times.reshape(docs, registers)[active].max(1)
    return times.reshape(docs, registers)


def band_keys(times: np.ndarray, bands: int = BANDS) -> np.ndarray:
    bits = times.view(np.uint64).reshape(len(times), bands, -1)
    key = np.zeros(bits.shape[:2], np.uint64)
    for k in range(bits.shape[2]):
        key = mix(key * np.uint64(_BASE) + bits[:, :, k])
    return key.view(np.int64)


def signatures(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, digest of the words, number of shingles, band keys (empty without words)."""
    def start():
        def work(column):
            texts = utf8(column)
            n_words, words, first, owner, value = shingles(texts)
            owner, value, weight = counted(owner, value)
            keys = band_keys(bag_minhash(len(texts), owner, value, weight, BANDS * ROWS)) \
                if len(texts) else np.zeros((0, BANDS), np.int64)
            total = np.bincount(owner, weights=weight, minlength=len(texts)).astype(np.int64)
            digest = [hashlib.blake2b(words[a:b].tobytes(), digest_size=16).digest()
                      for a, b in zip(first, first[1:])]
            return [pa.array(digest, pa.binary()), pa.array(total),
                    pa.array([k if n else [] for k, n in zip(keys.tolist(), n_words.tolist())],
                             pa.list_(pa.int64()))]
        return work

    return with_columns(docs, [text], "digest binary, n bigint, bands array<bigint>", start,
                        ["doc_id"], rows=500)


def shingle_sets(docs: DataFrame, wanted: DataFrame, text: str = "text") -> DataFrame:
    """cid and the elements of its multiset, for the classes wanted (cid, digest, first)."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(id_filter(wanted.select(F.xxhash64("first").alias("h"))))

    def run(batches):
        for batch in batches:
            keep = passes(table.value, batch.column(1).to_numpy(zero_copy_only=False))
            batch = batch.filter(pa.array(keep))
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = utf8(part.column(2))
                _, words, first, owner, value = shingles(texts)
                owner, value = elements(*counted(owner, value))
                cut = np.searchsorted(owner, np.arange(len(texts) + 1))
                digest = [hashlib.blake2b(words[a:b].tobytes(), digest_size=16).digest()
                          for a, b in zip(first, first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(digest, pa.binary()),
                     pa.array([value[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())],
                    names=["doc_id", "digest", "elements"])

    made = docs.select("doc_id", F.xxhash64("doc_id").alias("h"), F.col(f"`{text}`")).mapInArrow(
        run, "doc_id bigint, digest binary, elements binary")
    named = wanted.select("cid", F.col("digest").alias("own"), "first")
    return (made.join(named, (F.col("digest") == F.col("own"))
                      & F.col("doc_id").eqNullSafe(F.col("first")))
            .dropDuplicates(["digest"]).select("cid", "elements"))


def overlap(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two multisets, as elements."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / max(1, len(x) + len(y) - both)


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose exact similarity reaches the threshold."""
    def start():
        def work(one, two):
            return [pa.array([overlap(a, b) >= similarity for a, b in
                              zip(one.to_pylist(), two.to_pylist(), strict=True)], pa.bool_())]
        return work

    return with_columns(
        pairs.join(sets.toDF("a", "ea"), "a").join(sets.toDF("b", "eb"), "b"), ["ea", "eb"],
        "near boolean", start, ["a", "b"], rows=500).where("near").select("a", "b")


def overlaps(sets: list[np.ndarray], step: int = 4096) -> np.ndarray:
    """Sizes of all intersections of a block's sets, by incidence matrices of ``step`` elements."""
    doc = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[code] > 1
    doc, code = doc[shared], code[shared]
    out = np.zeros((len(sets), len(sets)), np.float64)
    if not len(code):
        return out
    code = np.unique(code, return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    doc, code = doc[order], code[order]
    cut = np.searchsorted(code, np.arange(0, code[-1] + 1 + step, step))
    for low, (a, b) in zip(range(0, code[-1] + 1, step), zip(cut, cut[1:])):
        x = np.zeros((len(sets), step), np.float32)
        x[doc[a:b], code[a:b] - low] = 1
        out += x @ x.T
    return out


def bucket_links(rows: list[dict], similarity: float) -> list[tuple[int, int]]:
    """Links (a spanning forest) between documents of a block that are in different components."""
    rows.sort(key=lambda r: r["cid"])
    sets = [np.frombuffer(r["elements"], np.uint64) for r in rows]
    size, root = np.array([len(x) for x in sets]), np.array([r["root"] for r in rows])
    both = overlaps(sets)
    near = both >= similarity * (size[:, None] + size[None, :] - both) * (1 - 1e-12)
    near &= root[:, None] != root[None, :]
    side = np.array([0 if r["i"] == r["j"] else 1 + (r["own"] == r["j"]) for r in rows])
    if side.any():
        near &= side[:, None] != side[None, :]
    label, n = np.arange(len(rows)), len(rows)
    while True:
        lower = np.minimum(label, np.where(near, label[None, :], n).min(1))
        lower = lower[lower]
        if (lower == label).all():
            return [(rows[a]["cid"], rows[b]["cid"]) for a, b in enumerate(label.tolist()) if a != b]
        label = lower


def cross_links(members: DataFrame, roots: DataFrame, sets: DataFrame, similarity: float,
                block: int | None = None) -> DataFrame:
    """Links between documents that share a bucket and are in different components.

    Only buckets that hold several components are looked at. Their documents meet in blocks (a
    bucket of more than ``block`` documents as pairs of blocks), where all overlaps are matrix
    products; no pairs leave the task but the links of a spanning forest.
    """
    block = block or BLOCK
    known = roots.select(F.col("node").alias("cid"), "root")
    placed = materialise(members.select("cid", "band", "key").join(known, "cid", "left")
                         .withColumn("root", F.coalesce("root", "cid")), "placed")
    mixed = materialise(placed.groupBy("band", "key").agg(
        F.ceil(F.count("*") / block).cast("int").alias("blocks"), F.min("root").alias("low"),
        F.max("root").alias("high")).where("low <> high").drop("low", "high"), "mixed-buckets")
    dealt = (placed.join(mixed, ["band", "key"])
             .withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("band", "key", "cid", "root", "own", F.least("own", "other").alias("i"),
                     F.greatest("own", "other").alias("j")))
    filled = (dealt.join(sets, "cid").repartition("band", "key", "i", "j")
              .sortWithinPartitions("band", "key", "i", "j"))

    def run(batches):
        def made(links):
            return pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

        group, rows = None, []
        for batch in batches:
            out = []
            for part in (batch.slice(at, 500) for at in range(0, batch.num_rows, 500)):
                for r in part.to_pylist():
                    key = (r["band"], r["key"], r["i"], r["j"])
                    if key != group:
                        if len(rows) > 1:
                            out += bucket_links(rows, similarity)
                        group, rows = key, []
                    rows.append(r)
            yield made(out)
        yield made(bucket_links(rows, similarity) if len(rows) > 1 else [])

    return filled.select("band", "key", "i", "j", "own", "cid", "root", "elements").mapInArrow(
        run, "a bigint, b bigint").distinct()


def clusters(docs: DataFrame, similarity: float, text: str):
    """The rows with their digests (doc_id, digest, n), the classes of equal words (digest, cid, first id, n)
    with their component's root, and the smallest id of every root."""
    signed = materialise(signatures(docs, text), "signatures")
    classes = materialise(
        signed.groupBy("digest").agg(F.min("doc_id").alias("first"), F.first("n").alias("n"),
                                     F.first("bands").alias("bands"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    spread = classes.select("cid", "first", "n", F.posexplode("bands").alias("band", "key"))
    buckets = materialise(
        spread.groupBy("band", "key").agg(F.min("cid").alias("pivot"), F.count("*").alias("size"))
        .where("size > 1").drop("size"), "buckets")
    members = materialise(spread.select("cid", "n", "band", "key").join(buckets, ["band", "key"]),
                          "members")
    sizes = classes.select(F.col("cid").alias("pivot"), F.col("n").alias("pn"))
    close = (F.least("n", "pn") >= F.greatest("n", "pn") * similarity - 1e-9)
    stars = materialise(members.where("cid <> pivot").select("pivot", "cid", "n").distinct()
                        .join(sizes, "pivot").where(close)
                        .select(F.col("pivot").alias("a"), F.col("cid").alias("b")), "pairs")
    sets = materialise(shingle_sets(
        docs, classes.join(members.select("cid").distinct(), "cid", "left_semi")
        .select("cid", "digest", "first"), text), "shingles")
    links = materialise(verified(stars, sets, similarity), "links")
    roots = components(links)
    more = materialise(cross_links(members, roots, sets, similarity), "links")
    if not more.isEmpty():
        roots = components(links.unionAll(more))
    named = (classes.select("digest", "cid", "first", "n")
             .join(roots.select(F.col("node").alias("cid"), "root"), "cid", "left")
             .withColumn("root", F.coalesce("root", "cid")))
    return signed, named, named.groupBy("root").agg(F.min("first").alias("name"))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, text: str = "text") -> DataFrame:
    """doc_id, digest of the words, cluster_id (smallest doc_id of its component), n_shingles, kept.

    One row for every row of ``docs``.
    """
    signed, named, names = clusters(docs, similarity, text)
    return (signed.select("doc_id", "digest", "n")
            .join(named.join(names, "root").select("digest", "name"), "digest")
            .select("doc_id", "digest", F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("doc_id"))
                    .alias("cluster_id"), F.col("n").alias("n_shingles"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("cluster_id"))))


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY, text: str = "text") -> DataFrame:
    """The documents that are kept, all columns as they are, of any names; of repeated rows with words, one;
    those without words all.

    The kept row of a component is known from its classes, so rows meet only names of their own id and words:
    a group of any number of copies is no key of a join.
    """
    _, named, names = clusters(docs, similarity, text)
    kept = named.where("n > 0").join(names, "root").where(F.col("first").eqNullSafe(F.col("name"))).select(
        F.col("first").alias("id__"), F.col("digest").alias("digest__"))
    cols = docs.columns
    own = docs.toDF(*[f"own__{i}" for i in range(len(cols))])
    at = {c: own.columns[i] for i, c in enumerate(cols)}

    def start():
        def work(texts):
            _, words, first, _, _ = shingles(utf8(texts))
            return [pa.array([hashlib.blake2b(words[a:b].tobytes(), digest_size=16).digest()
                              for a, b in zip(first, first[1:])], pa.binary()),
                    pa.array(np.diff(first), pa.int64())]
        return work

    marked = with_columns(own, [at[text]], "words__ binary, n__ bigint", start, own.columns, rows=500)
    some = (marked.where("n__ > 0")
            .join(kept, (F.col("words__") == F.col("digest__")) & F.col(at["doc_id"]).eqNullSafe(F.col("id__")))
            .dropDuplicates(["words__", at["doc_id"]]))
    return (some.select(*own.columns).unionAll(marked.where("n__ = 0").select(*own.columns))
            .select(*[F.col(at[c]).alias(c) for c in cols]))
