"""Repeated byte strings by prefix-free parsing, refined by the classes of phrases and suffixes.

Every string of ``WIDTH`` bytes (a suffix, cut at that length) has an anchor: the place of its least
rolling hash of ``GRAM`` bytes. Suffixes that follow each other and share an anchor form a phrase, so
the triggers depend on content alone and phrases of equal strings are cut alike wherever they occur.
A text becomes a parse, its row of phrases; equal phrases are one word of the dictionary.

A sorted suffix array would put suffixes with equal first ``WIDTH`` bytes next to each other. Only
that neighbourhood is needed here, so the corpus order is taken in classes of equal fingerprints,
which Spark groups by, instead of ranks, which one machine would sort:

1. phrases: an anchor gram that occurs once has no repeated suffix; a phrase that occurs twice has only
   repeated ones. Grams with more than one kind of phrase go on, with one phrase of each kind.
2. chunks of ``CHUNK`` suffixes at equal distances from the anchor: one whose core (the bytes that all
   of them hold) occurs once has no repeated suffix, one that occurs twice whole has only repeated
   ones. Cores with more than one kind of chunk go on, with one chunk of each kind.
3. single suffixes.

Each step counts by key with partial sums; a group of any size is a count, and only one row of each kind
goes on. Texts are read again only for the documents that a step needs, by a fixed-size filter.
Fingerprints have 64 bits beside the 64 bits of the anchor's gram, under which they are compared.

Defined results: a null or empty text, and one shorter than ``WIDTH`` bytes, keeps all its bytes;
repeated rows repeat each other; a document of one repeated byte repeats itself, overlaps included;
a null doc_id is an id; a text of any length is read whole, in stretches; a gram tied for the least of a string
goes to its first place; other columns of the documents may have any names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftide.llm.common import column, id_filter, passes, utf8, with_columns
from shelftide.llm.near_texts import mix, powers, prefix_hash
from shelftide.session import materialise

WIDTH = 400
GRAM = 32
CHUNK = 32
#: Bits of a place inside one stretch of a text; the rest of the 64 order the grams.
PLACE = 24
STRETCH = 1 << (PLACE - 1)


class Prints:
    """Fingerprints of the substrings of a text."""

    def __init__(self, text: bytes):
        self.sums = prefix_hash(np.frombuffer(text, np.uint8))
        self.down = powers(len(text) + 1)[1]

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.down[start]
                   + (stop - start).astype(np.uint64))


def anchors(prints: Prints, size: int, width: int = WIDTH, gram: int = GRAM) -> np.ndarray:
    """The anchor of the suffix at every place p <= size - width: the first least gram in it."""
    count, span = size - width + 1, width - gram + 1
    out = np.empty(count, np.int64)
    mask = np.uint64((1 << PLACE) - 1)
    for low in range(0, count, STRETCH):
        n = min(STRETCH, count - low)
        at = np.arange(low, low + n + span - 1)
        key = (prints(at, at + gram) & ~mask) | (at - low).astype(np.uint64)
        padded = np.concatenate([key, np.full(-len(key) % span, ~np.uint64(0))]).reshape(-1, span)
        right = np.minimum.accumulate(padded, 1).ravel()
        left = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
        least = np.minimum(left[:n], right[span - 1:span - 1 + n])
        out[low:low + n] = (least & mask).astype(np.int64) + low
    return out


def phrases(text: bytes, width: int = WIDTH, gram: int = GRAM):
    """Gram, fingerprint, anchor, first place and number of suffixes of every phrase of a text."""
    if len(text) < width:
        return [np.zeros(0, np.int64)] * 5
    prints = Prints(text)
    anchor = anchors(prints, len(text), width, gram)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    count = np.diff(np.concatenate([first, [len(anchor)]]))
    a = anchor[first]
    whole = mix(prints(first, first + count - 1 + width) + (a - first).astype(np.uint64))
    return [prints(a, a + gram).view(np.int64), whole.view(np.int64), a, first, count]


def lists(columns: list[list[np.ndarray]]) -> list[pa.Array]:
    """Arrow lists of long values, one list for each row and column."""
    out = []
    for rows in columns:
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
        values = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
        out.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)))
    return out


def digest(text: bytes) -> tuple[int, int]:
    d = np.frombuffer(hashlib.blake2b(text, digest_size=16).digest(), "<i8")
    return int(d[0]), int(d[1])


def parsed(docs: DataFrame, width: int, gram: int, text: str = "text") -> DataFrame:
    """row_no, doc_id, d1, d2 (digest of the text), n_bytes, own_sha and the parse of every row."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")

    def start():
        def work(column):
            texts = utf8(column)
            parts = [phrases(t, width, gram) for t in texts]
            digests = [digest(t) for t in texts]
            return [pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([d[1] for d in digests], pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    *lists([[p[k] for p in parts] for k in range(5)])]
        return work

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row_no"),
                       F.sha2(body, 256).alias("own_sha"), F.col(f"`{text}`").alias("text"))
    arrays = ", ".join(f"{n} array<bigint>" for n in ("gram", "whole", "anchor", "first", "count"))
    return with_columns(rows, ["text"], f"d1 bigint, d2 bigint, n_bytes bigint, {arrays}", start,
                        ["row_no", "doc_id", "own_sha"])


def texts_of(docs: DataFrame, wanted: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``wanted`` (row_no, doc_id, d1, d2, more) with their texts, read again."""
    mark = F.xxhash64("doc_id").bitwiseXOR(F.col("d1")).alias("h")
    table = docs.sparkSession.sparkContext.broadcast(id_filter(wanted.select(mark)))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                digests = np.array([digest(t) for t in utf8(part.column(2))], np.int64).reshape(-1, 2)
                h = part.column(1).to_numpy(zero_copy_only=False) ^ digests[:, 0]
                keep = pa.array(passes(table.value, h))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(digests[:, 0]), pa.array(digests[:, 1]),
                     part.column(2).cast(pa.binary())],
                    names=["doc_id", "d1", "d2", "text"]).filter(keep)

    kept = docs.select("doc_id", F.xxhash64("doc_id").alias("h"), F.col(f"`{text}`")).mapInArrow(
        run, "doc_id bigint, d1 bigint, d2 bigint, text binary")
    more = [c for c in wanted.columns if c not in ("doc_id", "d1", "d2")]
    own = wanted.withColumnRenamed("doc_id", "own_id")
    return (kept.join(own, ["d1", "d2"]).where(F.col("doc_id").eqNullSafe(F.col("own_id")))
            .groupBy("d1", "d2", "row_no")  # repeated rows have one text
            .agg(F.first("text").alias("text"), *[F.first(c).alias(c) for c in more if c != "row_no"]))


def kinds(rows: DataFrame, core: list[str], own: list[str], place: list[str]):
    """Of rows under a core key and an own key: the rows of kinds that occur at least twice, and one row
    of every kind whose core has several kinds."""
    classes = materialise(
        rows.groupBy(*core, *own).agg(F.count("*").alias("n"), F.min(F.struct(*place)).alias("one")),
        "kinds")
    several = materialise(classes.groupBy(*core).agg(F.count("*").alias("k")).where("k > 1").drop("k"),
                          "cores")
    repeated = rows.join(classes.where("n > 1").select(*core, *own), [*core, *own])
    return repeated, classes.join(several, core).select(*core, *[f"one.{p}" for p in place])


def chunk_rows(texts: DataFrame, width: int, gram: int, chunk: int) -> DataFrame:
    """The chunks of the phrases listed (anchor, first, count) for each text."""
    def start():
        def work(column, anchor, first, count):
            out = []
            for t, a, p, n in zip(utf8(column), *[c.to_pylist() for c in (anchor, first, count)],
                                  strict=True):
                prints, a, p, n = Prints(t), np.array(a), np.array(p), np.array(n)
                low, high = (a - p - n + 1) // chunk, (a - p) // chunk
                each = np.repeat(np.arange(len(a)), high - low + 1)
                c = np.arange(len(each)) - np.repeat(np.cumsum(high - low + 1) - high - 1, high - low + 1)
                a, p, n = a[each], p[each], n[each]
                near = np.maximum(c * chunk, a - p - n + 1)
                far = np.minimum(c * chunk + chunk - 1, a - p)
                core = a - c * chunk
                out.append([prints(a, a + gram).view(np.int64), c,
                            prints(core, core + width - chunk + 1).view(np.int64), near, far,
                            prints(a - far, a - near + width).view(np.int64), a])
            return lists([[r[k] for r in out] for k in range(7)])
        return work

    names = ("gram", "c", "core", "near", "far", "whole", "anchor")
    made = with_columns(texts, ["text", "anchor", "first", "count"],
                        ", ".join(f"{n} array<bigint>" for n in names), start, ["row_no"], rows=200)
    return made.select("row_no", F.explode(F.arrays_zip(*names)).alias("x")).select("row_no", "x.*")


def suffix_rows(texts: DataFrame, width: int, gram: int) -> DataFrame:
    """Every suffix of the chunks listed (anchor, near, far) for each text."""
    def start():
        def work(column, anchor, near, far):
            out = []
            for t, a, x, y in zip(utf8(column), *[c.to_pylist() for c in (anchor, near, far)],
                                  strict=True):
                prints, a, x, y = Prints(t), np.array(a), np.array(x), np.array(y)
                each = np.repeat(np.arange(len(a)), y - x + 1)
                offset = np.arange(len(each)) - np.repeat(np.cumsum(y - x + 1) - y - 1, y - x + 1)
                a = a[each]
                p = a - offset
                out.append([prints(a, a + gram).view(np.int64), offset,
                            prints(p, p + width).view(np.int64), p])
            return lists([[r[k] for r in out] for k in range(4)])
        return work

    names = ("gram", "offset", "whole", "p")
    made = with_columns(texts, ["text", "anchor", "near", "far"],
                        ", ".join(f"{n} array<bigint>" for n in names), start, ["row_no"], rows=200)
    return made.select("row_no", F.explode(F.arrays_zip(*names)).alias("x")).select("row_no", "x.*")


def listed(rows: DataFrame, names: list[str], index: DataFrame) -> DataFrame:
    """One row for each document with its listed places, joined to its id and digest."""
    places = rows.groupBy("row_no").agg(F.collect_list(F.struct(*names)).alias("x"))
    return (index.join(places, "row_no")
            .select("row_no", "doc_id", "d1", "d2", *[F.col(f"x.{n}").alias(n) for n in names]))


def merged_spans(row: np.ndarray, s: np.ndarray, e: np.ndarray):
    """Row, start and stop of the maximal spans of [s, e) ranges of rows; those that touch are one."""
    order = np.lexsort((s, row))
    row, s, e = row[order], s[order], e[order]
    # The running maximum of the stops starts anew in each row, as rows lie in ranges of their own.
    base = row * (int(e.max(initial=0)) + 1)
    reach = np.maximum.accumulate(e + base) - base
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (s[1:] > reach[:-1])]) if len(s) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return row[at], s[at], reach[np.concatenate([at[1:], [len(s)]]) - 1] if len(s) else s


def merged(ranges: DataFrame) -> DataFrame:
    """row_no, spans (merged [start, stop) ranges, in order) and the number of bytes in them."""
    def start():
        def work(column):
            rows, values = column.value_lengths().to_numpy(zero_copy_only=False), column.flatten()
            row, low, high = merged_spans(
                np.repeat(np.arange(len(rows)), rows), *[values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1)])
            pairs = pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1, dtype=np.int32) * 2),
                                             pa.array(np.stack([low, high], 1).ravel()))
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(rows)))]).astype(np.int32)
            sizes = np.bincount(row, high - low, len(rows)).astype(np.int64)
            return [pa.ListArray.from_arrays(pa.array(ends), pairs), pa.array(sizes)]
        return work

    grouped = ranges.groupBy("row_no").agg(F.collect_list(F.struct("s", "e")).alias("x"))
    return with_columns(grouped, ["x"], "spans array<array<bigint>>, n_removed bigint", start, ["row_no"])


def repeated_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, chunk: int = CHUNK,
                   text: str = "text") -> DataFrame:
    """row_no, doc_id, d1, d2, n_bytes, own_sha, spans, n_removed of every row.

    A span is a maximal run of bytes covered by strings of ``width`` bytes that start elsewhere too.
    """
    rows = materialise(parsed(docs, width, gram, text), "parses")
    index = rows.select("row_no", "doc_id", "d1", "d2")
    parse = rows.select("row_no", F.explode(F.arrays_zip("gram", "whole", "anchor", "first", "count"))
                        .alias("x")).select("row_no", "x.*")
    grams = materialise(parse.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").drop("n"),
                        "grams")
    found = materialise(parse.join(grams, "gram"), "phrases")
    twice, mixed = kinds(found, ["gram"], ["whole", "count"], ["row_no", "anchor", "first", "count"])
    ranges = [twice.select("row_no", F.col("first").alias("s"),
                           (F.col("first") + F.col("count") - 1 + width).alias("e"))]

    wanted = materialise(listed(mixed, ["anchor", "first", "count"], index), "mixed-phrases")
    chunks = materialise(chunk_rows(texts_of(docs, wanted, text), width, gram, chunk), "chunks")
    twice, mixed = kinds(chunks, ["gram", "c", "core"], ["near", "far", "whole"],
                         ["row_no", "anchor", "near", "far"])
    ranges.append(twice.select("row_no", (F.col("anchor") - F.col("far")).alias("s"),
                               (F.col("anchor") - F.col("near") + width).alias("e")))

    wanted = materialise(listed(mixed, ["anchor", "near", "far"], index), "mixed-chunks")
    suffixes = materialise(suffix_rows(texts_of(docs, wanted, text), width, gram), "suffixes")
    classes = materialise(suffixes.groupBy("gram", "offset", "whole").agg(F.count("*").alias("n"))
                          .where("n > 1").drop("n"), "kinds")
    ranges.append(suffixes.join(classes, ["gram", "offset", "whole"]).select(
        "row_no", F.col("p").alias("s"), (F.col("p") + width).alias("e")))

    spans = merged(ranges[0].unionAll(ranges[1]).unionAll(ranges[2]))
    return materialise(
        rows.select("row_no", "doc_id", "d1", "d2", "n_bytes", "own_sha").join(spans, "row_no", "left")
        .withColumn("n_removed", F.coalesce("n_removed", F.lit(0)).cast("bigint"))
        .withColumn("spans", F.coalesce("spans", F.expr("cast(array() as array<array<bigint>>)"))),
        "spans")


def without(text: bytes, spans) -> bytes:
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def kept_digests(docs: DataFrame, spans: DataFrame, text: str = "text") -> DataFrame:
    """Adds kept_sha256: of the own text where nothing goes, of no bytes where all go, else of the
    remaining bytes, for which the text is read again."""
    part = spans.where((F.col("n_removed") > 0) & (F.col("n_removed") < F.col("n_bytes")))
    texts = texts_of(docs, part.select("row_no", "doc_id", "d1", "d2", "spans"), text)

    def start():
        def work(column, cuts):
            return [pa.array([hashlib.sha256(without(t, s)).hexdigest() for t, s in
                              zip(utf8(column), cuts.to_pylist(), strict=True)], pa.string())]
        return work

    cut = with_columns(texts, ["text", "spans"], "cut_sha string", start, ["row_no"])
    empty = hashlib.sha256(b"").hexdigest()
    return spans.join(cut, "row_no", "left").withColumn("kept_sha256", F.coalesce(
        "cut_sha", F.when(F.col("n_removed") > 0, empty).otherwise(F.col("own_sha"))))


def cut_texts(docs: DataFrame, spans: DataFrame, text: str = "text", cut=without) -> DataFrame:
    """The documents with the bytes that ``cut`` takes for their spans out of their texts, other columns as
    they are.

    A character of which a span takes a part goes as a whole. A row meets its spans by id and digest;
    of equal rows each gets the same spans.
    """
    names = docs.columns
    digests = F.struct("d1", "d2")

    def start_digest():
        def work(texts):
            return [pa.array([list(digest(t)) for t in utf8(texts)], pa.list_(pa.int64()))]
        return work

    def start_cut():
        def work(texts, cuts):
            out = []
            for t, s in zip(texts.to_pylist(), cuts.to_pylist(), strict=True):
                out.append(t if not s else cut(t.encode(), s).decode("utf-8", "ignore"))
            return [pa.array(out, pa.string())]
        return work

    marked = with_columns(docs, [text], "digest__ array<bigint>", start_digest, names)
    some = (spans.where("n_removed > 0").groupBy("doc_id", digests.alias("d"))
            .agg(F.first("spans").alias("spans__"))
            .select(F.col("doc_id").alias("doc_id__"), F.array("d.d1", "d.d2").alias("digest__"),
                    "spans__"))
    joined = marked.join(some, (marked["digest__"] == some["digest__"])
                         & marked["doc_id"].eqNullSafe(some["doc_id__"]), "left").drop(some["digest__"])
    return with_columns(joined, [text, "spans__"], f"`{text}` string", start_cut, names).select(*map(column, names))
