"""Benchmark decontamination: prefix-filtered join of item windows with document words.

A window is ``width`` consecutive words of an item; an item with fewer words, but at least one, is
one window. Containment of a whole window needs all of its words, so its necessary prefix is one
token: the word that is rarest over all documents. A document is probed only at the prefix words
it holds; the word's place in the window gives the window's start (positional bound), the window
must end inside the document (length bound), and the words between are compared exactly.

The windows are sent to the tasks in blocks of at most about ``block`` (window, item) pairs, so the
broadcast is bounded whatever the size of the benchmark; every block meets all documents.

Defined results: null and empty texts have no words and no hits; an item without words has no
window; a null item id counts as an empty one; repeated items count once; an item that shares a
window with another is reported with it; of words equally rare the first in byte order is a window's
prefix, which changes no hit; a text of any length is read whole; documents with equal ids are reported row by row; the
added columns take the place of carried ones of their names, other columns may have any name; an empty
benchmark leaves every document clean, and an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftide.llm.common import utf8, with_columns
from shelftide.session import materialise

WIDTH = 10
#: (window, item) pairs in one broadcast block: about 50 MB of short words.
BLOCK = 200_000

#: A-Z in lower case; a-z, 0-9 and every byte of a non-ASCII character stay; the rest separates.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128
                   else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def item_windows(benchmark: DataFrame, width: int = WIDTH, item_id: str = "item_id",
                 text: str = "text") -> DataFrame:
    """Distinct (window, item_id): the words of a window joined by spaces."""
    def start():
        def work(texts):
            found = []
            for t in utf8(texts):
                w = words_of(t)
                found.append(sorted({b" ".join(w[i:i + width])
                                     for i in range(max(1, len(w) - width + 1))} if w else ()))
            return [pa.array(found, pa.list_(pa.binary()))]
        return work

    made = with_columns(benchmark, [text], "windows array<binary>", start, [item_id])
    return made.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("item_id"),
                       F.explode("windows").alias("window")).distinct()


def word_counts(docs: DataFrame, text: str, wanted) -> dict[bytes, int]:
    """How often each wanted word occurs in all documents; the wanted words are one block's."""
    def run(batches):
        counts: Counter = Counter()
        keep = wanted.value
        for batch in batches:
            for t in utf8(batch.column(0)):
                counts.update([w for w in words_of(t) if w in keep])
        yield pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())],
            names=["word", "n"])

    counted = (docs.select(F.col(f"`{text}`")).mapInArrow(run, "word binary, n bigint")
               .groupBy("word").agg(F.sum("n").alias("n")))
    return {bytes(r.word): r.n for r in counted.collect()}


def prefix_index(pairs: list[tuple[bytes, str]], counts: dict[bytes, int]):
    """By prefix word: the (place, length) pairs of its windows; by window: its items.

    A window with a word that no document holds cannot occur and is left out.
    """
    places: dict[bytes, set] = defaultdict(set)
    items: dict[tuple, list[str]] = defaultdict(list)
    for window, item in pairs:
        words = tuple(window.split(b" "))
        at = min(range(len(words)), key=lambda i: (counts.get(words[i], 0), words[i], i))
        if counts.get(words[at], 0):
            places[words[at]].add((at, len(words)))
            items[words].append(item)
    return {w: sorted(p) for w, p in places.items()}, dict(items)


def search(words: list[bytes], places: dict, items: dict):
    """Merged word ranges covered by occurring windows, and the items they belong to."""
    n, found, hit = len(words), set(), set()
    for i in [i for i, w in enumerate(words) if w in places]:
        for at, length in places[words[i]]:
            first = i - at
            if first >= 0 and first + length <= n:
                window = tuple(words[first:first + length])
                if window in items:
                    found.add((first, first + length))
                    hit.update(items[window])
    merged: list[list[int]] = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return merged, sorted(hit)


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                  carry=("doc_id",), width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """Adds n_words, hit_ranges (merged [first, after last] word places) and hit_items (sorted)."""
    spark = docs.sparkSession
    windows = materialise(item_windows(benchmark, width), "windows")
    blocks = max(1, -(-windows.count() // block))
    many = blocks > 1
    if many:  # the blocks' results meet by a row number, which must then be fixed
        docs = materialise(docs.withColumn("row_no__", F.monotonically_increasing_id()), "docs")
    parts = []
    for k in range(blocks):
        pairs = [(bytes(r.window), r.item_id) for r in windows.where(
            F.pmod(F.xxhash64("window", "item_id"), F.lit(blocks)) == k).collect()]
        wanted = spark.sparkContext.broadcast({w for p, _ in pairs for w in p.split(b" ")})
        sent = spark.sparkContext.broadcast(
            prefix_index(pairs, word_counts(docs, text, wanted) if pairs else {}))

        def start(sent=sent):
            places, items = sent.value

            def work(texts):
                counts, ranges, hits = [], [], []
                for t in utf8(texts):
                    words = words_of(t)
                    merged, hit = search(words, places, items)
                    counts.append(len(words))
                    ranges.append(merged)
                    hits.append(hit)
                return [pa.array(counts, pa.int64()),
                        pa.array(ranges, pa.list_(pa.list_(pa.int32()))),
                        pa.array(hits, pa.list_(pa.string()))]
            return work

        parts.append(with_columns(
            docs, [text], "n_words bigint, hit_ranges array<array<int>>, hit_items array<string>",
            start, [*carry, "row_no__"] if many else carry))
    if not many:
        return parts[0]
    rest = parts[0].select("row_no__", "hit_ranges", "hit_items")
    for p in parts[1:]:
        rest = rest.unionAll(p.select("row_no__", "hit_ranges", "hit_items"))
    merged = (rest.where(F.size("hit_ranges") > 0).groupBy("row_no__").agg(
        F.array_sort(F.flatten(F.collect_list("hit_ranges"))).alias("r"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_items")))).alias("h")))
    union = F.expr("""aggregate(r, cast(array() as array<array<int>>), (m, x) ->
        if(size(m) > 0 and x[0] <= element_at(m, -1)[1],
           concat(slice(m, 1, size(m) - 1),
                  array(array(element_at(m, -1)[0], greatest(element_at(m, -1)[1], x[1])))),
           concat(m, array(x))))""")
    base = parts[0].drop("hit_ranges", "hit_items")
    return (base.join(merged.select("row_no__", union.alias("hit_ranges"),
                                    F.col("h").alias("hit_items")), "row_no__", "left")
            .withColumn("hit_ranges", F.coalesce("hit_ranges", F.expr(
                "cast(array() as array<array<int>>)")))
            .withColumn("hit_items", F.coalesce("hit_items", F.expr(
                "cast(array() as array<string>)"))).drop("row_no__"))


def hit_words() -> F.Column:
    return F.expr("aggregate(hit_ranges, 0L, (s, x) -> s + x[1] - x[0])")
