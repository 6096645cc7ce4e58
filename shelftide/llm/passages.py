"""Passages of words that several documents share, by prefix-free parsing of word rows.

A text is its row of words (A-Z in lower case; letters, digits and non-ASCII characters form words), each
one symbol. Every window of ``WIDTH`` words has an anchor: the place of its least rolling hash of ``GRAM``
words. Windows that follow each other and share an anchor form a phrase, so the triggers depend on content
alone, and equal passages are cut alike wherever they occur. As in ``repeats``, only the neighbourhood that a
sorted suffix array would give is needed, and it is taken in classes of equal fingerprints:

1. phrases: an anchor gram in one document only has no shared window; a phrase that stands in two documents
   has only shared ones. Of grams with more than one kind of phrase, the phrases of one document go on, and
   of the others those of two documents, which is enough to tell whether a window is in another one.
2. single windows of those.

Groups of any size are counted by partial sums of their least and greatest row. A window that repeats only
inside its own document is not shared.

Defined results: null and empty texts, and those of fewer words than ``WIDTH``, share nothing; repeated rows
are documents of their own and share all their windows; the words between are compared exactly (64-bit
fingerprints beside those of the anchor's gram), what separates words is not; a null doc_id is an id like
any other; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftide.llm.common import utf8, with_columns
from shelftide.llm.decontaminate import WORD_BYTES
from shelftide.llm.near_texts import mix, powers, prefix_hash
from shelftide.llm.repeats import anchors, cut_texts, digest, listed, lists, merged, texts_of, without
from shelftide.session import materialise

WIDTH = 50
GRAM = 20


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte of every word, and the byte behind it."""
    a = np.frombuffer(text.translate(WORD_BYTES) + b" ", np.uint8)
    edge = np.diff(np.concatenate([[0], (a != 32).astype(np.int8)]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


class WordPrints:
    """Fingerprints of the runs of words of a text."""

    def __init__(self, text: bytes):
        starts, stops = word_places(text)
        sums = prefix_hash(np.frombuffer(text.translate(WORD_BYTES), np.uint8))
        words = mix((sums[stops] - sums[starts]) * powers(len(text) + 1)[1][starts]
                    + (stops - starts).astype(np.uint64))
        self.size = len(words)
        up, self.down = powers(self.size + 1)
        self.sums = np.zeros(self.size + 1, np.uint64)
        np.cumsum(words * up[:-1], out=self.sums[1:])

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.down[start] + (stop - start).astype(np.uint64))


def phrases(text: bytes, width: int, gram: int):
    """Gram, fingerprint, anchor, first window and number of windows of every phrase, and the words."""
    prints = WordPrints(text)
    if prints.size < width:
        return [np.zeros(0, np.int64)] * 5, prints.size
    anchor = anchors(prints, prints.size, width, gram)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    count = np.diff(np.concatenate([first, [len(anchor)]]))
    a = anchor[first]
    whole = mix(prints(first, first + count - 1 + width) + (a - first).astype(np.uint64))
    return [prints(a, a + gram).view(np.int64), whole.view(np.int64), a, first, count], prints.size


def parsed(docs: DataFrame, width: int, gram: int, text: str) -> DataFrame:
    """row_no, doc_id, d1, d2 (digest of the text), n_words and the parse of every row."""
    def start():
        def work(column):
            texts = utf8(column)
            parts = [phrases(t, width, gram) for t in texts]
            digests = [digest(t) for t in texts]
            return [pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()),
                    pa.array([p[1] for p in parts], pa.int64()), *lists([[p[0][k] for p in parts] for k in range(5)])]
        return work

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row_no"), F.col(f"`{text}`").alias("text"))
    arrays = ", ".join(f"{n} array<bigint>" for n in ("gram", "whole", "anchor", "first", "count"))
    return with_columns(rows, ["text"], f"d1 bigint, d2 bigint, n_words bigint, {arrays}", start,
                        ["row_no", "doc_id"])


def window_rows(texts: DataFrame, width: int, gram: int) -> DataFrame:
    """Every window of the phrases listed (anchor, first, count) for each text."""
    def start():
        def work(column, anchor, first, count):
            out = []
            for t, a, p, n in zip(utf8(column), *[c.to_pylist() for c in (anchor, first, count)], strict=True):
                prints, a, p, n = WordPrints(t), np.array(a), np.array(p), np.array(n)
                each = np.repeat(np.arange(len(a)), n)
                at = p[each] + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
                a = a[each]
                out.append([prints(a, a + gram).view(np.int64), a - at, prints(at, at + width).view(np.int64), at])
            return lists([[r[k] for r in out] for k in range(4)])
        return work

    names = ("gram", "offset", "whole", "p")
    made = with_columns(texts, ["text", "anchor", "first", "count"],
                        ", ".join(f"{n} array<bigint>" for n in names), start, ["row_no"], rows=200)
    return made.select("row_no", F.explode(F.arrays_zip(*names)).alias("x")).select("row_no", "x.*")


def shared_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, text: str = "text") -> DataFrame:
    """row_no, doc_id, d1, d2, n_words, spans and n_removed (words in spans) of every row.

    A span is a maximal run of words covered by windows of ``width`` words that another document holds too.
    """
    rows = materialise(parsed(docs, width, gram, text), "word-parses")
    parse = rows.select("row_no", F.explode(F.arrays_zip("gram", "whole", "anchor", "first", "count"))
                        .alias("x")).select("row_no", "x.*")
    low, high = F.min("row_no").alias("low"), F.max("row_no").alias("high")
    grams = materialise(parse.groupBy("gram").agg(low, high).where("low < high").select("gram"), "word-grams")
    found = materialise(parse.join(grams, "gram"), "word-phrases")

    kind = ["gram", "whole", "count"]
    kinds = materialise(found.groupBy(*kind).agg(low, high), "phrase-kinds")
    several = kinds.groupBy("gram").agg(F.count("*").alias("k")).where("k > 1").select("gram", F.lit(1).alias("mixed"))
    tagged = materialise(found.join(kinds.join(several, "gram", "left"), kind).where("low < high or mixed = 1")
                         .drop("gram", "whole"), "tagged-phrases")
    ranges = tagged.where("low < high").select(
        "row_no", F.col("first").alias("s"), (F.col("first") + F.col("count") - 1 + width).alias("e"))
    sent = tagged.where("mixed = 1 and (low = high or row_no = low or row_no = high)")
    index = rows.select("row_no", "doc_id", "d1", "d2")
    wanted = materialise(listed(sent, ["anchor", "first", "count"], index), "mixed-word-phrases")
    windows = materialise(window_rows(texts_of(docs, wanted, text), width, gram), "windows")
    key = ["gram", "offset", "whole"]
    shared = materialise(windows.groupBy(*key).agg(low, high).where("low < high").select(*key), "shared-windows")
    ranges = ranges.unionAll(windows.join(shared, key).select(
        "row_no", F.col("p").alias("s"), (F.col("p") + width).alias("e")))

    return materialise(
        rows.select("row_no", "doc_id", "d1", "d2", "n_words").join(merged(ranges), "row_no", "left")
        .withColumn("n_removed", F.coalesce("n_removed", F.lit(0)).cast("bigint"))
        .withColumn("spans", F.coalesce("spans", F.expr("cast(array() as array<array<bigint>>)"))), "word-spans")


def without_words(text: bytes, spans) -> bytes:
    """The text without the bytes from the first to the last word of every span."""
    starts, stops = word_places(text)
    return without(text, [(int(starts[a]), int(stops[b - 1])) for a, b in spans])


def cut_passages(docs: DataFrame, spans: DataFrame, text: str = "text") -> DataFrame:
    """The documents with shared passages taken out of their texts, other columns as they are."""
    return cut_texts(docs, spans, text, without_words)
