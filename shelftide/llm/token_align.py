"""Alignment of two tokenizers by interval coalescing over byte ranges.

A text is encoded twice: blank + text by a byte-level vocabulary (A), and the text by a piece vocabulary
that adds that blank itself (B). Both token rows cover the same bytes. All A and B tokens are sorted by
(start, tokenizer) together; the running maximum of their ends breaks them into groups wherever a start
reaches it, that is at the offsets where tokens of both end. Inside a group every A token is linked with
every B token.

How many documents hold an id pair linked is counted over the corpus: each document sends its distinct
pairs once, with partial sums. The counts come back to the documents in two ways, so that no pair that
stands in most documents is a join key: the ``COMMON`` most frequent pairs at most, cut by a power of two
of their counts, are broadcast; all rarer ones are joined, of which a pair has few rows.

Links are never listed one by one: a document keeps (pair, number of links), a large group only the
distinct ids of each side.

Defined results: a null or empty text, and one whose joined A or B bytes are not blank + text (an unknown
piece, a written U+2581), has no tokens: zeros and an empty digest; repeated rows count as documents of
their own; a text of any length is encoded whole, in memory in proportion to that text; pairs tied at an
A id's highest count are all best; an empty table gives no rows; the input's other columns are not
looked at, so their names cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelftide.llm.bpe import byte_letters
from shelftide.llm.common import strings, with_columns
from shelftide.session import materialise

#: Frequent pairs that are broadcast at most: 17 bytes each, under 5 MB.
COMMON = 1 << 18
#: A pair of ids in one long value.
SIDE = 32
#: Links expanded at a time.
BLOCK = 1 << 20
#: Runs of white space that the faster library's pattern cannot take.
LONG_BLANK = re.compile(r"\s{2000}")
LINK, ITEM, GROUP = b"|,;"


class ByteSide:
    """Ids and token bytes of a byte-level vocabulary, by its ranks file; the strings of special tokens
    are ordinary text. Texts with long runs of white space go through the tokenizers library."""

    def __init__(self, vocabulary: str):
        self.slow = Tokenizer.from_file(vocabulary)
        self.slow.no_truncation()
        self.slow.no_padding()
        self.slow.encode_special_tokens = True
        letters = byte_letters()
        special = self.slow.get_added_tokens_decoder()
        vocab = self.slow.get_vocab()
        self.bytes_of = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if i not in special:
                self.bytes_of[i] = bytes(letters[c] for c in token)
        with open(vocabulary.replace(".json", ".tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("byte-side", pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if LONG_BLANK.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class PieceSide:
    """Ids and token bytes of a piece vocabulary with byte fallback."""

    def __init__(self, model: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        self.bytes_of = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes_of.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i)
                                 else piece.replace("▁", " ").encode())

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


def sizes(bytes_of: list[bytes]) -> np.ndarray:
    return np.array([len(b) for b in bytes_of], np.int64)


def coalesced(a_ends: np.ndarray, b_ends: np.ndarray):
    """Order of all tokens (A first, then B, as one row) by start, and the group of each in that order."""
    ends = np.concatenate([a_ends, b_ends])
    starts = np.concatenate([[0], a_ends[:-1], [0], b_ends[:-1]])
    side = np.repeat([0, 1], [len(a_ends), len(b_ends)])
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.concatenate([[False], starts[order][1:] >= reach[:-1]])
    return order, np.cumsum(breaks)


def decimals(size: int) -> np.ndarray:
    """The decimal digits of all ids below ``size``, right-aligned, with zero bytes before them."""
    ids, width = np.arange(size), len(str(size - 1))
    powers = 10 ** np.arange(width - 1, -1, -1)
    out = (ids[:, None] // powers % 10 + ord("0")).astype(np.uint8)
    out[(ids[:, None] < powers) & (powers > 1)] = 0
    return out


def written(digits: np.ndarray, ids: np.ndarray, side: np.ndarray, group: np.ndarray) -> bytes:
    """``a1,a2|b1;a3|b2``, for ids sorted by (group, side, place)."""
    out = np.empty((len(ids), digits.shape[1] + 1), np.uint8)
    out[:, :-1] = digits[ids]
    after = out[:, -1]
    after[:] = ITEM
    after[:-1][side[1:] > side[:-1]] = LINK
    after[:-1][group[1:] > group[:-1]] = GROUP
    after[-1] = 0
    return out.tobytes().replace(b"\0", b"")


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(keys, return_inverse=True)
    return keys, np.bincount(at, counts, len(keys)).astype(np.int64)


def linked(ids: np.ndarray, first: np.ndarray, n_a: np.ndarray, n_b: np.ndarray):
    """Distinct pairs and their links, for ids sorted by (group, side): group g has its A ids at first[g]
    and its B ids behind them."""
    pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    products = n_a * n_b
    large = products > BLOCK // 16
    for g in np.flatnonzero(large).tolist():
        x, m = np.unique(ids[first[g]:first[g] + n_a[g]], return_counts=True)
        y, k = np.unique(ids[first[g] + n_a[g]:first[g] + n_a[g] + n_b[g]], return_counts=True)
        rows = max(1, BLOCK // len(y))
        for at in range(0, len(x), rows):
            pairs.append(((x[at:at + rows, None] << SIDE | y).ravel(),
                          (m[at:at + rows, None] * k).ravel()))
    small = np.flatnonzero(~large)
    cuts = np.searchsorted(np.cumsum(products[small]), np.arange(0, products[small].sum(), BLOCK), "right")
    cuts = [*np.unique(cuts), len(small)]
    for low, high in zip(cuts, cuts[1:]):
        own = small[low:high]
        n, each = products[own], np.repeat(np.arange(len(own)), products[own])
        at = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
        wide = n_b[own][each]
        left = first[own][each] + at // wide
        right = (first[own] + n_a[own])[each] + at % wide
        pairs.append(np.unique(ids[left] << SIDE | ids[right], return_counts=True))
    if len(pairs) == 2:
        return pairs[1]
    return summed(np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs]))


class Aligner:
    def __init__(self, byte_vocabulary: str, piece_model: str):
        self.a, self.b = ByteSide(byte_vocabulary), PieceSide(piece_model)
        self.a_sizes, self.b_sizes = sizes(self.a.bytes_of), sizes(self.b.bytes_of)
        self.digits = decimals(max(len(self.a_sizes), len(self.b_sizes)))

    def align(self, text: str):
        """n_a, n_b, n_groups, n_links, written groups, distinct pairs and their links; None where a text
        has no tokens."""
        if not text:
            return None
        a, b, body = self.a.encode(" " + text), self.b.encode(text), (" " + text).encode()
        if b"".join(map(self.a.bytes_of.__getitem__, a)) != body \
                or b"".join(map(self.b.bytes_of.__getitem__, b)) != body:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        order, group = coalesced(np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b]))
        side = (order >= len(a)).astype(np.int64)
        again = np.argsort(group * 2 + side, kind="stable")
        ids, side, group = np.concatenate([a, b])[order][again], side[again], group[again]
        n_all = np.bincount(group)
        n_b = np.bincount(group, side, len(n_all)).astype(np.int64)
        n_a = n_all - n_b
        keys, counts = linked(ids, np.cumsum(n_all) - n_all, n_a, n_b)
        return len(a), len(b), len(n_all), int((n_a * n_b).sum()), written(self.digits, ids, side, group), \
            keys, counts


ALIGNED = ("n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
           "pairs array<bigint>, links array<bigint>")


def lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*rows, np.zeros(0, np.int64)])))


def aligned(docs: DataFrame, byte_vocabulary: str | None = None, piece_model: str | None = None,
            text: str = "text", groups: bool = False) -> DataFrame:
    """row_no, doc_id, counts, digest, and the distinct linked id pairs (a << 32 | b) with their links;
    with ``groups`` also the written groups."""
    byte_vocabulary = byte_vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    piece_model = piece_model or public_tokenizers.path("piece_bpe_32k.model")

    def start():
        own = Aligner(byte_vocabulary, piece_model)
        none, empty = (0, 0, 0, 0, b""), np.zeros(0, np.int64)

        def work(column):
            made = [own.align(t) or (*none, empty, empty) for t in strings(column)]
            out = [pa.array([m[k] for m in made], pa.int64()) for k in range(4)]
            out.append(pa.array([hashlib.sha256(m[4]).hexdigest() if m[4] else "" for m in made], pa.string()))
            out += [lists([m[5] for m in made]), lists([m[6] for m in made])]
            return out + [pa.array([m[4].decode() for m in made], pa.string())] * groups
        return work

    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), "doc_id", F.col(f"`{text}`").alias("text"))
    added = ALIGNED + (", token_groups string" if groups else "")
    return with_columns(rows, ["text"], added, start, ["row_no", "doc_id"], rows=200)


def pair_counts(made: DataFrame) -> DataFrame:
    """pair, n (documents that hold it) and best (whether no pair of the same A id has more)."""
    counts = materialise(made.select(F.explode("pairs").alias("pair")).groupBy("pair")
                         .agg(F.count("*").alias("n")), "pair-counts")
    a = F.shiftright("pair", SIDE)
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return materialise(counts.join(most, a == F.col("a"))
                       .select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-ranks")


def floor_of(counts: DataFrame, size: int = COMMON) -> int:
    """The least power of two that at most ``size`` pairs reach by their counts."""
    by_power = {r.p: r.k for r in counts.groupBy(F.floor(F.log2("n")).cast("int").alias("p"))
                .agg(F.count("*").alias("k")).collect()}
    total, power = 0, max(by_power, default=-1) + 1
    while power > 0 and total + by_power.get(power - 1, 0) <= size:
        power -= 1
        total += by_power.get(power, 0)
    return 1 << power


def counted(made: DataFrame, counts: DataFrame, common: int = COMMON) -> DataFrame:
    """The rows of ``made`` with n_best and count_sum over their links, by the pairs' corpus counts."""
    spark = made.sparkSession
    floor = floor_of(counts, common)
    frequent = counts.where(F.col("n") >= floor).orderBy("pair").toArrow()
    table = spark.sparkContext.broadcast(tuple(frequent.column(c).to_numpy() for c in ("pair", "n", "best")))

    def start():
        keys, n, best = table.value

        def work(pairs, links):
            of = np.concatenate([[0], np.cumsum(pc.list_value_length(pairs).to_numpy(zero_copy_only=False))])
            pair, link = pairs.flatten().to_numpy(), links.flatten().to_numpy()
            row = np.repeat(np.arange(len(pairs)), np.diff(of))
            at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
            held = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
            value = np.zeros((2, len(pair)), np.int64)
            value[:, held] = link[held] * best[at[held]], link[held] * n[at[held]]
            sums = np.zeros((2, len(pairs)), np.int64)
            np.add.at(sums[0], row, value[0])
            np.add.at(sums[1], row, value[1])
            left = np.bincount(row[~held], minlength=len(pairs))
            rare = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(left)]).astype(np.int32)),
                                             pa.array(x[~held])) for x in (pair, link)]
            return [pa.array(sums[0]), pa.array(sums[1]), *rare]
        return work

    keep = ["row_no", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    rows = materialise(with_columns(
        made, ["pairs", "links"], "common_best bigint, common_sum bigint, pairs array<bigint>, links array<bigint>",
        start, keep), "rare-pairs")
    rare = (rows.select("row_no", F.explode(F.arrays_zip("pairs", "links")).alias("x"))
            .select("row_no", F.col("x.pairs").alias("pair"), F.col("x.links").alias("links"))
            .join(counts.where(F.col("n") < floor), "pair")
            .groupBy("row_no").agg(F.sum(F.col("links") * F.col("best").cast("bigint")).alias("rare_best"),
                                   F.sum(F.col("links") * F.col("n")).alias("rare_sum")))
    zero = F.lit(0).cast("bigint")
    return rows.drop("pairs", "links").join(rare, "row_no", "left").select(
        *keep, (F.col("common_best") + F.coalesce("rare_best", zero)).alias("n_best"),
        (F.col("common_sum") + F.coalesce("rare_sum", zero)).alias("count_sum"))


def alignment(docs: DataFrame, common: int = COMMON, text: str = "text") -> DataFrame:
    """One row for each document: token, group and link counts, corpus counts and the groups' digest."""
    made = materialise(aligned(docs, text=text), "aligned")
    return counted(made, pair_counts(made), common).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
