"""Token ids in directly addressable codes, in files that Spark writes and reads.

An id is split into chunks of ``CHUNK_BITS``; level k holds the k-th chunks of the ids that reach so
far, with one bit for each that says whether the id goes on at level k + 1, and a directory of the
bits set before every ``RANK_BITS``. Token i is read by following its bits down: the rank of a set
bit is its place in the next level, so no other token is decoded.

The files are Parquet: one row is a segment of whole documents in order of their ids, at least
``SEGMENT`` tokens long where enough follow (or one document, if that is longer), with the place of its first
token in its part and its documents' ids and lengths. A part is the range of ids one task wrote.

Defined results: a null or empty text has only the end id; documents with equal ids are ordered by
their text; a null document id comes first; a text of any length is encoded whole; other columns of the documents
are not looked at; an empty table gives files without rows.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelftide.llm.bpe import Merges
from shelftide.llm.common import ROWS, strings
from shelftide.session import materialise

CHUNK_BITS = 8
RANK_BITS = 512
SEGMENT = 1 << 18
#: Entries of a worker's memo of encoded words; it is emptied when full.
MEMO = 600_000

SEGMENTS = ("part int, segment int, first bigint, n_tokens bigint, doc_ids array<bigint>, "
            "lengths array<bigint>, chunks array<binary>, bits array<binary>, ranks array<binary>")


def pack(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """The levels of unsigned 32-bit ids: chunks, continuation bits, rank directories."""
    chunks, bits, ranks = [], [], []
    rest = ids.astype(np.uint32)
    while True:
        chunks.append((rest & (1 << CHUNK_BITS) - 1).astype(np.uint8).tobytes())
        rest = rest >> CHUNK_BITS
        more = rest > 0
        bits.append(np.packbits(more, bitorder="little").tobytes())
        ends = np.add.reduceat(more, np.arange(0, len(more), RANK_BITS), dtype=np.uint32) \
            if len(more) else np.zeros(0, np.uint32)
        ranks.append(np.concatenate([[0], np.cumsum(ends)[:-1]]).astype("<u4").tobytes()
                     if len(ends) else b"")
        if not more.any():
            return chunks, bits, ranks
        rest = rest[more]


def unpack(chunks: list[bytes], bits: list[bytes]) -> np.ndarray:
    """All ids of a segment."""
    ids = None
    for c, b in zip(reversed(chunks), reversed(bits), strict=True):
        level = np.frombuffer(c, np.uint8).astype(np.uint32)
        if ids is not None:
            more = np.unpackbits(np.frombuffer(b, np.uint8), count=len(level), bitorder="little")
            level[more.astype(bool)] |= ids << CHUNK_BITS
        ids = level
    return ids


def token_at(chunks: list[bytes], bits: list[bytes], ranks: list[bytes], i: int) -> int:
    """One id by its place in the segment, without decoding any other."""
    value = 0
    for k, chunk in enumerate(chunks):
        value |= chunk[i] << (CHUNK_BITS * k)
        if not bits[k][i >> 3] >> (i & 7) & 1:
            return value
        block = i // RANK_BITS
        low = block * RANK_BITS // 8
        before = int.from_bytes(bits[k][low:i >> 3], "little").bit_count()
        within = (bits[k][i >> 3] & (1 << (i & 7)) - 1).bit_count()
        i = int.from_bytes(ranks[k][4 * block:4 * block + 4], "little") + before + within
    raise ValueError("a continuation bit is set on the last level")


#: Texts without characters that normalisation, case or the pre-tokenizer could treat specially:
#: blanks, line feeds, printable ASCII, and letters of Latin-1 and Latin Extended-A with plain
#: lower-case forms.
PLAIN = re.compile("[\\n -~À-ÖØ-öø-įĲ-ňŊ-ž]*")
LETTERS = "a-zß-öø-ÿā-ž"
#: The vocabulary's pre-tokenizer on such texts in lower case.
WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9 \\n]+")


class WordEncoder:
    """Ids of texts for a vocabulary that drops white space, so words are encoded apart and kept.

    Plain texts are cut into words by the vocabulary's own pattern, and new words are merged by its
    rules. Others are cut at blanks and line feeds, which are white space to any pattern and across
    which no rule of the tokenizer looks; their plain pieces go the same way, and the rest, with
    strings of special tokens, through the library.
    """

    def __init__(self, vocabulary: str):
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merges = Merges(vocabulary)
        self.words: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of every text as little-endian unsigned 32-bit integers."""
        rows, odd = [], {}
        for text in texts:
            if PLAIN.fullmatch(text) and "<|" not in text:
                rows.append(WORDS.findall(text.lower()))
                continue
            row = []
            for piece in text.replace("\n", " ").split(" "):
                if PLAIN.fullmatch(piece) and "<|" not in piece:
                    row += WORDS.findall(piece.lower())
                elif piece:  # a key that no word can be
                    odd[" " + piece] = piece
                    row.append(" " + piece)
            rows.append(row)
        found = [list(map(self.words.get, row)) for row in rows]
        new = {w for row, got in zip(rows, found, strict=True) if None in got
               for w, ids in zip(row, got, strict=True) if ids is None}
        plain = [w for w in new if w[0] != " "]
        fresh = dict(zip(plain, self.merges.encode([w.encode() for w in plain]), strict=True))
        others = [w for w in new if w[0] == " "]
        made = self.tokenizer.encode_batch_fast([odd[w] for w in others], add_special_tokens=False)
        fresh |= {w: np.array(e.ids, "<u4").tobytes() for w, e in zip(others, made, strict=True)}
        if len(self.words) + len(fresh) > MEMO:
            self.words = {}
        self.words.update(fresh)
        return [b"".join(got) if None not in got else b"".join(
            [fresh[w] if ids is None else ids for w, ids in zip(row, got, strict=True)])
            for row, got in zip(rows, found, strict=True)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(vocabulary: str) -> WordEncoder:
    """One for each worker process: its memo is of use to the tasks after."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = WordEncoder(vocabulary)
    return _ENCODERS[vocabulary]


def segments_of(docs: DataFrame, vocabulary: str, end_id: int, segment: int = SEGMENT) -> DataFrame:
    """Encode documents in ascending order of ids and pack them into segments."""
    ordered = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode, part = encoder(vocabulary), TaskContext.get().partitionId()
        ids, lengths, streams, held, first, number = [], [], [], 0, 0, 0

        def row():
            chunks, bits, ranks = pack(np.frombuffer(b"".join(streams), "<u4"))
            values = (part, number, first, held, ids, lengths, chunks, bits, ranks)
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()),
                     pa.list_(pa.int64()), *[pa.list_(pa.binary())] * 3)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, kinds, strict=True)],
                names=[x.split()[0] for x in SEGMENTS.split(", ")])

        for part_rows in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            for doc_id, stream in zip(part_rows.column(0).to_pylist(),
                                      encode(strings(part_rows.column(1))), strict=True):
                stream += end
                ids.append(doc_id)
                lengths.append(len(stream) // 4)
                streams.append(stream)
                held += lengths[-1]
                if held >= segment:
                    yield row()
                    first, number = first + held, number + 1
                    ids, lengths, streams, held = [], [], [], 0
        if ids:
            yield row()

    return ordered.mapInArrow(run, SEGMENTS)


def write_tokens(docs: DataFrame, vocabulary: str | None = None, end_id: int = 1,
                 segment: int = SEGMENT) -> DataFrame:
    """Write the files to the shared folder; the returned table reads them."""
    vocabulary = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    return materialise(segments_of(docs, vocabulary, end_id, segment), "token-files")


def part_starts(files: DataFrame) -> DataFrame:
    """Tokens before each part: one row for each task that wrote, so small enough to broadcast."""
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    return sums.select("part", before.alias("part_start"))


def read_documents(files: DataFrame) -> DataFrame:
    """doc_id, place of its first token among all, and ids of every document, from the files."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids = unpack(r["chunks"], r["bits"]).astype("<u4")
                ends = np.cumsum(r["lengths"])
                starts = ends - r["lengths"]
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()),
                     pa.array([r["part"]] * len(ends), pa.int32()),
                     pa.array(starts + r["first"], pa.int64()),
                     pa.array(r["lengths"], pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "part", "at", "n_tokens", "ids_crc32"])

    docs = files.select(*[x.split()[0] for x in SEGMENTS.split(", ")]).mapInArrow(
        run, "doc_id bigint, part int, at bigint, n_tokens bigint, ids_crc32 bigint")
    return (docs.join(F.broadcast(part_starts(files)), "part")
            .select("doc_id", (F.col("part_start") + F.col("at")).alias("start"),
                    "n_tokens", "ids_crc32"))


def tokens(files: DataFrame, start: int, count: int) -> list[int]:
    """``count`` ids from place ``start``: reads the segments that hold them, decodes only those ids."""
    placed = files.join(F.broadcast(part_starts(files)), "part").withColumn(
        "at", F.col("part_start") + F.col("first"))
    rows = (placed.where((F.col("at") < start + count) & (F.col("at") + F.col("n_tokens") > start))
            .orderBy("at").collect())
    out = []
    for r in rows:
        out += [token_at(r.chunks, r.bits, r.ranks, i)
                for i in range(max(0, start - r["at"]), min(r.n_tokens, start + count - r["at"]))]
    return out
