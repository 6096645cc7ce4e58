"""Byte-level BPE by forced boundaries: a pair of bytes that is inside no vocabulary token cuts.

No merge can join two bytes that no token holds side by side, so the fragments between such cuts are
encoded independently and their ids joined. A slice of texts is cut as a whole; a fragment's ids come from a
memo or, for a new one, from the same vocabulary in the library that is quicker on short strings (a test
holds its ids against the tokenizers library, which also takes fragments with long runs of white space). The vocabulary's
pre-tokenizer looks at text too, so a cut is used only where that cannot see it:

* the left character is not white space (``\\s+(?!\\S)`` looks past a run of white space, and a
  blank joins the word after it);
* the right byte is not an apostrophe (a contraction such as ``'s`` must not become a token start
  behind other punctuation);
* the right byte starts a character, so fragments are valid UTF-8.

Everywhere else a class of characters that is cut in two gives two pre-tokens of that class, and no
token of the whole spans them. Strings of special tokens are cut out first, as the library does.

Defined results: a null or empty text has no ids and decodes to an empty text; a text of any length is
encoded whole, in memory in proportion to it; repeated rows are encoded row by row; ties do not arise, as a
vocabulary gives one encoding; an empty table gives no rows; an added column (ids, decoded) takes the place
of a carried one of its name, and other columns are not looked at.
"""

from __future__ import annotations

import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelftide.llm.bpe import byte_letters
from shelftide.llm.common import utf8, with_columns

#: Entries of a worker's memo of encoded fragments. A full one becomes the older one, from which fragments
#: that come again move on; the one before is dropped.
MEMO = 100_000
#: Runs of white space that the faster library's pattern cannot take.
LONG_BLANK = re.compile(r"\s{2000}")
BLANK = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
#: The byte before the last of a white-space character above ASCII: U+0085, U+00A0, U+1680,
#: U+2000-200A, U+2028, U+2029, U+202F, U+205F, U+3000. Others that share it only lose a cut.
WIDE_BLANK = np.isin(np.arange(256), [0xC2, 0x9A, 0x80, 0x81])


class ForcedEncoder:
    def __init__(self, vocabulary: str):
        t, letters = Tokenizer.from_file(vocabulary), byte_letters()
        self.vocabulary, self.slow = vocabulary, None
        special = {i: a.content for i, a in t.get_added_tokens_decoder().items()}
        vocab = t.get_vocab()
        self.bytes_of = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = special[i].encode() if i in special else bytes(
                letters[c] for c in token)
        joined = np.zeros((256, 256), bool)
        for i, b in enumerate(self.bytes_of):
            if i not in special and len(b) > 1:
                a = np.frombuffer(b, np.uint8)
                joined[a[:-1], a[1:]] = True
        right = np.arange(256)
        usable = ~BLANK[:, None] & (right != ord("'")) & ((right & 0xC0) != 0x80)
        self.cuts = (~joined & usable).ravel()
        self.special = re.compile(b"|".join(re.escape(s.encode()) for s in special.values())) \
            if special else None
        self.special_ids = {s.encode(): np.array([i], "<i4").tobytes() for i, s in special.items()}
        self.forget()
        ranks = {b: i for i, b in enumerate(self.bytes_of) if i not in special}
        self.fast = tiktoken.Encoding("fragments", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})

    def forget(self) -> None:
        """Empty the memo, which is of use only inside a task."""
        self.memo: dict[bytes, bytes] = dict(self.special_ids)
        self.older: dict[bytes, bytes] = {}

    def encoded_slowly(self, text: str) -> list[int]:
        if self.slow is None:
            self.slow = Tokenizer.from_file(self.vocabulary)
            self.slow.no_truncation()
            self.slow.no_padding()
        return self.slow.encode(text, add_special_tokens=False).ids

    def marks(self, text: bytes) -> np.ndarray:
        """Where a fragment may start, for places 1 to the text's end."""
        a = np.frombuffer(text, np.uint8)
        cut = self.cuts[a[:-1].astype(np.uint16) << 8 | a[1:]]
        if (a >= 0x80).any():
            cut[1:] &= ~((a[1:-1] & 0xC0 == 0x80) & WIDE_BLANK[a[:-2]])
        return cut

    def fragments(self, text: bytes) -> list[bytes]:
        at = [0, *(np.flatnonzero(self.marks(text)) + 1).tolist(), len(text)] if text else []
        return [text[i:j] for i, j in zip(at, at[1:])]

    def encoded_fragment(self, fragment: bytes) -> bytes:
        text = fragment.decode()
        if LONG_BLANK.search(text):
            ids = self.encoded_slowly(text)
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, "<i4").tobytes()

    def looked_up(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of every fragment. What the memo has lost since it was last full, an older one may hold."""
        got = list(map(self.memo.get, pieces))
        if None in got:
            for i, g in enumerate(got):
                if g is None:
                    p = pieces[i]
                    g = self.memo.get(p) or self.older.get(p) or self.encoded_fragment(p)
                    got[i] = self.memo[p] = g
            if len(self.memo) > MEMO:
                self.memo, self.older = dict(self.special_ids), self.memo
        return got

    def encode_all(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one row, and where each text starts and the last one ends."""
        body, ends = b"".join(texts), np.cumsum([len(t) for t in texts])
        if not body:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        mark = np.concatenate([[True], self.marks(body), [True]])
        mark[ends] = True  # texts never share a fragment
        for t, end in zip(texts, ends.tolist()) if self.special and self.special.search(body) else ():
            for m in self.special.finditer(t):
                mark[end - len(t) + m.start():end - len(t) + m.end()] = False
                mark[[end - len(t) + m.start(), end - len(t) + m.end()]] = True
        at = np.flatnonzero(mark)
        cuts = at.tolist()
        got = self.looked_up([body[i:j] for i, j in zip(cuts, cuts[1:])])
        sizes = np.concatenate([[0], np.cumsum(np.fromiter(map(len, got), np.int64, len(got)))]) // 4
        return (np.frombuffer(b"".join(got), "<i4"),
                np.concatenate([[0], sizes[np.searchsorted(at, ends)]]))

    def encode(self, text: bytes) -> bytes:
        """The ids as little-endian 32-bit integers."""
        return self.encode_all([text])[0].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


_ENCODERS: dict[str, ForcedEncoder] = {}


def encoder(vocabulary: str) -> ForcedEncoder:
    """One for each worker process, which runs many tasks."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = ForcedEncoder(vocabulary)
    return _ENCODERS[vocabulary]


def encoded(docs: DataFrame, vocabulary: str | None = None, text: str = "text",
            carry=("doc_id",)) -> DataFrame:
    """Adds ids (array<int>) and decoded, the text that those ids decode to."""
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")

    def start():
        own = encoder(vocabulary)

        def work(texts):
            ids, at = own.encode_all(utf8(texts))
            decoded = [own.decode(ids[i:j]) for i, j in zip(at, at[1:])]
            return [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids, pa.int32())),
                    pa.array(decoded, pa.string())]

        work.finish = own.forget
        return work

    return with_columns(docs, [text], "ids array<int>, decoded string", start, carry, rows=250)


def digests(made: DataFrame, *more: str) -> DataFrame:
    """doc_id, number of ids, digests of the ids and of the decoded text, and columns asked for."""
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return made.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                       F.sha2(ids, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"), *more)
