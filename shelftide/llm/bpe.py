"""Byte-pair merges of many short strings at once, for a tokenizers vocabulary file."""

from __future__ import annotations

import json

import numpy as np

NONE = np.int32(2**31 - 1)


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes stand for
    themselves, the others for the letters from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """The merge rules of a vocabulary, applied to all strings of a list in common steps.

    In each step every string merges all places of its rule of lowest rank, left to right, which is
    what merging them one by one gives: a rule that uses a merged token always ranks after the rule
    that makes it. A step looks up only pairs that the one before has changed.
    """

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        letters = {b: c for c, b in byte_letters().items()}
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        self.final = np.array([vocab[letters[b] + end] for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        self.bits = max(4, int(len(pairs) * 6).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        for rank, (key, at) in enumerate(zip(keys.tolist(), self.slot(keys).tolist())):
            while self.keys[at] >= 0 and self.keys[at] != key:
                at = at + 1 & (1 << self.bits) - 1
            if self.keys[at] < 0:
                self.keys[at], self.ranks[at] = key, rank

    def slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 20 | right
        at = self.slot(keys)
        held = self.keys[at]
        out = self.ranks[at]
        miss = np.flatnonzero((held != keys) & (held >= 0))
        out[held != keys] = NONE
        while len(miss):  # the few whose first slot holds another pair
            at[miss] = at[miss] + 1 & (1 << self.bits) - 1
            held = self.keys[at[miss]]
            found = held == keys[miss]
            out[miss[found]] = self.ranks[at[miss[found]]]
            miss = miss[~found & (held >= 0)]
        return out

    def encode(self, strings: list[bytes]) -> list[bytes]:
        """The ids of every (not empty) string as little-endian 32-bit integers."""
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        ends = np.cumsum(sizes)
        flat = np.frombuffer(b"".join(strings), np.uint8)
        ids = self.inner[flat]
        ids[ends - 1] = self.final[flat[ends - 1]]
        owner = np.repeat(np.arange(len(strings)), sizes)
        ranks = np.full(len(ids), NONE)
        same = np.flatnonzero(owner[1:] == owner[:-1])
        ranks[same] = self.rank(ids[same], ids[same + 1])
        done = []
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            least = np.minimum.reduceat(ranks, starts)
            lengths = np.diff(np.concatenate([starts, [len(ids)]]))
            best = np.repeat(least, lengths)
            over = best == NONE
            if over.any():
                done.append((owner[over], ids[over]))
                ids, ranks, owner, best = (x[~over] for x in (ids, ranks, owner, best))
                if not len(ids):
                    break
            hit = np.flatnonzero(ranks == best)
            touch = np.flatnonzero(np.diff(hit) == 1)
            if len(touch):  # places that overlap (a pair of equal tokens): every other one
                run = np.concatenate([[0], np.cumsum(np.diff(hit) != 1)])
                first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
                hit = hit[(np.arange(len(hit)) - first[run]) % 2 == 0]
            ids[hit] = self.made[ranks[hit]]
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            place = hit - np.arange(len(hit))
            ids, ranks, owner = ids[keep], ranks[keep], owner[keep]
            marked = np.zeros(len(ids) + 1, bool)
            marked[place] = marked[place - 1] = True
            ranks[marked[:-1]] = NONE
            changed = np.flatnonzero(marked[:-2])
            changed = changed[owner[changed] == owner[changed + 1]]
            ranks[changed] = self.rank(ids[changed], ids[changed + 1])
        owner = np.concatenate([d[0] for d in done]) if done else np.zeros(0, np.int64)
        values = np.concatenate([d[1] for d in done]) if done else np.zeros(0, np.int32)
        data = values[np.argsort(owner, kind="stable")].astype("<i4").tobytes()
        cut = np.concatenate([[0], 4 * np.cumsum(np.bincount(owner, minlength=len(strings)))]).tolist()
        return [data[a:b] for a, b in zip(cut, cut[1:])]
