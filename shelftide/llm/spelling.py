"""Groups of spelling variants by k-d trees over letter-count vectors.

Two words are near if one inserted, deleted or replaced code point makes them equal. One edit changes at
most one letter count up by one and one down by one (L1 distance at most two), so the words near a word
lie in a small box around its vector of letter counts; code points share a count when they agree in their
last five bits, which keeps that bound.

1. Every document's words are counted once in its task; the counts are summed by word.
2. For each word length a k-d tree is cut on a bounded sample of the words (``SAMPLE``). Its leaves are
   cells: every word lies in one cell of its length's tree. A length without sampled words is one cell.
3. As a query, a word visits the cells of its own length that its box (one count up, one down) reaches and
   those of the next length (one up): each ordered pair of one length, and each pair of a word and a
   longer one, meets in exactly one cell. Cells grow in number with the words, not in size.
4. A cell's words make a k-d tree of their own inside the task, through which its visitors pass in slices;
   words of a leaf whose vectors agree within the box (first by the parity of their counts, one bit a letter)
   are verified by the order of their letters.
5. Near pairs are reduced to a count and a best form for each word, and forms are followed to the last by
   rounds of joins of those not yet at an end. A form has at least twice the count, so chains are short.

Defined results: null and empty texts have no words; a null document id stands as an empty string in the
hash of the noise; equal rows count twice; of forms with equal counts the smallest in code-point order is
taken; words of any length are compared whole; a table without words gives no rows; other columns of the
input are not looked at, so their names cannot clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftide.llm.common import utf8
from shelftide.session import materialise

#: A-Z in lower case, as bytes.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Every so many words of all documents lose a letter.
NOISE = 97
LENGTH, OCCURRENCES = 5, 3
#: Words on which the trees are cut, about, and words in a cell, about.
SAMPLE, CELL = 1 << 16, 2048
#: Words in a leaf of the tree inside a cell; queries taken through it at a time.
LEAF, SLICE = 64, 4096
#: Letters (5 bits) of a count vector, and cells of one length in a cell's number.
LETTERS, CELLS = 32, 1 << 32
#: Letters compared at a time when pairs are verified.
BLOCK = 1 << 23
FORM_RATIO = 2


def words(docs: DataFrame, text: str = "text", least: int = OCCURRENCES, length: int = LENGTH) -> DataFrame:
    """word, n and size of all words with enough letters and occurrences."""
    run_of_letters = re.compile("[A-Za-zÀ-ÿ]{%d,}" % length)  # a shorter one stays shorter

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def sent():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()),
                                               pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at in range(0, batch.num_rows, 200):
                for i, t in zip(ids[at:at + 200], utf8(batch.column(1).slice(at, 200)), strict=True):
                    before = zlib.crc32(f"{i or ''}:".encode())
                    for w, n in Counter(run_of_letters.findall(t.translate(LOWER).decode())).items():
                        h = zlib.crc32(w.encode(), before)
                        if h % NOISE == 0:  # the document's noise: one code point less
                            w = w[:h % len(w)] + w[h % len(w) + 1:]
                            if len(w) < length:
                                continue
                        counts[w] = counts.get(w, 0) + n
                if len(counts) > 100_000:  # a bound on memory; the sums go on in Spark
                    yield sent()
                    counts.clear()
        yield sent()

    sent = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return (sent.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least).withColumn("size", F.char_length("word").cast("bigint")))


def letters(column: list[str]) -> np.ndarray:
    """Words of one length as a matrix of code points; all are below 256."""
    return np.frombuffer("".join(column).encode("latin-1"), np.uint8).reshape(len(column), -1)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """How often each class of letters stands in each word."""
    n = len(codes)
    at = np.repeat(np.arange(n), codes.shape[1]) * LETTERS + (codes & LETTERS - 1).ravel()
    return np.bincount(at, minlength=n * LETTERS).reshape(n, LETTERS)


class KdTree:
    """A k-d tree over count vectors, cut at medians of the letter that varies most."""

    def __init__(self, vectors: np.ndarray, leaf: int):
        self.nodes: list[tuple[int, int, int, int]] = []  # letter, threshold, left, right; leaf: -1, number, 0, 0
        self.leaves: list[np.ndarray] = []
        todo = [(np.arange(len(vectors)), -1, 0)]
        while todo:
            own, parent, side = todo.pop()
            if parent >= 0:
                node = list(self.nodes[parent])
                node[2 + side] = len(self.nodes)
                self.nodes[parent] = tuple(node)
            cut = self.cut(vectors[own]) if len(own) > leaf else None
            if cut is None:
                self.nodes.append((-1, len(self.leaves), 0, 0))
                self.leaves.append(own)
                continue
            low = vectors[own, cut[0]] <= cut[1]
            self.nodes.append((*cut, 0, 0))
            todo += [(own[~low], len(self.nodes) - 1, 1), (own[low], len(self.nodes) - 1, 0)]

    @staticmethod
    def cut(vectors: np.ndarray):
        letter = int(np.argmax(vectors.var(0)))
        column = vectors[:, letter]
        if column.min() == column.max():
            return None
        at = int(np.median(column))
        return letter, at if at < column.max() else at - 1

    def homes(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector."""
        out = np.zeros(len(vectors), np.int64)
        for leaf, own in self.visits(vectors, 0, 0):
            out[own] = leaf
        return out

    def visits(self, vectors: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves with the vectors from which they can be reached by raising counts by ``up`` in all and
        lowering them by ``down`` in all."""
        n = len(vectors)
        todo = [(0, np.arange(n), np.full(n, up), np.full(n, down), {}, {})]
        while todo:
            at, own, ups, downs, low, high = todo.pop()
            letter, threshold, left, right = self.nodes[at]
            if letter < 0:
                yield threshold, own
                continue
            v = vectors[own, letter]
            # Beyond what the box above already asked for in this letter.
            less = np.maximum(v - threshold, 0) - (np.maximum(v - high[letter], 0) if letter in high else 0)
            more = np.maximum(threshold + 1 - v, 0) - (np.maximum(low[letter] - v, 0) if letter in low else 0)
            for child, cost, budget, box in ((left, less, downs, (low, high | {letter: threshold})),
                                             (right, more, ups, (low | {letter: threshold + 1}, high))):
                go = cost <= budget
                if go.any():
                    paid = budget[go] - cost[go]
                    other = (ups if budget is downs else downs)[go]
                    todo.append((child, own[go], *((other, paid) if budget is downs else (paid, other)), *box))


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether b is a with one more letter."""
    head = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(1)
    tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return head + tail >= a.shape[1]


def parities(vectors: np.ndarray) -> np.ndarray:
    """One bit for each letter: whether its count is odd. Bits that differ are at most the L1 distance."""
    return (vectors & 1).astype(np.uint32) @ (np.uint32(1) << np.arange(LETTERS, dtype=np.uint32))


class Cell:
    """Words of one length, to be searched for words near others."""

    def __init__(self, column: list[str], leaf: int = LEAF):
        self.codes = letters(column)
        self.vectors = letter_counts(self.codes)
        self.parities = parities(self.vectors)
        self.tree = KdTree(self.vectors, leaf)

    def near(self, column: list[str], longer: bool) -> tuple[np.ndarray, np.ndarray]:
        """Places of queries and of the cell's words near them. The queries are of one length: that of the
        words, or one letter less (``longer``)."""
        codes = letters(column)
        vectors = letter_counts(codes)
        odd = parities(vectors)
        same = one_inserted if longer else one_replaced
        pairs = [np.zeros((2, 0), np.int64)]
        for leaf, own in self.tree.visits(vectors, 1, 0 if longer else 1):
            points = self.tree.leaves[leaf]
            step = max(1, BLOCK // (len(points) * max(LETTERS, codes.shape[1])))
            for low in range(0, len(own), step):
                part = own[low:low + step]
                bits = np.bitwise_count(odd[part, None] ^ self.parities[points])
                q, p = np.nonzero(bits == 1 if longer else (bits == 0) | (bits == 2))
                q, p = part[q], points[p]
                gap = np.abs(vectors[q] - self.vectors[p]).sum(1)
                q, p = (x[gap <= (1 if longer else 2)] for x in (q, p))
                pairs.append(np.stack([q, p])[:, same(codes[q], self.codes[p])])
        return tuple(np.concatenate(pairs, axis=1))


def trees(found: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> dict[int, KdTree]:
    """A tree for each length, cut on about ``sample`` words taken by their hash."""
    total = found.count()
    every = max(1, total // sample)
    rows = found.where(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).select("word", "size").toArrow()
    by_size: dict[int, list[str]] = {}
    for w, n in zip(rows.column("word").to_pylist(), rows.column("size").to_pylist(), strict=True):
        by_size.setdefault(n, []).append(w)
    return {n: KdTree(letter_counts(letters(sorted(ws))), max(8, cell // every)) for n, ws in by_size.items()}


def met(found: DataFrame, by_size: dict[int, KdTree]) -> DataFrame:
    """(cell, kind, word, n): every word once in its home cell (kind 0), and as a query in the cells of its
    own (kind 1) and of the next length (kind 2) that its box reaches."""
    held = found.sparkSession.sparkContext.broadcast(by_size)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                word, n = part.column(0).to_pylist(), part.column(1).to_numpy()
                size = part.column(2).to_numpy()
                cells, kinds, rows = [], [], []
                for length in np.unique(size).tolist():
                    own = np.flatnonzero(size == length)
                    vectors = letter_counts(letters([word[i] for i in own]))
                    for kind, there, up, down in ((0, length, 0, 0), (1, length, 1, 1), (2, length + 1, 1, 0)):
                        tree = held.value.get(there)
                        reached = tree.visits(vectors, up, down) if tree else [(0, np.arange(len(own)))]
                        for leaf, who in reached:
                            cells.append(np.full(len(who), there * CELLS + leaf))
                            kinds.append(np.full(len(who), kind))
                            rows.append(own[who])
                at_rows = np.concatenate(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(cells)), pa.array(np.concatenate(kinds).astype(np.int32)),
                     part.column(0).take(pa.array(at_rows)), pa.array(n[at_rows])],
                    names=["cell", "kind", "word", "n"])

    return found.select("word", "n", "size").mapInArrow(run, "cell bigint, kind int, word string, n bigint")


def near_pairs(found: DataFrame, by_size: dict[int, KdTree], leaf: int = LEAF) -> DataFrame:
    """(word, n, near, near_n) of every ordered pair of near words."""
    def slices(batches):
        """(cell, kind, words, counts) in the order of the rows, at most ``SLICE`` queries at a time."""
        for batch in batches:
            cell, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            n = batch.column(3).to_numpy()
            cuts = np.flatnonzero((cell[1:] != cell[:-1]) | (kind[1:] != kind[:-1])) + 1
            for low, high in zip([0, *cuts], [*cuts, len(cell)]):
                for at in range(low, high, SLICE):
                    stop = min(high, at + SLICE)
                    yield int(cell[low]), int(kind[low]), batch.column(2).slice(at, stop - at).to_pylist(), n[at:stop]

    def run(batches):
        at, column, counts, points = None, [], [], None
        for cell, kind, word, n in slices(batches):
            if cell != at:
                at, column, counts, points = cell, [], [], None
            if kind == 0:
                column += word
                counts.append(n)
                continue
            if not column:  # a cell without words of its own
                continue
            if points is None:
                points, all_counts = Cell(column, leaf), np.concatenate(counts)
            q, p = points.near(word, kind == 2)
            a, b = pa.array(word, pa.string()).take(pa.array(q)), pa.array(column, pa.string()).take(pa.array(p))
            x, y = pa.array(n[q]), pa.array(all_counts[p])
            yield pa.RecordBatch.from_arrays([a, x, b, y], names=["word", "n", "near", "near_n"])
            if kind == 2:  # met once, counts both ways
                yield pa.RecordBatch.from_arrays([b, y, a, x], names=["word", "n", "near", "near_n"])

    rows = met(found, by_size).repartition("cell").sortWithinPartitions("cell", "kind")
    return rows.mapInArrow(run, "word string, n bigint, near string, near_n bigint")


def rooted(forms: DataFrame) -> DataFrame:
    """word, root: forms (word, form) followed to the last one."""
    done, going = None, forms.select("word", F.col("form").alias("root"))
    step = forms.select(F.col("word").alias("root"), F.col("form").alias("next"))
    while True:
        going = materialise(going.join(step, "root", "left").select(
            "word", "root", "next"), "roots")
        ended = going.where("next is null").select("word", "root")
        done = ended if done is None else done.unionAll(ended)
        going = going.where("next is not null").select("word", F.col("next").alias("root"))
        if going.isEmpty():
            return done


def variants(docs: DataFrame, text: str = "text", sample: int = SAMPLE, cell: int = CELL,
             leaf: int = LEAF) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word."""
    found = materialise(words(docs, text), "words")
    pairs = near_pairs(found, trees(found, sample, cell), leaf)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = materialise(pairs.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best")), "near-words")
    chosen = F.when(-F.col("best.less") >= FORM_RATIO * F.col("n"), F.col("best"))
    near = near.select("word", "n_near", chosen["near"].alias("form"), (-chosen["less"]).alias("form_n"))
    roots = rooted(near.where("form is not null").select("word", "form"))
    return (found.join(near, "word", "left").join(roots, "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form", "form_n",
                    F.coalesce("root", "word").alias("root")))
