"""Language-model scores: a subword lattice under counted words.

A token is a word (bytes between ASCII white space, A-Z in lower case) or the end of a document.
The model backs off from words counted in the training documents to a subword model by absolute
discounting: a counted word gives up ``D`` of its count, and the mass so freed is spread over all
strings by a unigram model over the pieces of an existing vocabulary. That model's chance of a word
is marginal: the sum over all ways to cut it into pieces, by the forward recursion in log space.
Piece scores are counted over the distinct words of all training documents (a word that backs off is
new, so types, not tokens, are its likeness); the vocabulary itself is not trained. Characters
without a piece are spelled in bytes, so every word has a chance above zero, and the chances of all
words and the end sum to at most one.

Counts of words are gathered over all documents by partial sums. The ``HEAD`` words most often seen,
a fixed number, are sent to the tasks; the rest of a document's words meets the vocabulary table in a
join, in which no word is frequent any more.

Defined results: a null or empty text is one end token; a null id hashes as empty text; documents with
equal ids are scored row by row; with no training documents the base score is 0 for every token
(c = N = V = 0) and the model spreads half of each token over the subword model; a text of any length is
scored whole, word by word; words of equal counts at the bound of the frequent ones are all frequent or none;
other columns of the documents are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from math import exp, log, log10

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftide.llm.common import utf8, with_columns
from shelftide.llm.quality import remainder
from shelftide.session import materialise

#: Most frequent words sent to every task; a bounded broadcast of about 10 MB.
HEAD = 200_000
#: Words longer than this many bytes are never sent.
HEAD_BYTES = 64
#: Words a task holds before it hands on its partial counts.
HELD = 300_000
START = "▁"
LN10 = log(10)


def words_of(text: bytes) -> list[bytes]:
    """bytes.lower() changes A-Z only, bytes.split() cuts at blank and 0x09-0x0D only."""
    return text.lower().split()


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """word, c: every distinct word of all documents with its count in those not held out."""
    def run(batches):
        counts: Counter = Counter()

        def held():
            made = pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())],
                names=["word", "c"])
            counts.clear()
            return made

        for batch in batches:
            for t, out in zip(utf8(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                if out:
                    for w in words_of(t):
                        if w not in counts:
                            counts[w] = 0
                else:
                    counts.update(words_of(t))
                if len(counts) > HELD:
                    yield held()
        yield held()

    return (docs.select(F.col(f"`{text}`"), "held_out").mapInArrow(run, "word binary, c bigint")
            .groupBy("word").agg(F.sum("c").alias("c")))


class Pieces:
    """A vocabulary's pieces with log chances, and the marginal log chance of a word."""

    def __init__(self, vocabulary: str, counts: dict[int, int], types: int):
        p = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        total = float(types) + 1
        weights = {}
        spelled = np.ones(256)
        for i in range(p.get_piece_size()):
            if p.is_byte(i):
                spelled[int(p.id_to_piece(i)[3:5], 16)] += counts.get(i, 0)
            elif not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i)):
                weights[p.id_to_piece(i)] = counts.get(i, 0) + 0.01
        total += sum(weights.values()) + spelled.sum()
        self.log = {k: log(v / total) for k, v in weights.items()}
        self.spelled = [log(v / total) for v in spelled.tolist()]
        self.end = log((types + 1) / total)
        self.longest = max(map(len, self.log), default=1)

    def word(self, word: bytes) -> float:
        """Natural log of the sum over all segmentations of the word, then its end."""
        text = START + word.decode("utf-8", "replace")
        get, longest = self.log.get, self.longest
        forward = [0.0]
        for j in range(1, len(text) + 1):
            terms = []
            low = j - longest
            for i in range(low if low > 0 else 0, j):
                score = get(text[i:j])
                if score is not None:
                    terms.append(forward[i] + score)
            if get(text[j - 1]) is None:
                terms.append(forward[j - 1] + sum(self.spelled[b] for b in text[j - 1].encode()))
            if len(terms) == 1:
                forward.append(terms[0])
            else:
                top = max(terms)
                forward.append(top + log(sum([exp(t - top) for t in terms])))
        return forward[-1] + self.end


def piece_counts(words: DataFrame, vocabulary: str) -> dict[int, int]:
    """Pieces over all distinct training words; at most one row for each piece of the vocabulary."""
    def run(batches):
        p = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        counts = np.zeros(p.get_piece_size(), np.int64)
        for batch in batches:
            texts = [w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()]
            for at in range(0, len(texts), 5000):
                ids = p.encode(texts[at:at + 5000], num_threads=1)
                flat = np.fromiter((i for x in ids for i in x), np.int64)
                counts += np.bincount(flat, minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some])],
                                         names=["piece", "n"])

    rows = (words.where("c > 0").select("word").mapInArrow(run, "piece int, n bigint")
            .groupBy("piece").agg(F.sum("n").alias("n")).collect())
    return {r.piece: r.n for r in rows}


def scored_words(words: DataFrame, facts: dict, vocabulary: str) -> DataFrame:
    """word, c, base and model: log10 chances of every distinct word."""
    counts = piece_counts(words, vocabulary)

    def run(batches):
        pieces = Pieces(vocabulary, counts, facts["types"])
        for batch in batches:
            found = batch.column(0).to_pylist()
            c = np.array(batch.column(1).to_pylist(), float)
            sub = np.array([pieces.word(w) for w in found], float)
            base, model = word_logs(c, sub, facts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(base), pa.array(model)],
                names=["word", "c", "base", "model"])

    return words.select("word", "c").mapInArrow(
        run, "word binary, c bigint, base double, model double")


def base_log(c, facts: dict):
    return np.log10((c + 0.1) / (facts["tokens"] + 0.1 * (facts["distinct"] + 1)))


def word_logs(c: np.ndarray, sub: np.ndarray, facts: dict) -> tuple[np.ndarray, np.ndarray]:
    """Discounted count and backed-off mass, added in log space (sub may be far below 1e-300)."""
    whole = facts["tokens"] + 1
    freed = log((facts["discount"] * facts["types"] + 0.5) / whole)
    with np.errstate(divide="ignore"):
        seen = np.log(np.maximum(c - facts["discount"], 0) / whole)
    return base_log(c, facts), np.logaddexp(seen, sub + freed) / LN10


def end_logs(facts: dict) -> tuple[float, float]:
    return (float(base_log(facts["ends"], facts)),
            log10((facts["ends"] + 0.5) / (facts["tokens"] + 1)))


def facts_of(words: DataFrame, ends: int) -> dict:
    """Numbers of training tokens, distinct tokens, word types, and the discount (n1 / (n1 + 2 n2))."""
    r = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("t"),
                  F.count_if(F.col("c") == 1).alias("n1"),
                  F.count_if(F.col("c") == 2).alias("n2")).first()
    return {"tokens": r.n + ends, "types": r.t, "distinct": r.t + (1 if ends else 0), "ends": ends,
            "discount": r.n1 / (r.n1 + 2 * r.n2) if r.n1 else 0.5}


def frequent(scores: DataFrame, head: int) -> DataFrame:
    """The words counted at least so often that no more than ``head`` of them are.

    The bound comes from how many words have each count, so no task gathers candidates.
    """
    short = scores.where((F.col("c") > 0) & (F.octet_length("word") <= HEAD_BYTES))
    sizes = (short.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).limit(head)
             .collect())
    least, held = None, 0
    for r in sizes:
        held += r.n
        if held > head:
            break
        least = r.c
    return short.where(F.col("c") >= least) if least is not None else short.limit(0)


def scored(docs: DataFrame, vocabulary: str | None = None, head: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    vocabulary = vocabulary or public_tokenizers.path("piece_bpe_32k.model")
    spark = docs.sparkSession
    marked = docs.select("doc_id", "text", (remainder(F.col("doc_id"), 10) == 0).alias("held_out"))
    words = materialise(word_counts(marked), "words")
    facts = facts_of(words, marked.where("not held_out").count())
    scores = materialise(scored_words(words, facts, vocabulary), "word-scores")
    rows = frequent(scores, head).toArrow()
    sent = spark.sparkContext.broadcast((rows.column("word").to_pylist(),
                                         rows.column("base").to_numpy(),
                                         rows.column("model").to_numpy()))

    def start():
        known, base, model = sent.value
        place = {w: i for i, w in enumerate(known)}
        base, model = np.append(base, 0.0), np.append(model, 0.0)

        def work(texts):
            found = [[], [], [], [], [], []]
            for t in utf8(texts):
                words = words_of(t)
                at = np.array([place.get(w, -1) for w in words], np.int64)
                out = np.flatnonzero(at < 0)
                rest = Counter([words[i] for i in out.tolist()])
                values = (len(words), len(words) - len(out), float(base[at].sum()),
                          float(model[at].sum()), list(rest.keys()), list(rest.values()))
                for f, v in zip(found, values, strict=True):
                    f.append(v)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()),
                     pa.list_(pa.int64()))
            return [pa.array(f, k) for f, k in zip(found, kinds, strict=True)]
        return work

    first = materialise(with_columns(
        marked.withColumn("row_no", F.monotonically_increasing_id()), ["text"],
        "n_words bigint, known bigint, base double, model double, rest array<binary>, "
        "times array<bigint>", start, ["row_no", "doc_id", "held_out"]), "documents")
    rest = (first.select("row_no", F.explode(F.arrays_zip("rest", "times")).alias("r"))
            .select("row_no", F.col("r.rest").alias("word"), F.col("r.times").alias("times")))
    sums = (rest.join(scores, "word").groupBy("row_no").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rest_known"),
        F.sum(F.col("base") * F.col("times")).alias("rest_base"),
        F.sum(F.col("model") * F.col("times")).alias("rest_model")))
    end_base, end_model = end_logs(facts)

    def total(name):
        return F.col(name) + F.coalesce(f"rest_{name}", F.lit(0))

    return first.join(sums, "row_no", "left").select(
        "doc_id", "held_out", (F.col("n_words") + 1).alias("n_tokens"),
        (total("known") + (1 if facts["ends"] else 0)).alias("n_known"),
        F.lit(facts["tokens"]).cast("bigint").alias("train_tokens"),
        (total("base") + end_base).alias("base_score"), (total("model") + end_model).alias("score"))
