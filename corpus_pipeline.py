"""The corpus pipeline: each stage works on all that the one before it kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but
the last return the columns of ``documents``, whatever other columns they have and whatever those are named.

Defined results: a null text counts as empty and stays null where its document stays; an empty text gets the
classifier's decision, and is neither copy, nor repeat, nor contaminated, and has no tokens; texts of any
length are worked on whole; documents tied at the classifier's threshold are kept; of repeated rows with
words one stays, of those without words all; of near copies the one with the smallest id; a null id is an id
like any other; empty documents give an empty result at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelftide.llm import decontaminate, forced_bpe, near_texts, passages, quality
from shelftide.llm.common import column, table
from shelftide.session import materialise


def apart(docs: DataFrame) -> DataFrame:
    """The documents with their columns under reserved names, so that an operator's own columns (score,
    n_words and so on) do not take the place of columns that documents already have."""
    return docs.toDF(*[f"own__{c}" for c in docs.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    own = apart(docs)
    scored = quality.scored(own, model, "own__text", carry=own.columns)
    return scored.where("predicted = 1").select(*map(column, own.columns)).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies stays: the one with the smallest id."""
    return near_texts.deduplicated(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ``passages.WIDTH`` (50) words or more that another document holds too are taken out of all
    their texts, from their first word to their last; no document goes."""
    cut = passages.cut_passages(docs, passages.shared_spans(docs))
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else cut


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    own = apart(docs)
    found = decontaminate.contamination(own, table(spark, sf_dir, "benchmark"), "own__text", own.columns)
    return found.where(F.size("hit_ranges") == 0).select(*map(column, own.columns)).toDF(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the remaining texts, with digests of the ids and of the text they decode to."""
    return forced_bpe.digests(forced_bpe.encoded(docs), "ids")


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", drop_near_copies),
    ("repeats", cut_repeats),
    ("decontaminate", drop_contaminated),
    ("tokens", encode),
]

#: No stage but the filters themselves can be put in SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
