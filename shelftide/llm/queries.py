"""The registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelftide.llm import (
    decontaminate, forced_bpe, html_text, lattice_lm, license_scan, near_texts, near_vectors, passages,
    quality, repeats, sharding, spelling, token_align, token_files)
from shelftide.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).select(
        "doc_id", (quality.remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        "predicted")


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_forced_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forced_bpe.digests(forced_bpe.encoded(table(spark, sf_dir, "documents")))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_tokens(table(spark, sf_dir, "documents"))
    return token_files.read_documents(files)


def op5_near_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_texts.near_duplicates(table(spark, sf_dir, "documents")).drop("digest")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = sharding.sharded(table(spark, sf_dir, "documents"), shards=40)
    return made.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                       "grown_shard", "virtual_slot", "balanced_shard")


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = repeats.kept_digests(docs, repeats.repeated_spans(docs))
    # Equal rows share the same words, so one of them stands for all.
    shared = (passages.shared_spans(docs).groupBy("doc_id", "d1", "d2")
              .agg(F.max("n_removed").alias("shared_words"))
              .select(F.col("doc_id").alias("id"), F.col("d1").alias("e1"), F.col("d2").alias("e2"), "shared_words"))
    same = ((F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2"))
            & F.col("doc_id").eqNullSafe(F.col("id")))
    return made.join(shared, same).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256",
        "shared_words")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = html_text.extracted(table(spark, sf_dir, "pages"))
    return made.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op9_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.scored(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = decontaminate.contamination(table(spark, sf_dir, "documents"),
                                       table(spark, sf_dir, "benchmark"))
    hit = decontaminate.hit_words()
    return made.select("doc_id", "n_words", hit.alias("n_hit"),
                       F.size("hit_items").cast("bigint").alias("n_items"),
                       F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
                       (hit > 0).alias("contaminated"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.alignment(table(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(license_scan.scanned(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (
    op1_quality, op2_near_vectors, op3_forced_bpe, op4_token_files, op5_near_texts, op6_sharding,
    op7_repeats, op8_html_text, op9_lattice_lm, op10_decontaminate, op11_spelling, op12_token_align,
    op13_license_scan)}

_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

#: DuckDB statements, where SQL says the same on whole tables.
ORACLE: dict[str, str] = {
    "op2_near_vectors": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id, vec_id AS r FROM v
  UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.r),
n AS (SELECT a, count(*) AS c FROM links GROUP BY 1)
SELECT reach.vec_id, coalesce(max(n.c), 0) AS n_links, min(r) AS component_id,
  reach.vec_id = min(r) AS kept
FROM reach LEFT JOIN n ON n.a = reach.vec_id GROUP BY reach.vec_id""",
    "op5_near_texts": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (
  SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
c AS (SELECT doc_id, g, count(*) AS c FROM s GROUP BY 1, 2),
t AS (SELECT doc_id, CAST(sum(c) AS BIGINT) AS n FROM c GROUP BY 1),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.c, b.c)) AS o
  FROM c a JOIN c b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
near AS (
  SELECT a, b FROM p JOIN t x ON x.doc_id = a JOIN t y ON y.doc_id = b
  WHERE o >= 0.8 * (x.n + y.n - o)),
links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach AS (
  SELECT doc_id, doc_id AS r FROM d
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r)
SELECT reach.doc_id, min(r) AS cluster_id, coalesce(max(t.n), 0) AS n_shingles,
  reach.doc_id = min(r) AS kept
FROM reach LEFT JOIN t ON t.doc_id = reach.doc_id GROUP BY reach.doc_id""",
    "op10_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT id, least(10, len(w)) AS n, array_to_string(w[i:i + 9], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dg AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, dg.n, id FROM dg JOIN win ON win.g = dg.g AND win.n = dg.n),
pos AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
its AS (
  SELECT doc_id, count(DISTINCT id) AS n_items,
    sha256(string_agg(DISTINCT id, ',' ORDER BY id)) AS items FROM hit GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, coalesce(items, sha256('')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN pos ON pos.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id""",
}
