"""Token operators against the tokenizers library, sharding and decontamination against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelftide.llm import decontaminate, forced_bpe, queries, sharding, token_files

SF_DIR = "/root/testdata/sf0.001"
ODD = ["", None, " ", "a", "  x  y", "don't 'S ''s ,'s 。's it's\t\n  é", "a 　b  c",
       "<|endoftext|>x <|startoftext|> y<|endoftext|>", "ΑΣ ΣΑΣ. İI", "é ́e", "\x1c\x85 \x00z",
       "日本語 テキスト😀😀 !!!...", "x" * 5000, "ab " * 4000, "\r\n\r\n \n", "1234567890 12,3 ½²"]


def odd_docs(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)] + [(3, "a", "y")],
                                 "doc_id bigint, text string, ids string")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    return {r.doc_id: r.text or "" for r in rows}


def library(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.no_truncation()
    t.no_padding()
    return t


def test_forced_bpe_equals_library(spark, texts):
    lib = library("byte_bpe_50k.json")
    got = {r.doc_id: r for r in queries.op3_forced_bpe(spark, SF_DIR).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        ids = lib.encode(t, add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        text = lib.decode(ids, skip_special_tokens=False)
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_forced_bpe_odd_and_random_texts(spark):
    lib = library("byte_bpe_50k.json")
    made = forced_bpe.encoded(odd_docs(spark))
    assert made.columns == ["doc_id", "ids", "decoded"]
    for r in made.collect():
        t = ODD[r.doc_id] or ""
        assert r.ids == lib.encode(t, add_special_tokens=False).ids, t
        assert r.decoded == lib.decode(r.ids, skip_special_tokens=False)
    own, rng = forced_bpe.ForcedEncoder(public_tokenizers.path("byte_bpe_50k.json")), random.Random(5)
    alphabet = "ab sS'd  \n\t  　éñß,.!。1٣½日😀́\x85\x1f‐’ſ"
    for _ in range(4000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 14)))
        assert np.frombuffer(own.encode(t.encode()), "<i4").tolist() == lib.encode(t).ids, repr(t)


def test_forced_cuts_are_never_inside_a_token():
    own = forced_bpe.ForcedEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert own.fragments("The cat,sat 日本".encode()) != ["The cat,sat 日本".encode()]
    for token in own.bytes_of:
        if token != b"<|endoftext|>":
            a = np.frombuffer(token, np.uint8)
            assert not own.cuts[a[:-1].astype(int) * 256 + a[1:]].any()


def test_token_files_equal_library(spark, texts):
    lib = library("word_bpe_49k.json")
    got = {r.doc_id: r for r in queries.op4_token_files(spark, SF_DIR).collect()}
    start = 0
    for i in sorted(texts):
        ids = np.array(lib.encode(texts[i], add_special_tokens=False).ids + [1], "<u4")
        assert (got[i].start, got[i].n_tokens) == (start, len(ids))
        assert got[i].ids_crc32 == zlib.crc32(ids.tobytes())
        start += len(ids)
    assert len(got) == len(texts)


def test_token_files_odd_texts_and_random_access(spark):
    lib = library("word_bpe_49k.json")
    docs = odd_docs(spark)
    files = token_files.write_tokens(docs, segment=50)
    rows = sorted([(i, t or "", t is not None) for i, t in enumerate(ODD)] + [(3, "a", True)],
                  key=lambda x: (x[0], x[2], x[1]))
    want = []
    for _, t, _ in rows:
        want += lib.encode(t, add_special_tokens=False).ids + [1]
    assert token_files.tokens(files, 0, len(want)) == want
    assert token_files.tokens(files, 37, 5) == want[37:42]
    got = token_files.read_documents(files).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == [r[0] for r in rows]
    assert sum(r.n_tokens for r in got) == len(want)
    assert token_files.read_documents(token_files.write_tokens(docs.limit(0))).count() == 0


def test_packing_round_trip():
    rng = np.random.default_rng(3)
    for top in (1, 200, 70_000, 2**32 - 1):
        ids = rng.integers(0, top, 3000, dtype=np.uint64).astype(np.uint32)
        chunks, bits, ranks = token_files.pack(ids)
        assert (token_files.unpack(chunks, bits) == ids).all()
        assert all(token_files.token_at(chunks, bits, ranks, i) == ids[i] for i in range(0, 3000, 7))


def test_sharding_law(spark, texts):
    got = queries.op6_sharding(spark, SF_DIR).collect()
    assert len(got) == len(texts)
    places = {}
    for r in got:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
        places.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_sharding_edges(spark):
    docs = spark.createDataFrame([(7, "a")] * 500 + [(None, None), (8, ""), (8, "é")],
                                 "doc_id bigint, text string")
    got = sharding.sharded(docs, 3).collect()
    assert len(got) == 503 and {r.shard for r in got if r.doc_id == 7}.__len__() == 1
    for s in range(3):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert next(r for r in got if r.doc_id is None).size == 16
    assert sharding.sharded(docs.limit(0), 3).count() == 0


def test_sharding_edits_the_map_by_the_bytes_of_the_table(spark):
    rows = queries.op6_sharding(spark, SF_DIR).collect()
    size = {"shard": [0] * 40, "balanced_shard": [0] * 40}
    held = {}
    for r in rows:
        for law, per in size.items():
            per[r[law]] += r.size
        assert held.setdefault(r.virtual_slot, r.balanced_shard) == r.balanced_shard
    assert sum(size["shard"]) == sum(size["balanced_shard"])
    assert max(size["balanced_shard"]) < max(size["shard"])
    largest = max(r.size for r in rows)
    assert max(size["balanced_shard"]) <= max(1.01 * sum(size["shard"]) / 40, largest + min(size["balanced_shard"]))


def test_slot_maps_grow_into_the_new_shard_only():
    table = [0] * 4096
    for n in range(2, 60):
        new = sharding.grown(table)
        assert all(b in (a, n - 1) for a, b in zip(table, new))
        sizes = [new.count(s) for s in range(n)]
        assert max(sizes) - min(sizes) <= 1
        table = new


def test_rebalancing_edits_the_map(spark):
    maps = sharding.slot_maps(spark, 4, 64).where("version = 4")
    sizes = spark.range(64).select(F.col("id").cast("int").alias("virtual_slot"),
                                   (F.col("id") * 10 + 1).alias("bytes"))
    new = sharding.rebalanced_map(maps, sizes, 4)
    per = [r.b for r in new.join(sizes, "virtual_slot").groupBy("shard").agg(
        F.sum("bytes").alias("b")).collect()]
    assert new.count() == 64 and max(per) <= 1.02 * sum(per) / 4
    assert new.first().version == 5


def plain_contamination(texts, items, width=10):
    grams = {}
    for item, t in items:
        w = decontaminate.words_of((t or "").encode())
        for i in range(max(1, len(w) - width + 1)) if w else ():
            grams.setdefault(tuple(w[i:i + width]), set()).add(str(item) if item is not None else "")
    out = {}
    for i, t in texts.items():
        w = decontaminate.words_of((t or "").encode())
        hit, found = set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in grams:
                    hit.update(range(k, k + n))
                    found |= grams[tuple(w[k:k + n])]
        out[i] = (len(w), len(hit), sorted(found))
    return out


def test_decontamination_equals_brute_force(spark, texts):
    items = [(r.item_id, r.text) for r in
             spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    want = plain_contamination(texts, items)
    got = queries.op10_decontaminate(spark, SF_DIR).collect()
    assert len(got) == len(want) and any(r.contaminated for r in got)
    for r in got:
        n, hit, found = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(found), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()


def test_decontamination_in_blocks_and_edges(spark):
    rng = random.Random(2)
    line = lambda n: " ".join(rng.choice(["a", "B", "ç", "d-e", "7"]) for _ in range(n))
    items = [(i, line(rng.randint(1, 14))) for i in range(40)] + [(40, None), (41, "  "), (None, "a a"),
                                                                  (0, "7 7 7 7 a")]
    texts = {i: line(rng.randint(0, 200)) for i in range(30)} | {30: None, 31: ""}
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts.items()],
                                 "doc_id bigint, text string, n_words int")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = plain_contamination(texts, items)
    for block in (1000, 20):
        got = decontaminate.contamination(docs, bench, block=block).withColumn(
            "n_hit", decontaminate.hit_words()).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r.hit_items) for r in got} == want
    none = decontaminate.contamination(docs, bench.limit(0)).collect()
    assert all(r.hit_items == [] and r.hit_ranges == [] for r in none) and len(none) == 32
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
