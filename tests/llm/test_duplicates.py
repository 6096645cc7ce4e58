"""Near duplicates and repeated strings against brute force; the pipeline stage by stage."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelftide.llm import near_texts, near_vectors, passages, quality, queries, repeats
from shelftide.llm.components import components
from shelftide.llm.decontaminate import words_of

SMALL = "/root/testdata/sf0.001"
SF_DIR = "/root/testdata/sf0.01"


def roots_of(nodes, pairs):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(1000, i) for i in range(2000, 2050)]
    pairs += [(rng.randint(3000, 3300), rng.randint(3000, 3300)) for _ in range(200)]
    nodes = {n for p in pairs for n in p}
    want = {n: r for n, r in roots_of(nodes, pairs).items() if n != r}
    got = components(spark.createDataFrame(pairs, "a bigint, b bigint"))
    assert {r.node: r.root for r in got.collect()} == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def plain_vectors(rows):
    use = []
    for i, (vec_id, v, label) in enumerate(rows):
        ok = v and label is not None and None not in v and np.isfinite(v).all() and any(v)
        use.append(np.array(v, float) / np.linalg.norm(v) if ok else None)
    links, pairs = Counter(), []
    for i in range(len(rows)):
        for j in range(i):
            if use[i] is not None and use[j] is not None and rows[i][2] == rows[j][2] \
                    and len(use[i]) == len(use[j]) and use[i] @ use[j] >= 0.93:
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    root = roots_of(range(len(rows)), pairs)
    name = defaultdict(list)
    for i, r in root.items():
        name[r].append(rows[i][0])
    return sorted((rows[i][0], links[i], min(name[root[i]])) for i in range(len(rows)))


def test_near_vectors_equal_brute_force(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in
            spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    got = queries.op2_near_vectors(spark, SF_DIR).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == plain_vectors(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_near_vectors_edges_and_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(1, None, 1), (2, [], 1), (3, [0.0] * 4, 1), (4, [1.0, None, 0.0, 0.0], 1),
            (5, [float("nan"), 1.0, 0.0, 0.0], 1), (6, [1.0, 0.0, 0.0, 0.0], None),
            (7, [1.0, 0.0, 0.0, 0.0], 1), (8, [9.0, 0.1, 0.0, 0.0], 1), (8, [9.0, 0.1, 0.0, 0.0], 1),
            (9, [1.0, 0.0, 0.0], 1), (10, [1.0, 0.0, 0.0, 0.0], 2), (11, [1e-30, 0.0, 0.0, 0.0], 1),
            (12, [1e30, 0.0, 0.0, 0.0], 1)]
    centre = rng.normal(size=8)
    rows += [(100 + i, (centre + rng.normal(size=8) * s).astype(np.float32).tolist(), 3)
             for i, s in enumerate(np.repeat([0.05, 0.2, 0.4], 30))]
    df = spark.createDataFrame([(*r, "x") for r in rows],
                               "vec_id bigint, embedding array<float>, label int, n_links string")
    want = plain_vectors([(r.vec_id, r.embedding, r.label) for r in df.collect()])
    for block in (512, 7):
        got = near_vectors.near_duplicates(df, block=block).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == want
    assert near_vectors.near_duplicates(df.limit(0)).count() == 0


def test_near_vectors_recall_at_the_threshold():
    rng = np.random.default_rng(5)
    k, tables = near_vectors.tables_for(5000)
    u = rng.normal(size=(4000, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    v = rng.normal(size=(4000, 64))
    v -= (u * v).sum(1, keepdims=True) * u
    v = 0.93 * u + np.sqrt(1 - 0.93 ** 2) * v / np.linalg.norm(v, axis=1, keepdims=True)
    a = near_vectors.keys_of([x.tobytes() for x in u], k, tables)
    b = near_vectors.keys_of([x.tobytes() for x in v], k, tables)
    assert (a == b).any(1).mean() > 0.995


def bag(text, size=5):
    w = words_of((text or "").encode())
    if not w:
        return Counter()
    return Counter(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def jaccard(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if a and b else 0.0


def plain_texts(rows):
    bags = [bag(t) for _, t in rows]
    holds = defaultdict(list)
    pairs = set()
    for i, b in enumerate(bags):
        for s in b:
            pairs.update((i, j) for j in holds[s])
            holds[s].append(i)
    root = roots_of(range(len(rows)), [p for p in pairs if jaccard(bags[p[0]], bags[p[1]]) >= 0.8])
    name = defaultdict(list)
    for i, r in root.items():
        name[r].append(rows[i][0])
    return sorted((rows[i][0], min(name[root[i]])) for i in range(len(rows)))


def varied(seed):
    """Groups of copies with edits from none to many, chains, and repeated runs of words."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    rows = []
    for g in range(40):
        text = [word() for _ in range(rng.randint(3, 150))]
        if g % 3 == 0:
            text = text[:9] * rng.randint(1, 9) + text
        for _ in range(rng.randint(1, 9)):
            rows.append((len(rows), " ".join(text) if rng.random() < 0.7 else ", ".join(text).upper()))
            if rng.random() < 0.6:
                text = list(text)
                for _ in range(rng.randint(1, 3)):
                    text[rng.randrange(len(text))] = word()
    return rows


def test_near_texts_equal_brute_force(spark):
    rows = varied(6) + [(900, None), (901, ""), (902, " ,. "), (903, "one two"), (904, "One, two!"),
                        (903, "one two"), (905, "a " * 3000), (906, "a " * 2900), (907, "a " * 1500)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, cid int").repartition(5)
    got = near_texts.near_duplicates(df).collect()
    assert sorted((r.doc_id, r.cluster_id) for r in got) == plain_texts(rows)
    assert all(r.kept == (r.doc_id == r.cluster_id) for r in got)
    assert near_texts.near_duplicates(df.limit(0)).count() == 0
    kept = near_texts.deduplicated(df).collect()
    assert sorted(r.doc_id for r in kept) == sorted({i for i, c in plain_texts(rows) if i == c})


def test_near_texts_in_blocks(spark, monkeypatch):
    """Copies with so many edits that most pairs of a bucket are no links; blocks of three."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(140)]
    rows = []
    for i in range(120):
        text = list(base)
        for _ in range(rng.randint(0, 7)):
            text[rng.randrange(len(text))] = word()
        rows.append((i, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(near_texts, "BLOCK", 3)
    got = near_texts.near_duplicates(df).collect()
    want = plain_texts(rows)
    assert sorted((r.doc_id, r.cluster_id) for r in got) == want
    assert 1 < len({c for _, c in want}) < 120


def test_overlaps_are_exact():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 400, rng.integers(0, 90)).astype(np.uint64)) for _ in range(25)]
    got = near_texts.overlaps(sets, step=64)
    for i in range(25):
        for j in range(25):
            if i != j:
                assert got[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_near_texts_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = queries.op5_near_texts(spark, SF_DIR).collect()
    assert sorted((r.doc_id, r.cluster_id) for r in got) == plain_texts(rows)


def test_bag_minhash_is_unbiased():
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**63, 60).astype(np.uint64)
    m = 4096
    for top in (1, 3, 40):
        w = rng.integers(0, top + 1, (2, 60))
        owner = np.repeat([0, 1], 60)
        value, weight = np.tile(base, 2), w.ravel()
        some = weight > 0
        times = near_texts.bag_minhash(2, owner[some], value[some], weight[some], m)
        assert np.isfinite(times).all()
        want = np.minimum(w[0], w[1]).sum() / np.maximum(w[0], w[1]).sum()
        assert abs((times[0] == times[1]).mean() - want) < 4 * np.sqrt(want * (1 - want) / m) + 1e-9


def plain_spans(texts, width):
    seen = Counter(t[i:i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        cover = np.zeros(len(t) + 1, int)
        for i in range(len(t) - width + 1):
            if seen[t[i:i + width]] > 1:
                cover[i] += 1
                cover[i + width] -= 1 if i + width <= len(t) else 0
        on = np.cumsum(cover[:len(t)]) > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[0], on.astype(int), [0]])))
        out.append((int(on.sum()), len(edge) // 2,
                    bytes(np.frombuffer(t, np.uint8)[~on])))
    return out


def check_spans(spark, rows, **more):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows],
                               "doc_id bigint, text string, spans string").repartition(4)
    want = plain_spans([(t or "").encode() for _, t in rows], more["width"])
    got = repeats.kept_digests(df, repeats.repeated_spans(df, **more)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got) == Counter(
        (i, len((t or "").encode()), n, s, hashlib.sha256(k).hexdigest())
        for (i, t), (n, s, k) in zip(rows, want))


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    letters = lambda n, a="abé": "".join(rng.choice(a) for _ in range(n))
    pool = [letters(rng.randint(15, 120)) for _ in range(12)]
    rows = [(0, None), (1, ""), (2, "short"), (3, "z" * 300), (4, "xy" * 150), (5, "z" * 45)]
    for i in range(6, 90):
        parts = [rng.choice(pool) if rng.random() < 0.4 else letters(rng.randint(0, 60), "abcdefgh ")
                 for _ in range(rng.randint(0, 6))]
        if rng.random() < 0.3:
            p = rng.choice(pool)
            parts.append(p[rng.randint(0, 10):rng.randint(11, 120)])
        rows.append((i, "".join(parts)))
    rows += [(90, rows[20][1]), (91, rows[20][1]), (20, rows[20][1])]
    check_spans(spark, rows, width=40, gram=8, chunk=8)
    check_spans(spark, rows, width=33, gram=5, chunk=16)


def test_repeats_query(spark):
    rows = [(r.doc_id, (r.text or "").encode()) for r in
            spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = plain_spans([t for _, t in rows], 400)
    got = {r.doc_id: r for r in queries.op7_repeats(spark, SMALL).collect()}
    for (i, t), (n, s, k) in zip(rows, want):
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (
            len(t), n, s, hashlib.sha256(k).hexdigest())
    for (i, _), (n, _, _) in zip(rows, plain_passages([t for _, t in rows], 50)):
        assert got[i].shared_words == n
    assert len(got) == len(rows) and sum(n > 0 for n, _, _ in want)
    empty = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    assert repeats.repeated_spans(empty).count() == 0


def plain_passages(texts, width):
    """Words in windows of ``width`` words that another text holds too, runs of them, and the text without."""
    words = [[(m.start(), m.end()) for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", t)] for t in texts]
    rows = [words_of(t) for t in texts]
    held = defaultdict(set)
    for i, w in enumerate(rows):
        for k in range(len(w) - width + 1):
            held[tuple(w[k:k + width])].add(i)
    out = []
    for t, w, at in zip(texts, rows, words):
        on = np.zeros(len(w) + 2, bool)
        for k in range(len(w) - width + 1):
            if len(held[tuple(w[k:k + width])]) > 1:
                on[k + 1:k + 1 + width] = True
        edge = np.flatnonzero(np.diff(on.astype(int)))
        spans = list(zip(edge[::2].tolist(), edge[1::2].tolist()))
        kept, done = [], 0
        for a, b in spans:
            kept.append(t[done:at[a][0]])
            done = at[b - 1][1]
        out.append((int(on.sum()), len(spans), b"".join([*kept, t[done:]])))
    return out


@pytest.mark.parametrize("width, gram", [(6, 2), (9, 3), (9, 9)])
def test_passages_equal_brute_force(spark, width, gram):
    rng = random.Random(width)
    word = lambda: "".join(rng.choice("abÉ7") for _ in range(rng.randint(1, 2)))
    pool = [[word() for _ in range(rng.randint(width - 2, 4 * width))] for _ in range(10)]
    rows = [(0, None), (1, ""), (2, " .,! "), (3, "one two"), (4, "q " * 80), (5, "r s t " * 30), (6, "r s t " * 30)]
    for i in range(7, 90):
        w = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(pool)
            w += p[rng.randint(0, 3):] if rng.random() < 0.5 else [word() for _ in range(rng.randint(0, 2 * width))]
        rows.append((i, "".join(x.upper() + rng.choice([" ", ", ", "\n"]) for x in w)))
    rows += [(90, rows[20][1]), (20, rows[20][1]), (None, rows[20][1]), (None, "u v w x y z " * 9)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows],
                               "doc_id bigint, text string, spans string, `d1.x` int").repartition(4)
    want = plain_passages([(t or "").encode() for _, t in rows], width)
    spans = passages.shared_spans(df, width, gram)
    assert Counter((r.doc_id, r.n_removed, len(r.spans)) for r in spans.collect()) == Counter(
        (i, n, s) for (i, _), (n, s, _) in zip(rows, want))
    cut = passages.cut_passages(df, spans)
    assert cut.columns == df.columns
    assert Counter((r.doc_id, r.text) for r in cut.collect()) == Counter(
        (i, k.decode("utf-8", "ignore") if t is not None else None) for (i, t), (_, _, k) in zip(rows, want))
    assert passages.shared_spans(df.limit(0), width, gram).collect() == []


def test_repeats_inside_one_document_are_not_shared_passages(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h " * 20), (2, "a b c d e f g h " + "z " * 40)],
                               "doc_id bigint, text string")
    got = {r.doc_id: r.spans for r in passages.shared_spans(df, 8, 3).collect()}
    assert got[2] == [[0, 8]] and got[1] == [[0, 160]]
    assert [r.n_removed for r in passages.shared_spans(df.where("doc_id = 1"), 8, 3).collect()] == [0]


def test_anchors_do_not_depend_on_stretches(monkeypatch):
    text = bytes(random.Random(3).choice(b"ab") for _ in range(5000)) + b"q" * 900
    whole = repeats.anchors(repeats.Prints(text), len(text))
    monkeypatch.setattr(repeats, "STRETCH", 700)
    assert (repeats.anchors(repeats.Prints(text), len(text)) == whole).all()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "repeats", "decontaminate", "tokens"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    benchmark = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        after = stage(spark, docs, SMALL)
        if name != "tokens":
            assert after.schema.names == docs.schema.names
            assert [f.dataType for f in after.schema] == [f.dataType for f in docs.schema]
        rows = after.collect()
        ids = [r.doc_id for r in rows]
        assert len(set(ids)) == len(ids)
        if name == "quality":
            right = [(r.doc_id in set(ids)) == (labels[r.doc_id] == 1) for r in before if r.doc_id in labels]
            assert np.mean(right) > 0.95
        elif name == "near_dedup":
            assert sorted(ids) == sorted({c for i, c in plain_texts([(r.doc_id, r.text) for r in before])})
        elif name == "repeats":
            want = plain_passages([(r.text or "").encode() for r in before], 50)
            text = {r.doc_id: r for r in rows}
            assert any(n for n, _, _ in want)
            for r, (_, _, k) in zip(before, want):
                assert text[r.doc_id].text == (k.decode("utf-8", "ignore") if r.text is not None else None)
                assert text[r.doc_id].n_chars == (len(text[r.doc_id].text or ""))
        elif name == "decontaminate":
            grams = set()
            for t in benchmark:
                w = words_of(t.encode())
                grams |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
            for r in before:
                w = words_of((r.text or "").encode())
                hit = any(tuple(w[i:i + n]) in grams for n in {len(g) for g in grams}
                          for i in range(len(w) - n + 1))
                assert (r.doc_id in set(ids)) == (not hit)
        else:
            assert sorted(ids) == sorted(r.doc_id for r in before)
            assert all(r.n_tokens == len(r.ids) for r in rows)
        docs = spark.createDataFrame(rows, after.schema)
    run = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in run) == sorted((r.doc_id, r.ids_sha256) for r in rows)


def test_pipeline_stages_with_odd_rows_and_columns(spark):
    """Nulls, empty and repeated rows, columns named as the operators' own, names with dots, no rows."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = docs.unionAll(docs.where("doc_id < 3")).unionAll(
        spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "", "en", "s", 0), (None, None, None, None, None),
                               (None, "a few words of no further use here", None, None, None)], docs.schema))
    more = {c: F.lit(f"own {c}") for c in ("quality", "n_shingles", "digest", "spans", "row_no", "a.b", "x`y",
                                           "words", "n", "cid", "predicted", "d1", "ids_")}
    named = odd.withColumns({c.replace("`", "``"): v for c, v in more.items() if "." not in c and "`" not in c})
    named = named.select("*", F.lit("own a.b").alias("a.b"), F.lit("own x`y").alias("x`y"))
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, named, SMALL)
        rows = got.collect()
        if name == "tokens":
            assert len(rows) == odd.count()
        else:
            assert got.columns == named.columns
            place = {c: i for i, c in enumerate(got.columns)}
            assert rows and all(r[place[c]] == f"own {c}" for r in rows for c in more if c in place)
            plain = stage(spark, odd, SMALL).collect()
            assert Counter((r.doc_id, r.text) for r in plain) == Counter((r[0], r[1]) for r in rows)
        if name == "near_dedup":
            ids = Counter(r[0] for r in rows)
            assert ids[10**6] == ids[10**6 + 1] == 1 and ids[None] == 2 and max(v for k, v in ids.items() if k is not None) == 1
        nothing = stage(spark, named.limit(0), SMALL)
        assert nothing.columns == got.columns and nothing.collect() == []
    empty = quality.learn(odd.limit(0), spark.read.parquet(f"{SMALL}/labels.parquet"))
    assert quality.scored(odd, empty).count() == odd.count()


def test_pipeline_filters_keep_columns_named_as_their_own(spark):
    docs = (spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("score", F.col("doc_id") * 2)
            .withColumn("Predicted", F.lit("p")).withColumn("n_words", F.col("doc_id") + 7)
            .withColumn("hit_items", F.lit("x")))
    plain = docs.drop("score", "Predicted", "n_words", "hit_items")
    for stage in (corpus_pipeline.keep_quality, corpus_pipeline.drop_contaminated):
        got = stage(spark, docs, SMALL)
        assert got.dtypes == docs.dtypes
        rows = got.collect()
        assert {r.doc_id for r in rows} == {r.doc_id for r in stage(spark, plain, SMALL).collect()} and rows
        assert all((r.score, r.Predicted, r.n_words, r.hit_items) == (r.doc_id * 2, "p", r.doc_id + 7, "x")
                   for r in rows)
