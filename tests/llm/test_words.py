"""Spelling variants, token alignment and license scans against plain versions."""

import bisect
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shelftide.llm import license_scan, queries, spelling, token_align

SF_DIR = "/root/testdata/sf0.001"
EXTRA = "word string, n bigint, cell string, pairs string, labels string, `a.b` string"


def documents(spark, texts):
    """Documents with extra columns named as the operators' own; an id twice and a null id."""
    rows = [(i, t, "w", 1, "c", "p", "l", "d") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (0, texts[0], *rows[0][2:]), (None, texts[0], *rows[0][2:])],
                                 f"doc_id bigint, text string, {EXTRA}")


def pairs_of(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


# Spelling variants

def plain_variants(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", (t or "").translate(low)):
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            counts[w[:h % len(w)] + w[h % len(w) + 1:] if h % 97 == 0 else w] += 1
    counts = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    less = defaultdict(set)
    for w in counts:
        for p in range(len(w)):
            less[p, w[:p] + w[p + 1:]].add(w)
    near = defaultdict(set)
    for (_, short), group in less.items():
        for w in group:
            near[w] |= group - {w}
            if short in counts:
                near[w].add(short)
                near[short].add(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda u: (-counts[u], u), default=None)
        if best and counts[best] >= 2 * counts[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {w: (n, len(near[w]), form.get(w), counts.get(form.get(w)), root(w)) for w, n in counts.items()}


def variants(frame):
    rows = frame.collect()
    out = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(out) == len(rows)
    return out


def test_spelling_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    want = plain_variants(pairs_of(docs))
    assert variants(queries.op11_spelling(spark, SF_DIR)) == want
    assert any(v[2] for v in want.values())
    # Many small cells and leaves give the same.
    assert variants(spelling.variants(docs, sample=200, cell=8, leaf=1)) == want


def test_spelling_dense_words_and_odd_texts(spark):
    rng = random.Random(11)
    made = ["".join(rng.choice("abÀ×é") for _ in range(rng.choice((5, 5, 6, 7)))) for _ in range(900)]
    texts = [None, "", " ÷×÷×÷ ", " ".join(made * 3), " ".join(made[:300]), "x" * 3000 + " " + "x" * 2999 + " ",
             ("y" * 200 + " " + "y" * 199 + "z ") * 3, "ſſſſſſ ıııııı ABCDE abcde Abcde ÀBCDE àbcde " * 4]
    docs = documents(spark, [*texts, texts[5], texts[5]])
    want = plain_variants(pairs_of(docs))
    assert any(len(w) == 2999 for w in want) and "ÀBCDE".replace("BCDE", "bcde") in want
    assert variants(spelling.variants(docs, sample=300, cell=16, leaf=4)) == want
    assert spelling.variants(docs.limit(0)).collect() == []


def test_spelling_chain_of_forms(spark):
    steps = ["abcdefgh", "abcdefgx", "abcdefyx", "abcdezyx", "abcwwzyx"]
    text = " ".join(w for k, w in enumerate(steps) for _ in range(3 * 2 ** k))
    got = variants(spelling.variants(spark.createDataFrame([(7, text)], "doc_id bigint, text string")))
    assert got == plain_variants([(7, text)])
    assert got["abcdefgh"][2] == "abcdefgx" and got["abcdefgh"][4] == "abcdezyx"


def test_cells_hold_every_word_within_the_box():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcde") for _ in range(6)) for _ in range(2000)})
    tree = spelling.KdTree(spelling.letter_counts(spelling.letters(words)), 10)
    vectors = spelling.letter_counts(spelling.letters(words))
    home = tree.homes(vectors)
    assert all(home[i] == leaf for leaf, own in enumerate(tree.leaves) for i in own)
    reached = defaultdict(set)
    for leaf, own in tree.visits(vectors, 1, 1):
        for i in own.tolist():
            assert leaf not in reached[i]
            reached[i].add(leaf)
    gap = vectors[:, None] - vectors
    close = (np.maximum(gap, 0).sum(2) <= 1) & (np.maximum(-gap, 0).sum(2) <= 1)
    assert all(home[j] in reached[i] for i, j in zip(*np.nonzero(close)))
    assert np.mean([len(r) for r in reached.values()]) < len(tree.leaves) / 3


# Alignment of tokenizers

@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    a.no_truncation()
    a.no_padding()
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def plain_alignment(rows, both):
    """Results by cut offsets, groups as lists and all links one by one."""
    a, b = both
    letters = {c: bytes([i]) for c, i in token_align.byte_letters().items()}
    made = []
    for i, t in rows:
        ids_a, ids_b = a.encode(" " + (t or ""), add_special_tokens=False).ids, b.encode(t or "")
        bytes_a = [b"".join(letters[c] for c in a.id_to_token(x)) for x in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
                   for p in map(b.id_to_piece, ids_b)]
        body = (" " + (t or "")).encode()
        if not t or b"".join(bytes_a) != body or b"".join(bytes_b) != body:
            made.append((i, [], [], []))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
        cuts = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        groups = [([], []) for _ in cuts]
        for ids, ends, k in ((ids_a, ends_a, 0), (ids_b, ends_b, 1)):
            for x, e in zip(ids, ends.tolist()):
                groups[bisect.bisect_left(cuts, e)][k].append(x)
        made.append((i, ids_a, ids_b, groups))
    links = [[(x, y) for g in m[3] for x in g[0] for y in g[1]] for m in made]
    count = Counter(p for found in links for p in set(found))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return sorted(((i, len(x), len(y), len(g), len(found), sum(count[p] == best[p[0]] for p in found),
                    sum(count[p] for p in found),
                    hashlib.sha256(";".join(",".join(map(str, u)) + "|" + ",".join(map(str, v))
                                            for u, v in g).encode()).hexdigest() if g else "")
                   for (i, x, y, g), found in zip(made, links)), key=str)


def test_alignment_equals_brute_force(spark, both):
    rows = pairs_of(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    got = sorted((tuple(r) for r in queries.op12_token_align(spark, SF_DIR).collect()), key=str)
    assert got == plain_alignment(rows, both)


@pytest.mark.parametrize("common", [0, 40, 1 << 18])
def test_alignment_of_odd_texts(spark, both, common):
    texts = ["The cat sat on the mat. ", None, "", " ", "  two  blanks ", "▁written block", "a\x00b", "<|endoftext|> <s> </s> <unk>",
             "日本語 テキスト😀😀", "é é ﬁ Ａ", "=-" * 900, "a" * 2500, " " * 6000 + "x", "\n" * 2500,
             "don't 'S it's\t\n", "٣½² 12345", "the cat sat " * 60]
    docs = documents(spark, texts)
    got = sorted((tuple(r) for r in token_align.alignment(docs, common=common).collect()), key=str)
    assert got == plain_alignment(pairs_of(docs), both)
    zero = {r[0]: r for r in got}
    for i in (1, 2, 5):
        assert zero[i] == (i, 0, 0, 0, 0, 0, 0, "")
    assert token_align.alignment(docs.limit(0)).collect() == []


def test_links_of_large_groups():
    rng = np.random.default_rng(2)
    sizes = [(400, 300), (1, 1), (2, 3), (900, 900), (1, 5)]
    ids, first, want, at = [], [], Counter(), 0
    for n, m in sizes:
        a, b = rng.integers(0, 50, n), rng.integers(0, 40, m)
        first.append(at)
        at += n + m
        ids += [*a, *b]
        for x, k in Counter(a.tolist()).items():
            for y, j in Counter(b.tolist()).items():
                want[x << 32 | y] += k * j
    for wanted in (sizes, sizes[:1]):
        n, m = np.array(wanted).T
        keys, counts = token_align.linked(np.array(ids), np.array(first[:len(wanted)]), n, m)
        if wanted is sizes:
            assert dict(zip(keys.tolist(), counts.tolist())) == want
        assert counts.sum() == (n * m).sum()


# License scans

def plain_scan(text):
    """Every rule on every text, matches compared in pairs."""
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    words = [w.decode() for w in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(low))]
    joined = " " + " ".join(words) + " "
    base, found = [], []
    for phrase, label in license_scan.PHRASES.items():
        want = phrase.split()
        base += [(label, k) for k in range(len(words)) if words[k:k + len(want)] == want]
    for order, rule in enumerate(license_scan.RULES):
        spans = re.finditer(f"(?<= )(?:{rule.pattern})(?= )", joined) if rule.level < license_scan.PLAIN else \
            re.finditer(f"(?<= )(?={rule.pattern} )", joined)
        for m in spans:
            size = len(m.group() or rule.pattern)
            first = joined.count(" ", 0, m.start()) - 1
            found.append((rule.level, order, first, first + joined[m.start():m.start() + size].count(" ")))
    kept = [x for x in found if not any(
        y[2] <= x[2] and y[3] >= x[3] and (y[0] < x[0] or y[0] == x[0] and (
            y[2:] != x[2:] or y[1] < x[1])) for y in found if y is not x)]
    return len(words), base, [(license_scan.RULES[o].label, v, a, b) for v, o, a, b in kept]


LICENSE_TEXTS = [
    None, "", " ", "no statement at all, mit dem Wort", "CC BY CC BY cc-by", "Licensed under CC BY-NC 4.0.",
    "// SPDX-License-Identifier: Apache-2.0\nLicensed under the Apache License, Version 2.0 (the \"License\"); you may "
    "not use this file except in compliance with the License.",
    "This work is licensed under the GNU General Public License, version 3. All rights reserved. ALL RIGHTS\nRESERVED",
    "Released under the MIT License, see https://opensource.org/licenses/MIT",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and so on",
    "under the terms of the GNU Lesser General Public License version 2.1 or the Mozilla Public License 2.0",
    "https://creativecommons.org/licenses/by-sa/4.0/ CC BY-SA 4.0 Tous droits réservés; naïve général public license",
    "license: BSD 3-Clause License (c) 1999 2004 somebody. all rights reserved", "general public license " * 700,
    "cc by " * 900 + "licensed under the mit license " * 50]


def test_license_scan_of_odd_texts(spark):
    docs = documents(spark, LICENSE_TEXTS)
    made = license_scan.scanned(docs)
    for r in made.collect():
        n, base, kept = plain_scan(LICENSE_TEXTS[r.doc_id or 0])
        assert (r.n_words, r.n_base) == (n, len(base))
        assert sorted((m.label, m.level, m.first, m.last) for m in r.matches) == sorted(kept)
        assert (r.first_word, r.last_word) == ((min(b[1] for b in base), max(b[1] for b in base)) if base else (None, None))
        assert r.labels == sorted({b[0] for b in base} | {k[0] for k in kept})
        assert r.base_labels == sorted({b[0] for b in base}) and 0 <= r.score <= 1
        assert (r.score > 0) == bool(r.labels)
    rows = {r.doc_id: r for r in license_scan.summary(made).collect()}
    assert rows[3].labels == "" and rows[3].n_base == 0
    assert rows[5].labels == "cc-by,cc-by-nc" and rows[6].labels == "apache-2.0"
    assert rows[7].labels == "gnu-gpl-3,gpl,reserved" and rows[7].n_base == 3
    assert rows[8].labels == "mit" and rows[9].labels == "mit"
    assert rows[4].n_base == 3 and (rows[4].first_word, rows[4].last_word) == (0, 4)
    assert license_scan.scanned(docs.limit(0)).collect() == []


def test_license_scan_of_the_table(spark):
    texts = dict(pairs_of(spark.read.parquet(f"{SF_DIR}/documents.parquet")))
    got = {r.doc_id: r for r in queries.op13_license_scan(spark, SF_DIR).collect()}
    assert got.keys() == texts.keys() and len({r.labels for r in got.values()}) > 3
    for i, t in texts.items():
        n, base, kept = plain_scan(t)
        labels = {b[0] for b in base} | {k[0] for k in kept}
        assert (got[i].n_words, got[i].n_base, got[i].n_matches) == (n, len(base), len(kept))
        assert got[i].labels == ",".join(sorted(labels))


def test_license_rules_are_many_and_gated_by_their_own_words():
    rules = license_scan.RULES
    assert len(rules) > 300 and [r.level for r in rules] == sorted(r.level for r in rules)
    scanner = license_scan.Scanner()
    for name, (must, tag, prose) in license_scan.FAMILIES.items():
        sample = re.sub(r"\(\?:([^()|]*)[^()]*\)\??", r"\1", prose)
        sample = re.sub(r"\(\?:([^()|]*)[^()]*\)\??", r"\1", sample).replace("[cs]", "s").replace("?", "")
        sample = re.sub(r"\[(.)[^\]]*\]", r"\1", sample).replace(r"\d", "3").replace(r"\w", "x")
        found = scanner.scan(f"distributed under the terms of the {sample}.".encode())[2]
        assert any(rules[i].label == name for i, *_ in found), (name, sample, [rules[i].label for i, *_ in found])
