"""Quality ranking, page text and language-model scores against plain versions and known cases."""

import math
import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from shelftide.llm import html_text, lattice_lm, quality, queries

SF_DIR = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def remainder(i, m):
    return zlib.crc32(str(i).encode()) % m


def test_quality_on_held_out_labels(spark):
    got = queries.op1_quality(spark, SF_DIR).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    own = [(r.score, r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    good, bad = [s for s, _, y in own if y == 1], [s for s, _, y in own if y == 0]
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.97
    assert np.mean([p == y for _, p, y in own]) > 0.95


def test_quality_edges(spark):
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(
        ["a good line of words.", "BUY!! NOW!! NOW!!", None, "", "x " * 9000])] * 2,
        "doc_id bigint, text string, score int")
    labels = spark.createDataFrame([(0, 1), (1, 0), (None, 1), (2, None), (1, 1), (3, 7)],
                                   "doc_id bigint, quality int")
    model = quality.learn(docs, labels)
    got = quality.scored(docs, model).collect()
    assert len(got) == 10 and len(got[0]) == 3
    none = quality.learn(docs, labels.limit(0))
    assert {r.score for r in quality.scored(docs, none).collect()} == {0.5}
    assert quality.scored(docs.limit(0), model).count() == 0


def test_bradley_terry_recovers_an_order():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 12))
    y = (x[:, 0] - 2 * x[:, 3] > 0).astype(int)
    m = quality.fit(x, y, np.ones(400))
    assert np.mean((m.scores(x) >= 0.3) == y) > 0.97
    assert abs(m.quantile - np.mean(y == 0)) < 0.05


PAGE = """<!DOCTYPE html><html><head><title>No</title><script>var a="</p><p>no";</script></head><body>
<header class=top>Site name</header><div id="cookie-notice"><p>We use cookies on this site, all of them.</p></div>
<nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
<main><article><h1>Title &amp; more</h1><p>First <b>bold <i>text</b>,&nbsp;with
 breaks.<br>Then &#233;l&eacute;ment<p>Second &lt;p&gt; paragraph of the text.</p>
<form><p>Your name</p><input><button>Send</button></form>
<div class="ad-box">Buy this now, it is very cheap and good for all.</div><p>Short.</p></article>
<section class="comments"><h2>Comments</h2><p>I like this article a lot, it is the best I ever read.</p></section></main>
<aside><p>Other stories that you may find of interest, many of them.</p></aside>
<footer>&copy; 2020 somebody. All rights reserved.</footer></body>"""


def test_page_text():
    assert html_text.main_text(PAGE) == (
        "Title & more First bold text, with breaks. Then élément Second <p> paragraph of the text. Short.")
    assert html_text.main_text("") == "" and html_text.main_text("<nav>a</nav><p") == ""
    plain = "<div><p>" + "A paragraph without any article around it, of some length. " * 3 + "</p></div>"
    assert html_text.main_text(plain).startswith("A paragraph")
    assert html_text.main_text("<p>" * 3000 + "<div>" * 500).strip() == ""


WORDS = "Here is a sentence of the text that a reader came for, and it goes on. "
REST = """<nav><ul><li><a href=/a>One</a></ul></nav>%s<div class="sidebar"><p>Other stories of
interest, many of them, to read.</p></div><section id="comments"><p>I like this a lot, well said.</p></section>
<footer>All rights reserved.</footer>"""


def test_wrappers_are_not_boilerplate():
    text = "<h1>Title</h1><p>" + WORDS + "</p><p>Short.</p>"
    want = f"Title {WORDS}Short."
    for wrap in ('<body class="has-sidebar">%s', '<body class="sidebar no-comments">%s',
                 '<html class="widget"><body id="menu">%s',
                 '<body><div id="page" class="with-sidebar">%s</div>',
                 '<body><div class="sidebar-left social"><div class="search-page">%s</div></div>',
                 '<form id="aspnetForm">%s</form>', '<div id="root" aria-hidden="true">%s</div>',
                 '<body style="display:none">%s', '<body><div data-hidden="no" title="id=ad hidden">%s</div>'):
        for core in ("<article>%s</article>", "<main>%s</main>", '<article class="post tag-social">%s</article>',
                     '<div role="main">%s</div>', "<div>%s</div>"):
            assert html_text.main_text(wrap % (REST % (core % text))) == want, (wrap, core)
    # articles that are teasers or comments do not speak for what holds them
    for other in ('<div class="related"><article class="card"><p>%s</p></article></div>',
                  '<section class="comments"><article class="comment"><p>%s</p></article></section>',
                  '<div class="cookie-notice"><p>%s</p></div>', "<aside><p>%s</p></aside>"):
        page = f"<div>{text}<p>{WORDS}</p></div>" + other % "Another text of some length, not the one here."
        assert html_text.main_text(page) == f"{want} {WORDS.strip()}", other
    assert html_text.main_text(f"<p>{WORDS}</p><p hidden>Gone. {WORDS}</p>") == WORDS.strip()


def test_elements_without_text_do_not_swallow_the_page():
    end = f"<p>{WORDS}</p><p>Second. {WORDS}</p></article>"
    want = f"Before {WORDS}{WORDS}Second. {WORDS}".strip()
    for odd in ("<svg/>", "<svg width=1 />", "<math/>", '<svg a="x"/>', "<svg><title/><path d=m0/ ></svg>", "<svg><style/></svg>",
                "<svg><title>no</title><text>no</text></svg>", "<svg><g><path>", "<div><select><option>no</div>",
                "<div><object data=x>no</div>", "<div><canvas></div>", "<div><audio src=x>no</div>",
                "<div><video><source src=y>no</div>", "<section><template><b>no</b></section>",
                "<div><select><option>no<select></div>", "<div><select><option>no<input></div>",
                "<svg width=1/>no</svg>", "<SVG/>", "<noscript><div>no</div><p>no</noscript>"):
        page = f"<article><p>Before {WORDS}</p>{odd}{end}"
        assert html_text.main_text(page) == want, odd
    for inline in ("<noscript><div>no</div></noscript>", "<object><p>no</p></object>", "<svg><text>no</text></svg>",
                   "<select><option>no</select>", "<template><p>no</p></template>", "<svg/>", "<canvas>no</canvas>"):
        assert html_text.blocks_of(f"<p>One {inline}two</p>")[0][0] == "One two", inline
    math = ("<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn><mspace/></mrow>"
            "<annotation encoding='application/x-tex'>x=2</annotation></semantics></math>")
    assert html_text.main_text(f"<article><p>Let {math} be. {WORDS}</p></article>") == f"Let x=2 be. {WORDS.strip()}"


def test_text_that_nothing_speaks_against_is_kept():
    for page, want in (
            ("just a few words", "just a few words"),
            ("<ul><li>One apple</li><li>Two pears</li></ul><p>Some text follows.</p>", "One apple Two pears Some text follows."),
            ("<table><tr><th>Name</th><td>Bob</td></tr></table>", "Name Bob"),
            (f"<article><p>{WORDS}</p><ul><li><a href=1>Ref one</a></li><li><a href=2>Ref two</a></li></ul></article>",
             f"{WORDS.strip()} Ref one Ref two"),
            (f"<ul><li><a>Home</a></li><li><a>About us</a></li></ul><p>{WORDS}</p>", WORDS.strip()),
            (f"<article><p>{WORDS}</p><div class=comments><p>Nice post, a reader wrote.</p></div><p>End.</p></article>",
             f"{WORDS.strip()} End.")):
        assert html_text.main_text(page) == want


def test_the_cut_decides_where_single_scores_fail():
    """A line of links between paragraphs is text; a bare label between lines of links is not."""
    inside = f"<div><p>{WORDS}</p><p><a href=1>One of the sources</a></p><p>{WORDS}</p></div>"
    links = "".join(f"<li><a href={k}>Place {k}</a></li>" for k in range(4))
    label = f"<ul>{links}<li>Places</li>{links}</ul><div><div><p>{WORDS}</p></div></div>"
    for page, want, block in ((inside, f"{WORDS.strip()} One of the sources {WORDS.strip()}", "One of the sources"),
                              (label, WORDS.strip(), "Places")):
        score = {b[0]: b[2] for b in html_text.blocks_of(page)}[block]
        assert (score > 0) != (block in want)
        assert html_text.main_text(page) == want


def test_pages_query(spark):
    rows = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = queries.op8_html_text(spark, SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        body = rows[r.page_id].split("<article>", 1)[1].split("</article>")[0]
        want = [" ".join(html_text.unescape(x).split()) for x in html_text.re.split(
            r"</?(?:p|h1)>", body.replace("<br>", " ").replace("<b>", ""))]
        assert r.text == " ".join(x for x in want if x) and r.n_chars == len(r.text)


def test_pages_edges(spark):
    pages = spark.createDataFrame([(1, None, None, "x"), (1, "u", "", "x"), (None, "u", "<p>a", "y")],
                                  "page_id bigint, url string, html string, text string")
    assert sorted(r.text for r in html_text.extracted(pages).collect()) == ["", "", html_text.main_text("<p>a")]
    assert html_text.extracted(pages.limit(0)).count() == 0


def test_minimum_cut_equals_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randint(1, 7)
        scores = [rng.uniform(-3, 3) for _ in range(n)]
        edges = {(a, b): rng.uniform(0, 2) for a, b in combinations(range(n), 2) if rng.random() < 0.5}

        def cost(keep):
            return (sum(max(s, 0) for s, k in zip(scores, keep) if not k)
                    + sum(max(-s, 0) for s, k in zip(scores, keep) if k)
                    + sum(w for (a, b), w in edges.items() if keep[a] != keep[b]))

        best = min(cost([m >> i & 1 for i in range(n)]) for m in range(2 ** n))
        assert math.isclose(cost(html_text.minimum_cut(scores, edges)), best, abs_tol=1e-9)


def plain_scores(texts):
    c, ends = Counter(), 0
    for i, t in texts.items():
        if remainder(i, 10):
            c.update(lattice_lm.words_of((t or "").encode()))
            ends += 1
    return c, ends


def test_scores_equal_plain_version(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    c, ends = plain_scores(texts)
    n, v = sum(c.values()) + ends, len(c) + 1
    base = lambda k: math.log10((k + 0.1) / (n + 0.1 * (v + 1)))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for head in (lattice_lm.HEAD, 50):
        got = {r.doc_id: r for r in lattice_lm.scored(docs, head=head).collect()}
        for i, t in texts.items():
            words, r = lattice_lm.words_of((t or "").encode()), got[i]
            assert (r.n_tokens, r.train_tokens, r.held_out) == (len(words) + 1, n, remainder(i, 10) == 0)
            assert r.n_known == 1 + sum(c[w] > 0 for w in words)
            want = sum(base(c[w]) for w in words) + base(ends)
            assert math.isclose(r.base_score, want, rel_tol=1e-9)


def test_forward_recursion_sums_all_segmentations():
    p = lattice_lm.Pieces(public_tokenizers.path("piece_bpe_32k.model"), {300: 5, 400: 2}, 7)

    def total(text):
        if not text:
            return 1.0
        s = sum(math.exp(p.log[text[:k]]) * total(text[k:]) for k in range(1, len(text) + 1)
                if text[:k] in p.log)
        if text[0] not in p.log:
            s += math.exp(sum(p.spelled[b] for b in text[0].encode())) * total(text[1:])
        return s

    for word in ("the", "ouêen", "日x", "aaaaaa"):
        assert math.isclose(p.word(word.encode()), math.log(total(lattice_lm.START + word)) + p.end)
    # the chances of pieces, bytes and the end sum to one
    assert math.isclose(sum(map(math.exp, [*p.log.values(), *p.spelled, p.end])), 1, rel_tol=1e-9)


def test_scores_edges(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, None), (1, ""), (2, "A " * 3000 + "z" * 20000),
                                  (10, "a")] * 2, "doc_id bigint, text string")
    got = lattice_lm.scored(docs, head=1).collect()
    assert len(got) == 10 and all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lattice_lm.scored(docs.limit(0)).count() == 0
    unlearned = lattice_lm.scored(docs.where(F.col("doc_id").isNull())).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in unlearned} == {(0, 0, 0.0)}
