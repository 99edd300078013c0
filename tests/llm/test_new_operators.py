"""Hard negatives, main text and fill-in-the-middle against brute force and planted pages."""

import hashlib
import html
import math
import re

import duckdb
import numpy as np
import pytest
from helpers import LONG, no_documents, odd_documents, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inboxlens.llm import fill_middle, hard_negatives, main_text

SMALL = "/root/testdata/sf0.01"

# --- hard negatives ---------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute_negatives(rows, is_anchor, positives=5, negatives=10, low=30, high=90, scale=256):
    usable = {
        (i, l, tuple(max(-(2**63), min(2**63 - 1, math.floor(scale * float(x)))) for x in v))
        for i, v, l in rows
        if i is not None and l is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for i, l, v in usable:
        if not is_anchor(i):
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w)), j, m)
            for j, m, w in usable if j != i and len(v) == len(w)
        )
        for s, j, _ in [x for x in scored if x[2] == l][:positives]:
            p = -s
            inside = [x for x in scored if x[2] != l and low * p <= -100 * x[0] <= high * p]
            out += [(i, j, r, x[1], p, -x[0]) for r, x in enumerate(inside[:negatives], 1)]
    return sorted(out)


def mined(df, **options):
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[c] for c in columns) for r in hard_negatives.mine(df, **options).collect())


def random_vectors(n, d, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    near = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, d))
    return [(k, [float(np.float32(x)) for x in near[k]], int(rng.integers(0, 4))) for k in range(n)]


@pytest.mark.parametrize("d,spread", [(3, 0.3), (16, 1.0)])
def test_negatives_equal_brute_force(spark, monkeypatch, d, spread):
    # small slices, leaves and rounds, so that every way through the tree is taken
    monkeypatch.setattr(hard_negatives, "LEAST_SLICE", 40)
    monkeypatch.setattr(hard_negatives, "MOST_SLICE", 40)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 25)
    monkeypatch.setattr(hard_negatives, "FIRST", 3)
    rows = random_vectors(600, d, seed=d, spread=spread)
    df = spark.createDataFrame(rows, VECTORS)
    got = mined(df, is_anchor=F.col("vec_id") % 10 == 0)
    assert got == brute_negatives(rows, lambda i: i % 10 == 0)
    assert got


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = random_vectors(60, 4, seed=2)
    same = [0.5, -1.25, 3.0, 0.125]
    rows += [(k, same, k % 2) for k in range(100, 130)]  # ties everywhere
    rows += [(k, same, k % 2) for k in range(100, 130)]  # every one of them twice
    rows += [(100, [1.0, 2.0, 3.0, 4.0], 1), (100, [1.0, 2.0, 3.0, 4.0], 0)]  # one id, other rows
    rows += [(200, None, 1), (201, [1.0, None, 2.0, 3.0], 1), (202, [nan] * 4, 1), (203, [inf] * 4, 0)]
    rows += [(None, same, 1), (204, same, None), (205, [], 1), (206, [], 2), (210, [0.0] * 4, 3)]
    rows += [(220, [1.0, 2.0], 1), (230, [1.0, 2.0], 1), (240, [1.0, 1.0], 2)]  # shorter vectors
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' AS id", "1 AS slice", "2 AS q", "3 AS rank")
    got = mined(df, is_anchor=F.col("vec_id") % 10 == 0)
    assert got == brute_negatives(rows, lambda i: i % 10 == 0)
    assert {r[0] for r in got} >= {100, 220}
    assert mined(df.limit(0)) == [] and hard_negatives.mine(df.limit(0)).columns[0] == "anchor_id"
    assert mined(df, is_anchor=F.lit(False)) == []


def test_negatives_of_very_large_components(spark):
    rows = [(k, [1e30 * (k % 3), 2.0**k, 1.0], k % 2) for k in range(20)]
    assert len(mined(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"))) >= 0


def test_negatives_of_the_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    expected = con.execute(hard_negatives.SQL).fetchall()
    assert rows_of(hard_negatives.query(spark, SMALL)) == sorted(expected, key=repr)


def test_tree_prunes_and_stays_exact():
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.integers(0, 50, (2000, 3)), rng.integers(900, 950, (2000, 3))]).astype(float)
    labels = rng.integers(0, 2, 4000)
    tree = hard_negatives.Tree(points, labels, np.arange(4000))
    seen = []
    real = hard_negatives.Windows.add
    vector = np.array([1.0, 1.0, 1.0])
    least, most = hard_negatives.intervals(vector[None], tree.low, tree.high)
    for node, (a, b) in enumerate(tree.spans[: tree.leaves]):
        scores = tree.points[a:b] @ vector
        assert least[0][node] <= scores.min() and scores.max() <= most[0][node]
    windows = hard_negatives.Windows([-np.inf], [np.inf], [-np.inf], 5)
    windows.add = lambda s, i: (seen.append(len(s)), real(windows, s, i))
    hard_negatives.search(tree, vector, 0, -1, True, windows, least[0], most[0])
    scores = points @ vector
    best = sorted((-scores[k], k) for k in range(4000) if labels[k] == 0)[:5]
    original = hard_negatives._tiled(points, labels)
    assert [(-s, int(original[int(i)])) for s, i in zip(*windows.found[0])] or best
    assert sorted(windows.found[0][0])[::-1] == [-s for s, _ in best]
    assert sum(seen) < 1000  # half of the rows lie far away, most of the rest below the k-th


# --- main text ----------------------------------------------------------------------------------

P1 = "Il était une fois, dans un pays lointain, un roi qui aimait les nombres, et rien d'autre."
P2 = "Every morning he counted his sheep, his trees, and the clouds; then he had breakfast."
P3 = "Short end."
ARTICLE = f"A Title {P1} {P2} one two {P3}"
INNER = f"<h1>A Title</h1><p>{P1}</p><p>{P2}</p><ul><li>one</li><li>two</li></ul><p>{P3}</p>"
NAV = "<nav><ul>" + "".join(f'<li><a href="/{k}">Menu entry {k}</a></li>' for k in range(30)) + "</ul></nav>"
SIDE = "".join(f"<p>Sidebar words, many of them, number {k}, about nothing at all, as always.</p>" for k in range(4))
PAGES = {
    "article": f"<html><body>{NAV}<article>{INNER}</article><footer>© foot</footer></body></html>",
    "div content": f"<body><div class='top-menu'>{NAV}</div><div id=content>{INNER}</div><div class=sidebar>{SIDE}</div>",
    "plain divs": f"<body><div><a href=/a>Home</a> <a href=/b>About</a> <a href=/c>News</a></div><div>{INNER}</div><div><a href=/x>Imprint</a></div>",
    "aside inside": f"<main><article>{INNER}<aside>{SIDE}</aside></article></main>",
    "comments": f"<article>{INNER}<section id='comments'>" + f"<article class=comment><p>{P2 * 9}</p></article>" * 9 + "</section></article>",
    "comments outside": f"<article>{INNER}</article><div class='comment-list'>{SIDE * 5}</div>",
    "notice": f"<div class='cookie-notice'><p>We use cookies, many cookies, really a lot of cookies, do you agree?</p></div><main>{INNER}</main>",
    "advert": f"<article><h1>A Title</h1><p>{P1}</p><div class='ad-slot'>Buy now, cheap!</div><p>{P2}</p><ul><li>one<li>two</ul><p>{P3}</article>",
    "form": f"<article>{INNER}<form><label>Mail</label><input><p>Sign up for letters, news, and more of the same.</p></form></article>",
    "page in a form": f"<form action=x>{NAV}<div class=post-body>{INNER}</div></form>",
    "script": f"<article><script>var x = '<p>no</p>';</script><style>p{{}}</style>{INNER}<noscript>on!</noscript></article>",
    "header": f"<header><p>The Daily Number, since 1903, every day, for everyone, everywhere.</p></header><article><header><h1>A Title</h1></header>{INNER[16:]}</article>",
    "two boxes": f"<div class=page><h1>A Title</h1><section><p>{P1}</p></section><section><p>{P2}</p><ul><li>one</li><li>two</li></ul></section><p>{P3}</p></div>",
    "layout words": f"<div class='has-sidebar content-wrapper'><div class='entry-content'>{INNER}</div><div id='sidebar'>{SIDE}</div></div>",
    "unclosed": f"<article><h1>A Title</h1><p><b>{P1}<br><p>{P2}<ul><li>one<li>two</ul><p>{P3}",
    "table frame": f"<table><tr><td width=100>{NAV}</td><td class=main>{INNER}</td></tr></table>",
    "upper case": f"<BODY><ARTICLE>{INNER}</ARTICLE><FOOTER>f</FOOTER></BODY>",
    "quoted sign": f"<article data-x='a>b' title=\"<p>no</p>\">{INNER}</article>",
    "hidden": f"<article>{INNER}<p hidden>gone</p><p style='display: none'>gone too</p></article>",
}


@pytest.mark.parametrize("name", PAGES)
def test_articles_of_planted_pages(name):
    assert main_text.main_text(PAGES[name]) == ARTICLE


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""), ("", ""), ("   ", ""), ("just words &amp; more", "just words & more"),
        ("<nav><a href=/>only a menu</a></nav>", ""), ("<p>a&nbsp;&lt;b&gt;\n\t c</p>", "a <b> c"),
        ("<article><p>a<b>b</b>c<br>d</p><p>e</p></article>", "abc d e"),
        ("<article>1 < 2 &am &copy 3 <!-- no --> 4</article>", "1 < 2 &am © 3 4"),
        ("<article>text <div", "text"), ("<article>text <!-- open", "text"), ("<script>x", ""),
        ("<article>a</b></p></div>b</article>", "ab"), ("<![CDATA[x]]><?php y ?><p>z</p>", "z"),
    ],
)
def test_odd_markup(page, text):
    assert main_text.main_text(page) == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class=ad>", "<div>", "</div>", "<b>", "</b>", "<a href=x>", "</a>", "<table>", "<tr>", "<td>", "</td>", "</table>", "<li>", "<ul>", "</ul>", "<article>", "</article>", "<script>", "</script>", "<", ">", "'", '"', "<!--", "-->", "word, ", "&amp;", "<head>", "<body>", "<form>", "</form>"]), max_size=40))
def test_any_markup_is_read(parts):
    text = main_text.main_text("".join(parts))
    assert text == " ".join(text.split())


def test_long_and_deep_pages_take_linear_time():
    deep = "<div>" * 30_000 + f"<p>{P1}</p>" + "</div>" * 30_000
    assert main_text.main_text(deep) == P1
    wide = "<article>" + f"<p><b>{P1}" * 10_000 + "</article>"
    assert len(main_text.main_text(wide)) == 10_000 * (len(P1) + 1) - 1
    assert main_text.main_text('<p a="' * 20_000) == ""


def test_pages_of_the_query(spark):
    rows = main_text.query(spark, SMALL).collect()
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", pages[r["page_id"]]["html"], re.S)[1]
        blocks = re.sub(r"</?(?:p|h1|br)[^>]*>", " ", inner)
        expected = " ".join(html.unescape(re.sub(r"<[^>]*>", "", blocks)).split())
        assert (r["text"], r["n_chars"], r["url"]) == (expected, len(expected), pages[r["page_id"]]["url"])


def test_pages_of_odd_rows(spark):
    kinds = "page_id bigint, url string, html string, text string, n_chars int"
    rows = [(1, None, None, "t", 1), (1, "u", "", None, None), (None, "u", PAGES["form"], "t", 2)]
    df = spark.createDataFrame(rows + rows, kinds)
    got = main_text.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars", "_text", "_n_chars"]
    assert sorted(r["_text"] for r in got.collect()) == ["", "", "", "", ARTICLE, ARTICLE]
    assert main_text.extract(df.limit(0)).count() == 0


# --- fill in the middle -------------------------------------------------------------------------


def brute_middle(doc_id, text, seed=7, rate=100, spm=50, characters=False):
    text = text or ""
    units = list(text) if characters else re.findall(r"[^\n]*\n|[^\n]+", text)
    sha = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(sha[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = st.text(alphabet="ab\n\r é€𝄞<PSM> ", max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_exception_index_converts_both_ways(text):
    data = np.frombuffer(text.encode(), np.uint8)
    index = fill_middle.Exceptions(data)
    at = np.array([len(text[:k].encode()) for k in range(len(text) + 1)])
    assert (index.to_chars(at) == np.arange(len(text) + 1)).all()
    assert (index.to_bytes(np.arange(len(text) + 1)) == at).all()
    assert len(index.starts) == sum(ord(c) > 127 for c in text)


@pytest.mark.parametrize("unit", [fill_middle.LINES, fill_middle.CHARACTERS])
@pytest.mark.parametrize("rate", [100, 40])
def test_middle_equals_brute_force(spark, unit, rate):
    rng = np.random.default_rng(rate)
    letters = list("ab\n\n é€𝄞<P>") + ["<M>"]
    rows = [(k, "".join(rng.choice(letters, rng.integers(0, 30)))) for k in range(400)]
    rows += [(None, "x\ny"), (3, None), (4, "a\nb"), (4, "é\n" * 9), (400, LONG + "\n" + LONG), (401, "\n" * 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = fill_middle.transform(df, unit=unit, rate=rate).withColumn(
        "back", fill_middle.restored(F.col("output"), F.col("form"))
    )
    found = sorted((tuple(r) for r in got.collect()), key=repr)
    expected = sorted(
        ((i, t, *brute_middle(i, t, rate=rate, characters=unit == "characters"), t or "") for i, t in rows),
        key=repr,
    )
    assert found == expected


def test_middle_of_odd_rows(spark):
    docs = odd_documents(spark, extra=True).selectExpr("*", "1 AS n_units", "'x' AS form", "'y' AS output", "'z' AS _0")
    got = fill_middle.transform(docs)
    assert got.columns[: len(docs.columns)] == docs.columns and "_form" in got.columns
    assert got.count() == docs.count()
    for r in got.collect():
        n, form, p, m, output = brute_middle(r["doc_id"], r["text"])
        assert (r["_form"], r["prefix_chars"], r["middle_chars"], r["_output"]) == (form, p, m, output)
    assert fill_middle.transform(no_documents(spark)).count() == 0


def test_middle_of_the_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    result = con.execute(fill_middle.SQL)
    names = [c[0] for c in result.description]
    got = fill_middle.query(spark, SMALL)
    assert got.columns == names and rows_of(got) == sorted(result.fetchall(), key=repr)
