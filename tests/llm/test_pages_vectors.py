"""Operators on pages and vectors against brute force, on awkward rows and on empty tables."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from lakebank.llm import common, pagetext, search, urls


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def brute_topk(rows, k=5):
    good = [(n, i, [int(np.floor(256 * float(x))) for x in v]) for n, (i, v) in enumerate(rows)
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, i, v in good:
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for m, j, w in good if m != n)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j, _) in enumerate(best)]
    return Counter(out)


@pytest.mark.parametrize("block, query_block", [(search.BLOCK, search.QUERY_BLOCK), (64, 4)])
def test_topk(spark, block, query_block):
    from pyspark.sql import functions as F

    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(16)]) for i in range(600)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [rows[50]] * 3       # ties and repeated rows
    rows += [(2000, None), (2050, [0.1, None]), (2100, [float("nan")] * 16), (2150, [float("inf")] + [0.0] * 15), (2200, []), (None, [0.1] * 16), (2250, [0.5, 0.5])]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<float>, row int, score string").repartition(3)
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert rows_of(search.exact_topk(df, F.col("vec_id") % 50 == 0, 5, block, query_block)) == brute_topk(single)


def test_topk_few_and_large(spark):
    from pyspark.sql import functions as F

    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [2.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, search.exact_topk(few, F.col("vec_id") == 0).collect())) == [(0, 1, 1, 256 * 512), (0, 2, 2, 256 * 512)]
    assert search.exact_topk(few.limit(0), F.lit(True)).collect() == []
    large = spark.createDataFrame([(0, [1e12]), (1, [2e12]), (2, [-1e300])], "vec_id long, embedding array<double>")
    got = search.exact_topk(large, F.col("vec_id") == 0).collect()
    assert [r.score for r in sorted(got, key=lambda r: r["rank"])] == [2**63 - 1, -2**63]


def test_index_stops_early_on_proof():
    rng = np.random.default_rng(1)
    data = np.floor(256 * rng.standard_normal((4000, 8))).astype(np.int64)
    index = search.ImpactIndex(data)
    for q in range(20):
        rows, scores = index.search(data[q], 5, q)
        exact = data @ data[q]
        exact[q] = np.iinfo(np.int64).min
        assert sorted(scores)[::-1][:5] == sorted(exact)[::-1][:5] and len(rows) < 4000


PAGES = "page_id long, url string, html string, host string, path string, rule string, verdict string, key string, fit string"


def page(i, url, html=None):
    return (i, url, html, *["clash"] * 6)


def canonical(to):
    return f'<html><head><LINK href="{to}" rel="canonical"></head><body>x</body></html>'


def test_url_rules_and_aliases(spark):
    rows = [
        page(1, "http://a.example.org/es/x"), page(2, "http://EXAMPLE.org/en/15?q#f"), page(3, "http://x.org/en/1"), page(4, "http://x.com/de/1"), page(5, "http://x.com/fr/1"),
        page(6, "http://notexample.net/es/"), page(7, None), page(8, "no scheme"), page(9, "http://h.net"), page(10, ""),
        # chain of aliases to a blocked page, another to a blocked and an allowed one
        page(20, "http://b.net/1", canonical("http://b.net/2")), page(21, "http://b.net/2", canonical("/3")), page(22, "http://b.net/3", canonical("http://x.com/de/1")),
        page(30, "http://c.net/1", canonical("http://x.com/de/7")), page(31, "http://c.net/2", canonical("http://c.net/1")), page(32, "http://c.net/2", canonical("http://x.com/fr/7")),
        page(40, "http://d.net/a", '<meta http-equiv="refresh" content="0; url=http://x.com/de/9">'), page(41, "http://d.net/a#top"), page(42, "http://d.net/b")]
    df = spark.createDataFrame(rows + [rows[10]] * 3, PAGES)
    extra = spark.createDataFrame([("http://d.net/b", "http://d.net/a"), (None, "http://d.net/b")], "from_url string, to_url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(df, extra).collect()}
    assert got[1] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[2] == ("example.org", "/en/15", "example.org/en/1", "block")
    assert got[3] == ("x.org", "/en/1", "org/", "allow")
    assert got[4][2:] == ("com/de/", "block") and got[5][2:] == ("com/fr/", "allow")
    assert got[6] == ("notexample.net", "/es/", None, "allow")
    assert got[7] == got[8] == got[10] == ("", "", None, "allow") and got[9] == ("h.net", "", None, "allow")
    assert [got[i][3] for i in (20, 21, 22)] == ["block"] * 3
    assert [got[i][3] for i in (30, 31, 32)] == ["allow"] * 3      # an explicit allow goes before
    assert [got[i][3] for i in (40, 41, 42)] == ["block"] * 3
    assert urls.filter_urls(df).count() == len(rows) + 3
    assert urls.filter_urls(df.limit(0)).collect() == []


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000 + rng.randrange(80), 5000 + rng.randrange(80)) for _ in range(60)] + [(7, 7), (None, 3)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    from lakebank.llm.neardup import contract

    df = spark.createDataFrame(edges, "u long, v long")
    for pre in (None, contract):
        got = {r.node: r.component for r in common.components(df, "test", pre).collect()}
        assert got == {x: find(x) for x in up}


def expected_text(html):
    """Blocks of the article by the rule that labels the training sample."""
    return " ".join(t for t, path, _ in pagetext.blocks(html) if pagetext.teach(path))


def test_page_text_held_out(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    net = pagetext.train(pages.where("page_id % 2 = 0"))
    got = pagetext.extract(pages.where("page_id % 2 = 1"), net).join(pages.select("page_id", "html"), "page_id").collect()
    assert sum(r.text == expected_text(r.html) for r in got) >= 0.98 * len(got)
    long = "<html><body><nav><ul><li><a>x</a></li></ul></nav><article>" + "<p>word after word.</p>" * 5000 + "</article></body></html>"
    odd = [(1, None, None, "t", 1), (2, "u", "", "t", 1), (3, "u", "   ", "t", 1), (4, "u", "<", "t", 1), (5, "u", long, "t", 1), (5, "u", long, "t", 1)]
    out = {r.page_id: r for r in pagetext.extract(spark.createDataFrame(odd, "page_id long, url string, html string, text string, n_chars int"), net).collect()}
    assert [out[i].text for i in (1, 2, 3)] == [""] * 3 and out[5].n_blocks == 5001
    assert out[5].text.count("word after word.") >= 4950
    assert pagetext.extract(pages.limit(0), net).collect() == [] and pagetext.train(pages.limit(0))


def test_blocks():
    html = """<!DOCTYPE html><title>no</title><body><!-- no <p> --><script>var a="<p>no</p>";</script><nav><a href="x">Men&uuml;</a></nav>
    <article class="post main-text"><p>One<b> bold<br>two &amp; &#8364;<p>three<ul><li>four<li>five</ul></article><p>six &am"""
    got = pagetext.blocks(html)
    assert [t for t, _, _ in got] == ["Menü", "One bold two & €", "three", "four", "five", "six &am"]
    assert got[1][1] == ("body", "article", "class=post", "class=main", "class=text", "p")
    assert got[0][2] == 1.0 and got[1][2] == 0.0
    assert not re.search("[<>]", " ".join(t for t, _, _ in got))


@pytest.mark.parametrize("before", [
    '<svg viewBox="0 0 1 1"/>', "<svg/>", "<svg />", "<svg-icon name=x></svg-icon>", "<select-menu></select-menu>", "<title-bar></title-bar>", "<template-part>",
    "<object-view>", "<script-x>", "<svg>", "<select>", "<object data=x>", "<template>", "<noscript>", "<SVG/><Select>", "<svg><path d=x/><text>no</text></svg>",
    "<select><option>no</select>", "<object>no</object >", "<template><p>no</p></template>", "<noscript>no</noscript>", "<svg/><svg>no</svg>"])
def test_blocks_go_on_after(before):
    got = [t for t, _, _ in pagetext.blocks(f"<body>{before}<article><p>one</p><p>two</p></article>")]
    assert got == ["one", "two"]


def test_blocks_end_with_unclosed_raw_text():
    for name in ("script", "style", "textarea", "title", "iframe"):
        assert [t for t, _, _ in pagetext.blocks(f"<p>one</p><{name} a=b>x<p>two</p>")] == ["one"]
    assert len(pagetext.blocks("<object><p>x</p>" * 20_000)) == 20_000


def test_lstm_gradients():
    net = pagetext.BiLstm(5, 3)
    rng = np.random.default_rng(0)
    x, lens = rng.standard_normal((2, 4, 5)).astype(np.float32), np.array([4, 2])
    y = np.array([[1, 0, 1, 0], [0, 1, 0, 0]], np.float32)
    mask = np.arange(4) < lens[:, None]

    def loss():
        z = net.scores(x, lens).astype(float)
        return ((np.log1p(np.exp(z)) - y * z) * mask).sum() / mask.sum()

    for name, grad in net.gradients(x, lens, y).items():
        at = tuple(0 for _ in grad.shape)
        old = net.p[name][at]
        net.p[name][at] = old + 1e-2
        up = loss()
        net.p[name][at] = old - 1e-2
        down = loss()
        net.p[name][at] = old
        assert (up - down) / 2e-2 == pytest.approx(float(grad[at]), abs=2e-4)




ARTICLE = ["The council met on Tuesday to discuss the new bridge over the river, which has been planned for many years.",
           "Most members spoke in favour of the plan. Some asked how it will be paid for.", "A second meeting follows in May."] + [
           f"Paragraph {i} tells more about the bridge, its builders, and the people who live on both banks of the river." for i in range(5)]
AROUND = '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav>', '<aside class="sidebar"><p>Most read</p></aside><footer><p>All rights reserved</p></footer>'


@pytest.fixture(scope="module")
def net(spark):
    return pagetext.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


@pytest.mark.parametrize("start, end", [("<article>", "</article>"), ('<div class="content">', "</div>"), ('<div id="main">', "</div>"), ('<div class="post-body">', "</div>"),
                                        ("<table><tr><td>", "</td></tr></table>"), ("<div>", "</div>"), ('<section class="blog-entry">', "</section>")])
def test_articles_without_an_article_element(net, start, end):
    body = "".join(f"<p>{p}</p>" for p in ARTICLE)
    found = pagetext.blocks(f"<html><head><title>t</title></head><body>{AROUND[0]}{start}{body}{end}{AROUND[1]}</body></html>")
    (good,) = net.label([pagetext.features(found, pagetext.WordHashes())])
    assert [t for (t, _, _), y in zip(found, good) if y] == ARTICLE


def test_deep_pages_stay_linear():
    import time
    import tracemalloc

    page = "<div class=a>x" * 40_000
    tracemalloc.start()
    begin = time.monotonic()
    found = pagetext.blocks(page)
    pagetext.features(found, pagetext.WordHashes())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 40_000 and peak < 250 << 20 and time.monotonic() - begin < 30
    assert len(pagetext.blocks("</b></i>" * 40_000 + "<div>" * 40_000 + "</p><li>x" * 20_000)) == 20_000
