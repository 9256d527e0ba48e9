import html
import re

import numpy as np
import pytest

import __spark_entry__ as E
from worklake.llm import html_extract as H


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet").limit(120).cache()


@pytest.fixture(scope="module")
def trees(pages):
    return H.train(pages)


def article(page):
    found = re.search("<article>(.*?)(</article>|$)", page, re.DOTALL)
    return " ".join(html.unescape(re.sub("<[^>]*>", " ", found[1])).split())


def test_articles_of_the_table(pages, trees):
    rows = {r.page_id: r for r in H.extract_text(pages, trees).collect()}
    for p in pages.collect():
        assert rows[p.page_id].text == article(p.html) and rows[p.page_id].n_chars == len(article(p.html))
        assert rows[p.page_id].url == p.url


def test_unseen_layouts(pages, trees):
    draw, scores = np.random.default_rng(77), []
    for p in pages.collect():
        page = H.training_page(*H.snippets(H.parse(p.html)), draw)
        wanted = [w for n in H.nodes_of(H.parse(page)) for x in n.items if isinstance(x, str) and H._MARK in x
                  for w in html.unescape(x).replace(H._MARK, "").split()]
        got = H.extract_batch([page.replace(H._MARK, "")], trees)[0].split()
        shared = len(set(wanted) & set(got))
        scores.append(2 * shared / max(1, len(set(wanted)) + len(set(got))))
    assert np.mean(scores) > 0.8


def test_parsing():
    text = lambda page: H.text_of(r := H.parse(page), [True] * len(H.nodes_of(r)))
    assert text("<p>a &amp; b&nbsp;c<br>d<p>e <b>f</b>g") == "a & b c d e fg"
    assert text("<script>var a='<p>no</p>'</script><style>p{}</style>x<!-- <p>no -->y") == "xy"
    assert text("<textarea>no</textarea><p title='a>b' hidden>no</p><p style='display: none'>no</p>yes") == "yes"
    assert text("1 < 2 <p>unclosed <a href='x") == "1 < 2 unclosed"
    assert text("") == "" and text("</p></div>a</b>") == "a" and text("a &am") == "a &am"
    assert text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


def test_broken_pages_are_parsed_in_linear_time():
    import time

    began = time.perf_counter()
    for piece in ("<a ", '<a "', "1 <b ", "<a '\"", '<a "><', "<!-", "<p title='", "<", "</", '<i "x">\'', "<!--"):
        H.parse(piece * (2_000_000 // len(piece)))
        H.parse(piece * (500_000 // len(piece)) + "> <p>end</p>")
    assert time.perf_counter() - began < 60
    text = lambda page: H.text_of(r := H.parse(page), [True] * len(H.nodes_of(r)))
    assert text('<div title="unclosed><p>one</p><p>two</p>') == "one two"
    assert text("<a title='it's'>one</a> <b title=\"x>y\">two</b>") == "one two"
    assert text('a <b "><c>') == "a"


def test_formulas_and_fallbacks_are_text():
    text = lambda page: H.text_of(r := H.parse(page), [True] * len(H.nodes_of(r)))
    assert text("<article><p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p><video>no player</video></article>") == "so x=2 holds no player"


def test_hidden_is_an_attribute_of_that_name():
    for raw in ('aria-hidden="false"', 'href="/hidden-gems"', "title='hidden gems'", "src=/hidden.png alt=hidden", 'data-hidden class="a"',
                "title='style=\"display: none\"'"):
        assert not H.attribute_words(f" {raw}")[1], raw
    for raw in ("hidden", "HIDDEN", 'id=a hidden=""', "hidden/", 'title="a"hidden', "class = 'x' hidden", 'style="display:none"'):
        assert H.attribute_words(f" {raw}")[1], raw
    assert H.attribute_words(" width=9 id='mainStory' title='class=\"ad\"' CLASS=post-body/x")[0] == {"main", "story", "post", "body", "x"}
    assert "gems" in str(H.parse("<article aria-hidden='false'><p>see <a href='/hidden-gems'>gems</a></p></article>").items[0].items[0].items[1].items)


def test_decoding_never_contradicts(pages, trees):
    for p in pages.limit(30).collect():
        order = H.nodes_of(H.parse(p.html))
        odds = trees.log_odds(H.features_of(order))
        keep = H.decode(order, odds)
        score = lambda k: sum(o if x else -o for o, x, n in zip(odds, k, order, strict=True) if n.stats[0])
        assert score(keep) >= max(score([True] * len(order)), score([False] * len(order))) - H.SPLIT * len(order)


def test_edge_rows(spark, trees):
    df = spark.createDataFrame([(1, "u", None, 0), (2, None, "", 0), (2, None, "", 0), (None, "u", "<p>", 1),
                                (5, "u", "<nav>a</nav><article><p>" + "Some words. " * 30_000, 2)],
                               "page_id long, url string, html string, n_chars int")
    rows = {r.page_id: r for r in H.extract_text(df, trees).collect()}
    assert rows[1].text == rows[2].text == rows[None].text == "" and rows[5].n_chars > 300_000
    assert H.extract_text(df.limit(0)).count() == 0
    assert [r.text for r in H.extract_text(df.where("page_id = 1")).collect()] == [""]


def test_query(spark, sf_small):
    got = {r.page_id: r.text for r in E.queries()["op3_html_extraction"](spark, sf_small).collect()}
    assert got == {p.page_id: article(p.html) for p in spark.read.parquet(f"{sf_small}/pages.parquet").collect()}
