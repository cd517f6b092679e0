"""Page text: exact marginals and gradient, odd markup, held-out layouts, and the table's pages."""

import itertools

import numpy as np
import pytest

from policylens.llm import page_text
from policylens.llm.page_dom import TAGS, parse
from policylens.llm.page_samples import PAGES

SCHEMA = "page_id long, url string, html string, text string, n_chars string, h string, w string"


@pytest.fixture(scope="module")
def model():
    return page_text.train([])


def blocks(page):
    return [t for t in parse(page).text if t]


def labelled(page):
    tree = parse(page)
    return "\n".join(t for t, y in zip(tree.text, tree.label, strict=True) if t and y)


def energy(f, unary, pair, y):
    edges = np.flatnonzero(f.parent >= 0)
    return (unary * y).sum() + pair[f.kinds()[edges], y[f.parent[edges]], y[edges]].sum()


@pytest.mark.parametrize("pages", [["<p>one</p>"], ["<div><p>a<p>b</div>c<ul><li>d</ul>", "", "x<h1>y"]])
def test_marginals_equal_enumeration(pages):
    f, r = page_text.forest([parse(p) for p in pages]), np.random.default_rng(3)
    n = len(f.parent)
    unary, pair = r.normal(size=n), r.normal(size=(3, 2, 2))
    states = [np.array(y) for y in itertools.product((0, 1), repeat=n)]
    weight = np.exp([energy(f, unary, pair, y) for y in states])
    p, both, log_z = page_text.marginals(f, unary, pair)
    assert np.isclose(log_z, np.log(weight.sum()))
    assert np.allclose(p, sum(w * y for w, y in zip(weight, states, strict=True)) / weight.sum())
    for e in np.flatnonzero(f.parent >= 0):
        want = np.zeros((2, 2))
        for w, y in zip(weight, states, strict=True):
            want[y[f.parent[e]], y[e]] += w / weight.sum()
        assert np.allclose(both[e], want)


def test_training_raises_the_likelihood(model):
    def likelihood(w, pair):
        f = page_text.forest([parse(p) for p in PAGES])
        return energy(f, f.features @ w, pair, f.label) - page_text.marginals(f, f.features @ w, pair)[2]
    start = likelihood(np.zeros(page_text.WIDTH), np.zeros((3, 2, 2)))
    assert likelihood(model.weights, model.pair) > 0.1 * start


def test_labelled_pages_come_back(model):
    assert model.texts(list(PAGES)) == [labelled(p) for p in PAGES]
    assert [model.texts([p])[0] for p in PAGES] == model.texts(list(PAGES))  # a page does not depend on its neighbours


HELD_OUT = [
    """<html><body><div id="top-nav"><a href="/">Home</a><a href="/n">News</a></div><div id="main-content" data-main="1"><h1>Eels</h1><p>Eels climb the weir at night, when the water is low &amp; warm.</p><p>Nobody has seen them spawn.</p></div>
    <div class="sidebar"><h3>Related</h3><ul><li><a href="/1">Salmon come back</a></li></ul></div><div class="comments"><div class="comment"><p>I saw one as long as my arm, and it looked back at me.</p></div></div><footer>&copy; Fish Weekly</footer></body></html>""",
    """<body><header><h2>The Gazette</h2><nav><a href="/a">Front</a></nav></header><div class="cookie-banner">This site uses cookies. <button>OK</button></div><article data-main="1"><h1>Fire in the mill</h1><p>It broke out at four.
    <p>By six it was out.<ul><li>No one was hurt.</li><li>Two cats are missing.</li></ul><div class="advertisement" data-main="0"><p>Insure your home with us today.</p></div></article><aside><p>Subscribe to the paper edition and save a third.</p></aside></body>""",
    """<body><main data-main="1"><h1>Tea</h1><section><h2>Green</h2><p>Steep for two minutes, no longer.</p></section><section><h2>Black</h2><p>Steep for four; add milk if you must.</p></section></main><form action="/s"><label>Search this site</label><input></form></body>""",
]


def test_held_out_layouts(model):
    assert model.texts(HELD_OUT) == [labelled(p) for p in HELD_OUT]


def test_odd_markup():
    assert blocks("") == [] and blocks("<p></p><br>") == []
    assert blocks("a<b>b</b>c<br>d") == ["abc d"]
    assert blocks("<p>one<p>two<li>three<li>four") == ["one", "two", "three", "four"]
    assert blocks("<p>a &amp; b &lt;&#65;&#x42; &nbsp; c&eacute;</p>") == ["a & b <AB cé"]
    assert blocks("1 < 2 <3 and x</p>") == ["1 < 2 <3 and x"]
    assert blocks("<script>var t='<p>no</p>';</script>yes<style>p{}</style><!-- <p>no</p> --><![CDATA[x]]>") == ["yes"]
    assert blocks("<script>never ends <p>x") == [] and blocks("x<!-- never ends <p>y") == ["x"] and blocks("x<p title='never ends>y") == ["x", "y"]
    assert blocks("<form>a<select><option>x<option>y</select><button>z</button><textarea><p>q</textarea>b</form>") == ["a", "b"]
    assert blocks("<a title='>' href=x>t</a><P CLASS=\"q\">U</P>") == ["t", "U"]
    assert blocks("<div><b>x<p>y</b>z</div>w") == ["x", "yz", "w"]
    assert blocks("<head><title>t</title><p>body starts") == ["body starts"]
    assert blocks("<table><tr><td>a<td>b<tr><td>c</table>d") == ["a", "b", "c", "d"]
    deep = parse("<div>" * 5000 + "x" + "</div>" * 5000 + "<b>" * 50000 + "y" + "</i>" * 50000)
    assert [t for t in deep.text if t] == ["x", "y"] and max(deep.depth) <= 257
    assert len(TAGS) == len(set(TAGS))


@pytest.mark.parametrize("page", ["<" * 400_000, "<a " * 200_000, "<!--" * 100_000, "<p title=\"" * 50_000, "&" * 400_000, "<p>" * 100_000, "</p>" * 100_000, "<b><i>" * 50_000 + "</b></i>" * 50_000])
def test_long_odd_pages_take_linear_time(model, page):
    assert isinstance(model.texts([page])[0], str)


def test_rows(spark, model):
    rows = [(1, "u", HELD_OUT[0]), (1, "u", HELD_OUT[0]), (1, "v", ""), (None, None, HELD_OUT[2]), (3, "w", None), (4, "x", "<p>" + "word, and another. " * 200_000)]
    df = spark.createDataFrame([(*r, "t", "n", "h", "w") for r in rows], SCHEMA).repartition(2)
    got = page_text.extracted(df, df["page_id"], df["url"], df["html"], model)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    want = [(i, u, t, len(t)) for (i, u, h), t in zip(rows, model.texts([h or "" for _, _, h in rows]), strict=True)]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert [r[3] for r in want[2:5:2]] == [0, 0] and want[5][3] > 3_000_000
    empty = df.limit(0)
    fitted = page_text.fit(empty, empty["page_id"], empty["html"])
    assert page_text.extracted(empty, empty["page_id"], empty["url"], empty["html"], fitted).count() == 0
    assert np.allclose(fitted.weights, model.weights)  # no page of the table: the library's own alone
