import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import html_extract as op
from orderlens.llm.html_tree import read_page

PAGES = "/root/testdata/sf0.1/pages.parquet"


@pytest.fixture(scope="module")
def model(spark):
    return op.fit(spark.read.parquet(PAGES))


def test_marginals_are_those_of_all_labellings(model):
    page = read_page("<body><nav><ul><li>a<li><a href=x>b</a></ul></nav><div class=post><h1>x y</h1><p>One two. Three"
                     "<p>foo <span class=ad>bar</span></div><footer>z")
    batch = op.batch_of([page, read_page("<p>x"), page])
    size = len(page.tag)
    own = np.bincount(batch.node, model.unary[batch.feature], len(batch))
    total, content = 0.0, np.zeros(size)
    for labels in itertools.product((0, 1), repeat=size):
        weight = np.exp(sum(own[i] for i in range(size) if labels[i]) + sum(
            model.pair[batch.kind[i], labels[page.parent[i]], labels[i]] for i in range(1, size)))
        total, content = total + weight, content + weight * np.array(labels)
    got, _ = op.marginals(batch, model)
    assert np.allclose(got[:size], content / total) and np.allclose(got[-size:], content / total)


def test_tree():
    page = read_page("<html><body class='a b'><ul><li>one<li>two</ul><p>x<b>y<p>z<table><tr><td>1<td>2<tr><td>3</table>"
                     "<!-- <p>no --><script>var t='</p>';</script><p title='a>b'>q &amp; r&nbsp;s</p>tail")
    blocks = list(zip(page.tag, (page.tag[p] if p >= 0 else None for p in page.parent)))
    assert blocks == [("html", None), ("body", "html"), ("ul", "body"), ("li", "ul"), ("li", "ul"), ("p", "body"),
                      ("p", "body"), ("table", "body"), ("tr", "table"), ("td", "tr"), ("td", "tr"), ("tr", "table"),
                      ("td", "tr"), ("p", "body")]
    assert op.main_text(page, np.ones(len(page.tag), bool)).split("\n") == [
        "one", "two", "xy", "z", "1", "2", "3", "q & r s", "tail"]


def test_formulas_and_fallback_texts_are_text():
    page = read_page("<article><p>It says that <math><mi>E</mi>=<mi>m</mi><annotation>E = m</annotation></math> holds.</p>"
                     "<p>See <object data=x><param name=a>the <b>chart</b></object> and <map name=m>the map</map>.</p>"
                     "<svg><text>no</text></svg></article>")
    assert op.main_text(page, np.ones(len(page.tag), bool)).split("\n") == [
        "It says that E=m holds.", "See the chart and the map."]


def test_sample_is_the_same_however_pages_are_spread(spark):
    """Also where a third of all rows repeat one page; only as many pages as are learned from reach the driver."""
    pages = spark.read.parquet(PAGES).limit(300)
    repeated = pages.unionByName(pages.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(150)))).drop("n"))
    models = [op.fit(p, 20) for p in (pages.repartition(3), pages.repartition(17), repeated.repartition(11))]
    assert all(np.array_equal(m.unary, models[0].unary) for m in models)


def test_unseen_pages_and_layouts(spark, model):
    htmls = [r["html"] for r in spark.read.parquet(PAGES).orderBy("page_id").limit(400).collect()][200:]
    pages, labels = op.training_pages(htmls)
    right = sum(op.main_text(p, c) == op.main_text(p, y) for p, y, c in zip(
        pages, labels, [op.marginals(op.batch_of([p]), model)[0] >= 0.5 for p in pages]))
    assert right / len(pages) > 0.98


@pytest.mark.parametrize("html, text", [
    ("<html><body><header><h2>Site</h2><a href=/>Home</a></header><div class='cookie-notice'><p>We use cookies on this "
     "site.</p></div><main><h1>On water</h1><p>Water is wet &amp;   clear.<br>It flows, and it falls.</p><div class=ad>Buy "
     "now cheap</div><p>Rain feeds the rivers, and rivers feed the sea.</p></main><aside class=sidebar><h3>Popular</h3>"
     "<ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul></aside><section class=comments><h3>Comments</h3>"
     "<div class=comment><p>I like this article very much, thank you.</p></div></section><form><label>Mail</label>"
     "<input></form><footer><p>&copy; 2020 Site</p></footer>",
     "On water\nWater is wet & clear. It flows, and it falls.\nRain feeds the rivers, and rivers feed the sea."),
    ("<body><nav><a href=/>Home</a></nav><article><h1>T</h1></article><footer>c</footer>", "T"),
])
def test_written_pages(model, html, text):
    assert op.extract_pages([html], model) == [text]


def test_edge_cases(spark, model):
    deep, wide = "<div>" * 3000 + "x", "<p>a b c.</p>" * 20_000
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<"), (4, "u", "<p"), (5, "u", deep), (5, "u", deep), (6, "u", wide),
            (7, "u", "<script>"), (8, "u", "<!-- "), (9, "u", "&#x0; &bogus; &#99999999;"), (10, "u", "<a title='x>y"),
            (11, "u", "<article><p>" + "long words in a row, " * 30_000 + "</article>")]
    pages = spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id long, url string, html string, text string, h int")
    got = op.extract(pages, model).collect()
    assert sorted(((r["page_id"], r["url"]) for r in got), key=repr) == sorted(((r[0], r[1]) for r in rows), key=repr)
    assert all(r["text"] is not None for r in got)
    assert next(r["text"] for r in got if r["page_id"] == 11) == ("long words in a row, " * 30_000).strip()
    assert op.extract(pages.limit(0), op.fit(pages.limit(0))).collect() == []


def test_op4_gives_the_article(spark, small):
    """On the test pages the article is what stands between its tags; blocks are its headings and paragraphs."""
    import html as plain
    import re

    from orderlens.llm import queries
    source = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    for r in queries.op4_html_text(spark, small).collect():
        article = re.search("<article>(.*?)</article>", source[r["page_id"]], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(plain.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])
