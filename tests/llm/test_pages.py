"""Main text of pages: the table's articles, held-out layouts, and odd pages."""

from __future__ import annotations

import html
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from hiremart.llm import dom, html_text, page_samples
from tests.conftest import SF
from tests.llm import cases


@pytest.fixture(scope="module")
def model():
    words = "the of and thing, erth onan. inthe reand stedly a with for ble nd ouer".split()
    return html_text.train(words, samples=500)


def article(page):
    body = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
    body = re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", body))
    return " ".join(html.unescape(body).split())


def test_table(spark):
    got = {r["page_id"]: r for r in entry.queries()["op7_html_text"](spark, SF).collect()}
    for r in cases.table(spark, SF, "pages"):
        assert got[r["page_id"]]["text"] == article(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])
        assert got[r["page_id"]]["url"] == r["url"]


def test_held_out_layouts(model):
    sampler = page_samples.Sampler("other words. than, those in train ing are here".split(), 1234)
    pages = [sampler.page() for _ in range(150)]
    right = 0
    for page, text in zip(pages, html_text.extract_all(model, pages)):
        parsed = dom.Page(page)
        right += text == html_text.main_text(parsed, html_text.sample_marks(parsed))
    assert right >= 0.95 * len(pages)


def test_decoding_is_the_best_allowed(model):
    sampler = page_samples.Sampler(["w"], 5)
    for _ in range(20):
        page = dom.Page(sampler.page())
        states = html_text.decode(page.parent, model.log_probability(dom.features([page])))
        assert all(s in html_text.ALLOWED[states[p]] for s, p in zip(states, page.parent) if p >= 0)


def test_dom_closes_what_html_closes():
    page = dom.Page("<p>a<b>c<p>d<ul><li>e<li>f</ul></x><script>var t='</p><p>';</script><!-- <p> --><br>g<img alt='>'>h")
    assert page.tag == ["#page", "p", "b", "p", "ul", "li", "li"]
    assert page.parent == [-1, 0, 1, 0, 0, 4, 4]
    assert "".join(t for _, t in page.segments).split() == ["a", "c", "d", "e", "f", "gh"] or \
        "".join(t for _, t in page.segments).split() == ["ac", "d", "e", "f", "gh"]
    assert all(e > i for i, e in enumerate(page.end))


@pytest.mark.parametrize("icon", [
    '<svg class="i"/>', '<svg/>', '<svg\nviewBox="0 > 1" />', '<svg-icon></svg-icon>', '<svg-icon name="x"/>', "<title-bar></title-bar>",
    "<select-box></select-box>", "<object-x><canvas-y></canvas-y></object-x>", "<svg><title>no</title><path d='M0'/></svg>",
    "<SVG width='1'><g/>no</SVG>", "<script/>no</script>", "<select><option>no</select>"])
def test_icons_and_custom_elements_end_where_they_end(icon):
    page = dom.Page(f"<p>a {icon} b</p><p>rest</p>")
    assert "".join(t for _, t in page.segments).split() == ["a", "b", "rest"]


def test_unclosed_canvas_and_object_do_not_swallow_the_page():
    shown = lambda html: "".join(t for _, t in dom.Page(html).segments).split()
    assert shown("<p>a</p><canvas>b<p>rest of article</p>") == ["a", "b", "rest", "of", "article"]
    assert shown("<p>a</p><object data='x'>b<p>rest</p>") == ["a", "b", "rest"]
    assert shown("<p>a <canvas id=c>no</canvas> b</p><object><param>no</object><p>c</p>") == ["a", "b", "c"]
    assert len(shown("<canvas>x " * 20_000)) == 20_000


def test_odd_pages(spark, model):
    deep = "<div>" * 3_000 + "x" + "</div>" * 3_000
    texts = [None, "", "plain words only", "<", "<p", "<!-- open", "<script>x", "</p></div>", deep, "<article><p>a&amp;b &lt;c&gt;"
             "&nbsp;d&#233; &am</p><p>e\n\t f</p></article>", "<article>" + "<p>word word.</p>" * 20_000 + "</article>"]
    rows = [(i, f"u{i}", t, "clash") for i, t in enumerate(texts)] + [(None, None, "<article><p>z z</p></article>", "clash")] * 2
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = html_text.extract(pages, model, ["page_id", "url"]).collect()
    assert len(got) == len(rows) and all(r["text"] is not None for r in got)
    by = {r["page_id"]: r["text"] for r in got}
    assert by[0] == by[1] == ""
    assert by[9] == "a&b <c> dé &am e f"
    assert len(by[10].split()) == 40_000
    assert pages.where(F.lit(False)).transform(lambda p: html_text.extract(p, model, ["page_id"])).count() == 0
