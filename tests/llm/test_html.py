"""Main-text extraction against the article that the page was made of."""

import re

import numpy as np
import pytest

from conftest import SF
from topicflow.llm import html

PAGES = "/root/testdata/sf0.01"


def blocks_of(page):
    """The article's blocks by plain string work, for pages of the table's own form."""
    inside = page.partition("<article>")[2].partition("</article>")[0]
    blocks = re.split(r"</?(?:p|h1)>", inside)
    texts = (" ".join(html.entities.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks)
    return "\n\n".join(t for t in texts if t)


@pytest.fixture(scope="module")
def model(spark):
    return html.train(spark.read.parquet(f"{PAGES}/pages.parquet"))


def test_whole_table(spark, model):
    pages = spark.read.parquet(f"{PAGES}/pages.parquet")
    wanted = {r.page_id: blocks_of(r.html) for r in pages.collect()}
    got = html.extract(pages, model).collect()
    assert len(got) == len(wanted)
    assert all(r.n_chars == len(r.text) for r in got)
    same = np.mean([r.text == wanted[r.page_id] for r in got])
    assert same > 0.99


def run(page, model):
    nodes = html.parse(page)
    return html.written(nodes, html.decode(nodes, model.odds(html.features(nodes))))


ARTICLE = ["The first paragraph of a story that goes on for a while and says something.", "A second one &amp; it has\n  a  line break.", "Third: 1 &lt; 2, caf&eacute;, and the end of it all in a sentence of some length."]


@pytest.mark.parametrize("box", ["article", 'div class="post-content"', "main"])
def test_other_pages(model, box):
    body = "".join(f"<p>{p}</p>" for p in ARTICLE)
    page = f"""<html><head><title>T</title><style>p {{}}</style></head><body><header><p>Site name</p></header>
    <nav><ul><li><a href=/>Home</a></li><li><a href=/a>About us</a></li></ul></nav><aside class="sidebar"><p>Other stories you may like to read</p></aside>
    <{box}><h1>A headline</h1>{body}<script>var a = "</p>";</script><div class="ad"><p>Buy now for less</p></div></{box.split()[0]}>
    <div class="comments"><ul><li><p>I do not agree with this at all</p></li></ul></div><form><label>Mail</label><input></form>
    <div class="cookie-notice"><p>We use cookies to do things</p></div><footer><p>&copy; Somebody</p></footer></body></html>"""
    want = "\n\n".join(["A headline", *[" ".join(html.entities.unescape(p).split()) for p in ARTICLE]])
    assert run(page, model) == want


def test_parse_of_broken_markup():
    text = lambda page: html.written(nodes := html.parse(page), [True] * len(nodes))
    assert text("") == "" and text("plain <b>bold</b> text") == "plain bold text"
    assert text("<p>a<p>b<div>c</p>d") == "a\n\nb\n\nc\n\nd"
    assert text("a < b <3 x") == "a < b <3 x"
    assert text("<ul><li>x<li>y</ul><!-- no --> z<script>1<2</script>") == "x\n\ny\n\nz"
    assert text("<p title='a>b'>in</p><p class=\"x") == "in\n\n<p class=\"x"
    assert text("<p>one<br>two&nbsp;&#8364;</p>") == "one two €"
    assert len(html.parse("<div>" * 3000 + "x")) == 3002


def test_nothing_is_lost_after_self_closed_or_unclosed_tags(model):
    text = lambda page: html.written(nodes := html.parse(page), [True] * len(nodes))
    for tag in ("svg", "math"):
        assert text(f"<p>one <{tag} class='i'/> two</p><p>three</p>") == "one two\n\nthree"
    for tag in ("button", "select", "object", "template", "noscript", "svg"):
        assert text(f"<{tag}><p>one</p><p>two</p>") == "one\n\ntwo"
    assert text("<p>Let <math><mi>x</mi><mo>=</mo><mspace/><mn>1</mn></math> be so.</p>") == "Let x=1 be so."
    assert text("<p>a</p><script>if (1 < 2) '<p>b</p>'</script><textarea><p>c</p></textarea><p>d") == "a\n\nd"
    body = "".join(f"<p>{p}</p>" for p in ARTICLE)
    want = "\n\n".join(" ".join(html.entities.unescape(p).split()) for p in ARTICLE)
    assert run(f"<html><body><svg width='9'/><article>{body}</article></body></html>", model) == want


def test_decoding_is_the_best_labelling():
    draw = np.random.default_rng(0)
    for _ in range(50):
        n = 9
        nodes = [html.Node("div", -1 if k == 0 else int(draw.integers(0, k)), 0) for k in range(n)]
        odds = draw.normal(0, 2, n)
        kept = html.decode(nodes, odds)
        value = lambda label: sum(-np.logaddexp(0, -o) if x else -np.logaddexp(0, o) for x, o in zip(label, odds))  # noqa: B023, E731
        fine = [label for label in ([bool(m >> k & 1) for k in range(n)] for m in range(1 << n)) if all(not label[k] or nodes[k].parent < 0 or label[nodes[k].parent] for k in range(n))]
        assert kept in fine and np.isclose(value(kept), max(map(value, fine)))


def test_odd_rows(spark, model):
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (None, "u", "no tags"), (3, "u", "<p>" + "word " * 50_000), (4, "u", "<<<>>>&&;</p></x>")]
    pages = spark.createDataFrame([(*r, 5, "x") for r in rows], "page_id long, url string, html string, n_chars long, text string")
    got = html.extract(pages, model).collect()
    assert sorted(str((r.page_id, r.url)) for r in got) == sorted(str(r[:2]) for r in rows)
    assert all(r.text == "" and r.n_chars == 0 for r in got if r.page_id in (1, 2))
    assert html.extract(pages.limit(0)).count() == 0
    assert html.extract(pages).count() == len(rows)  # nothing to learn from


P = [" ".join(html.entities.unescape(p).split()) for p in ARTICLE]
PS = "".join(f"<p>{p}</p>" for p in ARTICLE)
DIVS = "".join(f"<div>{p}</div>" for p in ARTICLE)


@pytest.mark.parametrize("article, want", [
    (f"<article>{PS}<ul><li>Flour and water in a bowl</li><li>A little salt</li><li>Yeast from the day before</li></ul></article>", [*P, "Flour and water in a bowl", "A little salt", "Yeast from the day before"]),
    (f"<article>{PS}<table><tr><td>Length of the river</td><td>two hundred miles</td></tr></table></article>", [*P, "Length of the river", "two hundred miles"]),
    (f"<article>{PS}<blockquote><p>He said that it was the best of all the days he had.</p></blockquote></article>", [*P, "He said that it was the best of all the days he had."]),
    (f"<article>{DIVS}</article>", P),
    (f'<div class="content">{DIVS}</div>', P),
    (f'<div class="content sidebar-right">{PS}</div>', P),
    (f'<article><div class="text side">{PS}</div></article>', P),
], ids=["list", "table", "quote", "div paragraphs", "div box", "misleading box", "misleading box inside"])
@pytest.mark.parametrize("whole_form", [False, True])
def test_main_text_of_many_forms(model, article, want, whole_form):
    page = f"""<nav><ul><li><a href=/>Home</a></li><li><a href=/a>About us</a></li></ul></nav><h1>A headline</h1>{article}<footer><p>&copy; Somebody</p></footer>"""
    page = f"<html><body>{'<form>' if whole_form else ''}{page}{'</form>' if whole_form else ''}</body></html>"
    assert [b for b in run(page, model).split("\n\n") if b != "A headline"] == want


def test_long_pages_do_not_use_up_the_sample(spark):
    pages = spark.createDataFrame([(k, "u", "<article><p>" + "word " * (html.SAMPLE_CHARS if k < 3 else 40) + "</p></article><footer><p>end</p></footer>") for k in range(12)], "page_id long, url string, html string")
    assert html.train(pages) is not None
