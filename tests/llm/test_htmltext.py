import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riverframe.llm import htmltext

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>x";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- <p>hidden</p> -->
<div class="ad">Buy &amp; save.</div><div class="cookie-notice"><p>We use cookies, and we would like you to know.</p></div>
%s
<aside><p>Sidebar text that is long enough to look like a paragraph, really.</p></aside><form><p>Mail</p><input></form>
<section id="comments"><p>I think this is a very long comment by a reader, isn't it?</p></section><footer>&copy; x</footer></body></html>"""


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main>%s</main>", '<div id="content">%s</div>', '<div class="post-body">%s</div>'])
def test_main_text(wrap):
    body = "<h1>The   title &lt;1&gt;</h1><p><b>First paragraph, with some words\nand a <a href='/x'>link</a>.<br>More.<p>Second&nbsp;one is also quite long, as paragraphs are.</p><p></p><p>Third one ends the article here, with &quot;quotes&quot;.</p>"
    want = 'The title <1>\nFirst paragraph, with some words and a link. More.\nSecond one is also quite long, as paragraphs are.\nThird one ends the article here, with "quotes".'
    assert htmltext.main_text(PAGE % (wrap % body)) == want


def test_edge_cases(spark):
    rows = [
        (1, "u", None), (2, None, ""), (None, "u", "<article><p>x</p></article>"), (4, "u", "<nav>only</nav>"), (5, "u", "<article><p>cut of"), (6, "u", "<article><p>a</p><p class='"),
        (7, "u", "<article><p>" + "long words " * 50000 + "</p></article>"), (1, "u", None), (8, "u", "<article>a < b &am<p>&#233;&eacute;</article>"), (9, "u", "<script>var a = '<article>x"),
    ]
    df = spark.createDataFrame([(*r, "clash", 3) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = [(r["page_id"], r["url"], r["text"], r["n_chars"]) for r in htmltext.extract(df).collect()]
    assert all(n == len(t) for _, _, t, n in found)
    texts = {(i, u): t for i, u, t, _ in found}
    assert len(found) == 10 and texts[1, "u"] == "" and texts[2, None] == "" and texts[None, "u"] == "x" and texts[4, "u"] == "" and texts[5, "u"] == "cut of" and texts[6, "u"] == "a"
    assert texts[7, "u"] == ("long words " * 50000).strip() and texts[8, "u"] == "a < b &am\néé" and texts[9, "u"] == ""
    assert htmltext.extract(df.limit(0)).collect() == []


def value(weights, edges, side):
    """Capacity of the cut that ``side`` makes."""
    cost = sum(w for w, s in zip(weights, side, strict=True) if w > 0 and not s) + sum(-w for w, s in zip(weights, side, strict=True) if w < 0 and s)
    return cost + sum(c for i, j, c in edges if side[i] != side[j])


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(-8, 8), min_size=1, max_size=8), st.data())
def test_cut_is_minimal(weights, data):
    pairs = list(itertools.combinations(range(len(weights)), 2))
    edges = [(*p, float(data.draw(st.integers(0, 6)))) for p in data.draw(st.lists(st.sampled_from(pairs), max_size=12, unique=True))] if pairs else []
    weights = [float(w) for w in weights]
    best = min(value(weights, edges, side) for side in itertools.product([False, True], repeat=len(weights)))
    assert abs(value(weights, edges, htmltext.minimum_cut(weights, edges)) - best) < 1e-9


def test_smoothness_keeps_a_short_paragraph_among_long_ones():
    body = '<div id="content"><p>A long first paragraph, with more than enough words to be content by itself, surely.</p><p>Ok</p><p>A long last paragraph, with more than enough words to be content by itself, surely.</p></div>'
    assert "\nOk\n" in htmltext.main_text(body)


LONG = "A paragraph of ordinary prose, with more than enough words to be read as content by anybody, and it ends here."


@pytest.mark.parametrize("name", ["no-sidebar", "has-sidebar", "with-header", "sidebar layout"])
def test_names_of_wrappers_do_not_empty_a_page(name):
    page = f'<body><div class="{name}"><nav><a href="/">Home</a></nav><article><header class="entry-header"><h1>Headline</h1></header><p>{LONG}</p><div class="comments"><article class="comment"><p>I agree with it.</p></article></div></article></div></body>'
    assert htmltext.main_text(page) == "Headline\n" + LONG


def test_evidence_outweighs_a_name():
    long = " ".join([LONG] * 3)
    page = f'<div id="content"><p>{long}</p><div class="notice"><p>{long}</p></div><p>{long}</p><div class="notice"><p>Buy now</p></div></div>'
    assert htmltext.main_text(page) == "\n".join([long] * 3)


@pytest.mark.parametrize("body", ["<body><article><p>text</p></article>", "<article><p>text", "<body><main>text</main></body></html>"])
def test_a_head_without_its_end_tag(body):
    assert htmltext.main_text(f"<html><head><meta charset='utf-8'><title>T</title><link href='x'><style>p{{}}</style>\n{body}") == "text"
