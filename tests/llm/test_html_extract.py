from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as some

from tabforge.llm import html_extract as hx


@pytest.fixture(scope="module")
def model():
    return hx.fit_chain(hx.labelled_layouts(300, 3))


def text_of(model, page: str) -> str:
    blocks = hx.leaf_blocks(page)
    return "\n".join(b.text for b, y in zip(blocks, model.decoder()(blocks), strict=True) if y)


def test_leaf_blocks():
    page = "<p>a &amp; b<br>c  d<p><b>e</b>f<script>x</p></script><!-- y --></div><ul><li>g<li>h</ul>&copy; i &am <td title='a>b'>j"
    assert [b.text for b in hx.leaf_blocks(page)] == ["a & b c d", "ef", "g", "h", "© i &am", "j"]
    assert hx.leaf_blocks(None) == hx.leaf_blocks("") == hx.leaf_blocks(" \n") == []
    assert hx.leaf_blocks('<div class="Side Bar" id=x1><p>t')[0].path == ("div side bar x", "p")


@given(some.text(alphabet="<>/apdiv \"'=&;!-", max_size=80))
@settings(max_examples=150, deadline=None)
def test_broken_markup_is_read(page):
    assert all(b.text == " ".join(b.text.split()) != "" for b in hx.leaf_blocks(page))


PAGE = """<html><head><title>T</title></head><body><header><a href="/">Home</a></header><nav><ul><li><a href="/a">A</a></li></ul></nav>
<div class="cookie-notice"><p>This site uses cookies for a better visit.</p></div>
<article><h1>Headline of the day</h1><p>The first long paragraph of the article tells the story of a day.</p>
<aside>Related: another story</aside><p>The second&nbsp;paragraph &lt;ends&gt; it,
with <b>bold</b> words.</p><ul><li>One point of some length here.</li></ul>
<section class="comments"><p>Reader: I do not agree with this at all.</p></section></article>
<div class="sidebar"><p>Most read stories of the week in a list.</p></div><div class="ad">Buy this now.</div>
<form><label>Mail</label><input><button>Send</button></form><footer>&copy; 2024</footer><script>var t='<p>x</p>';</script></body></html>"""


def test_a_page_with_everything_around(model):
    expected = "Headline of the day\nThe first long paragraph of the article tells the story of a day.\nThe second paragraph <ends> it, with bold words.\nOne point of some length here."
    assert text_of(model, PAGE) == expected
    without_tag = PAGE.replace("<article>", '<div class="content">').replace("</article>", "</div>")
    assert text_of(model, without_tag) == expected


def test_held_out_layouts(model):
    decode, wrong, total = model.decoder(), 0, 0
    for blocks, labels in hx.labelled_layouts(120, 99):
        wrong += sum(a != b for a, b in zip(decode(blocks), labels, strict=True))
        total += len(labels)
    assert wrong / total < 0.03


def test_viterbi_against_all_labellings(model):
    import itertools

    decode = model.decoder()
    for blocks, _ in hx.labelled_layouts(40, 5):
        blocks = blocks[:8]
        emit = [sum(model.weights.get(f, 0.0) for f in hx.features_of(b)) for b in blocks]

        def score(labels, emit=emit):
            moves = sum(model.moves[a][b] for a, b in zip(labels, labels[1:], strict=False))
            return model.start[labels[0]] + moves + sum(e for e, y in zip(emit, labels, strict=True) if y)

        best = max(itertools.product((0, 1), repeat=len(blocks)), key=score)
        assert score(decode(blocks)) == pytest.approx(score(best))


def test_table(spark, model):
    rows = [(1, "u", PAGE), (2, None, None), (3, "v", ""), (4, "w", "<article><p>" + "word " * 60_000 + "</p></article>"), (1, "u", PAGE)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' AS TEXT")
    found = hx.extract_text(pages, model).collect()
    assert [r["n_chars"] for r in found] == [len(r["text"]) for r in found]
    assert sorted(len(r["text"]) for r in found)[:2] == [0, 0] and max(r["n_chars"] for r in found) == 299_999
    assert hx.extract_text(pages.limit(0), hx.fit_extractor(pages.limit(0), layouts=40)).count() == 0


def test_formulas_pictures_and_fallbacks_in_the_article():
    """Only what never renders goes; a self-closed svg, math or style takes nothing with it."""
    page = (
        '<article><p>One <svg class="i" viewBox="0 0 1 1"/>two.</p><p>Here <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds.</p>'
        "<p>Empty <math/>formula.</p><svg><title>icon</title><style/><text>Axis</text><text>Scale</text><script/></svg><p>After the picture.</p>"
        "<object data='f'><p>Fallback of the object.</p></object><noscript><p>Without scripts.</p></noscript><template><p>never</p></template>"
        "<canvas>Drawn words</canvas><script>var a = '<p>no</p>'</script><style>p {}</style><p>Last.</p></article>"
    )
    assert [b.text for b in hx.leaf_blocks(page)] == [
        "One two.",
        "Here x=2 holds.",
        "Empty formula.",
        "Axis Scale",
        "After the picture.",
        "Fallback of the object.",
        "Without scripts.",
        "Drawn words",
        "Last.",
    ]


INSIDE = [
    '<article><h1>T</h1><p>The first paragraph of the page.</p><p>Another one that ends it.</p><div class="comments"><p>Nice post, I think.</p><p>Me too!</p></div></article>',
    '<main><h1>T</h1><p>The first paragraph of the page.</p><p>Another one that ends it.</p><section id="comments"><p>Nice post, I think.</p><p>Me too!</p></section></main>',
    '<article><h1>T</h1><div class="advert"><p>Buy one, get one free.</p></div><p>The first paragraph of the page.</p><div class="share-bar"><a href="/s">Share</a></div><p>Another one that ends it.</p></article>',
    '<div class="content"><h1>T</h1><p>The first paragraph of the page.</p><p>Another one that ends it.</p><ol class="comments"><li>I was there, and it was not like this at all.</li><li>So was I.</li></ol></div>',
]


@pytest.fixture(scope="module")
def fitted(spark):
    """Fitted as the query does it: written layouts and pages of the table, all of which look alike."""
    return hx.fit_extractor(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


@pytest.mark.parametrize("page", INSIDE)
def test_comments_and_adverts_inside_the_article(fitted, page):
    assert text_of(fitted, page) == "T\nThe first paragraph of the page.\nAnother one that ends it."


def test_very_long_page(model):
    paragraphs = [f"This is paragraph number {i} of a very long article about nothing." for i in range(20_000)]
    page = PAGE.replace("<article>", "<article>" + "".join(f"<p>{p}</p>" for p in paragraphs))
    assert text_of(model, page).split("\n")[:20_000] == paragraphs
    one_block = "<article><p>" + "word " * 400_000 + "</p></article>"
    assert len(text_of(model, one_block)) == 1_999_999
