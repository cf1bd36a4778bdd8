import random

import numpy as np
import pytest

from tablewise.llm import html_text
from tablewise.llm.html_text import main_text

PARAGRAPH = "The quick brown fox jumps over the lazy dog and then it rests for a while near the old river bank."


def page(body, title="T"):
    return f'<!DOCTYPE html><html><head><title>{title}</title><style>p{{a:b}}</style><script>var t="</p>";</script></head><body>{body}</body></html>'


FURNITURE = [
    '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li></ul></nav>',
    f'<div class="ad">{PARAGRAPH}</div>',
    f"<header><p>{PARAGRAPH}</p></header>",
    f'<div id="cookie-notice">{PARAGRAPH}</div>',
    f"<aside><h2>More</h2><p>{PARAGRAPH}</p></aside>",
    f'<div class="left sideBar">{PARAGRAPH}</div>',
    f'<form action="/s"><label>Name</label><input value="x"><select><option>One</option></select><p>{PARAGRAPH}</p></form>',
    f'<section id="comments"><h2>Comments</h2><article class="c1"><p>{PARAGRAPH}</p></article></section>',
    f'<div role="alert">{PARAGRAPH}</div>',
    f"<footer>&copy; us &middot; {PARAGRAPH}</footer>",
    f"<!-- {PARAGRAPH} --><noscript>{PARAGRAPH}</noscript><template><p>{PARAGRAPH}</p></template>",
    f"<script>document.write('<p>{PARAGRAPH}</p>')</script><style>p:after{{content:'{PARAGRAPH}'}}</style>",
]


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", '<main><article class="post">{}</article></main>', '<div class="text">{}</div>', "<div id=c><section>{}</section></div>"])
def test_articles_are_whole_and_furniture_goes(wrap):
    rng = random.Random(3)
    for _ in range(60):
        blocks = ["Heading"] + [" ".join(PARAGRAPH.split()[: rng.choice([1, 2, 5, 20])]) for _ in range(rng.randrange(3, 9))] + [PARAGRAPH]
        article = f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{b}</p>" for b in blocks[1:])
        around = [f for f in FURNITURE if rng.random() < 0.6]
        rng.shuffle(around)
        cut = rng.randrange(len(around) + 1)
        inner = rng.choice(['<div class="advert">Buy now</div>', "", "<aside>Also read this</aside>", '<ul class="share"><li>Share</li></ul>'])
        body = "".join(around[:cut]) + wrap.format(article + inner) + "".join(around[cut:])
        assert main_text(page(body)).split("\n") == blocks


def test_white_space_references_and_inline_markup():
    html = page("<article><h1> A &amp; B&nbsp;&lt;c&gt; </h1><p>one\n\t two<b>three</b> &eacute;&#233;&#xe9;<br>four &am</p><ul><li>x<li>y</ul><table><tr><td>p<td>q</table><p>&ampx <i>z</i></article>")
    assert main_text(html).split("\n") == ["A & B <c>", "one twothree ééé four &am", "x", "y", "p", "q", "&x z"]


def test_header_of_an_article_is_kept_and_wrappers_with_telling_names_too():
    text = f"<header><h1>Title</h1></header><p>{PARAGRAPH}</p><footer>by me</footer>"
    assert main_text(page(f'<div class="page-with-menu has-sidebar"><article class="no-comments">{text}</article></div>')) == f"Title\n{PARAGRAPH}"
    # an advert that is never closed does not swallow the article
    assert main_text(page(f'<div class="ad">Buy<article><p>{PARAGRAPH}</p></article>')) == PARAGRAPH


def test_heading_outside_the_block_is_taken():
    assert main_text(page(f'<div><h1>Title</h1><div class="text"><p>{PARAGRAPH}</p><p>x</p></div></div>')) == f"Title\n{PARAGRAPH}\nx"


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("   ", ""),
        ("plain words", "plain words"),
        ("a < b and b > c", "a < b and b > c"),
        ("<p>one<p>two", "one\ntwo"),
        ("</p></div><p>one</p></article>", "one"),
        ("<nav><a href=x>only</a></nav>", ""),
        ("<script>var x = 1;", ""),
        ("<article><p>text <!-- never closed", "text"),
        ("<b><i>bold</b></i> after", "bold after"),
        ("<article/><p>x</p>", "x"),
    ],
)
def test_odd_pages(html, text):
    assert main_text(html) == text


def test_deep_and_long_pages():
    assert main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    long = "word " * 400_000
    assert main_text(page(f"<article><p>{long}</p><p>&amp;{'é' * 300_000}</p></article>")) == long.strip() + "\n&" + "é" * 300_000


def test_smoothing_keeps_a_constant_and_the_pieces_do_not_matter(monkeypatch):
    assert np.allclose(html_text.smooth(np.full(7, 3.0)), 3.0) and np.allclose(html_text.smooth(np.array([2.0])), 2.0)
    html = page("".join(FURNITURE) + f"<article><h1>A &amp; B</h1><p>{PARAGRAPH}</p><p>&quot;x&quot;</p></article>")
    whole = main_text(html)
    monkeypatch.setattr(html_text, "PIECE_CHARS", 7)
    assert main_text(html) == whole == f'A & B\n{PARAGRAPH}\n"x"'


def test_rows_nulls_repeats_and_clashing_columns(spark):
    schema = "page_id long, url string, html string, text string, n_chars string, _html int"
    rows = [(1, "u", None, "t", "c", 1), (None, None, "<p>a</p>", "t", "c", 1), (1, "u", "<p>é\U0001f600</p>", None, None, None), (1, "u", "<p>é\U0001f600</p>", None, None, None)]
    df = spark.createDataFrame(rows, schema)
    got = sorted(map(tuple, html_text.extract(df).collect()), key=str)
    assert got == sorted([(1, "u", "", 0), (None, None, "a", 1), (1, "u", "é\U0001f600", 2), (1, "u", "é\U0001f600", 2)], key=str)
    assert html_text.extract(df, keep=("text", "_html")).columns == ["page_id", "text", "_html", "text", "n_chars"]
    assert html_text.extract(df.limit(0)).collect() == []
