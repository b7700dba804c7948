"""Whole articles come out, whatever their blocks look like, and nothing else does."""

import random
from html import escape

import pytest
from tests.conftest import MEDIUM

from txnrisk.llm import html
from txnrisk.llm.html import main_text

LONG = "the cat sat on the mat and it was the best of all the mats in the house that day"


@pytest.mark.parametrize(
    "page, text",
    [
        (
            "<article><h1>Title</h1><p>Short one.</p><ul><li><a>Only link</a></li></ul><p>Bye.</p></article>",
            "Title\n\nShort one.\n\nOnly link\n\nBye.",
        ),
        (f"<article><p>{LONG}</p><ul><li><a>x</a><li><a>y</a></ul><p>Bye.</p></article>", f"{LONG}\n\nx\n\ny\n\nBye."),
        ("<article><p title=it's>One two.</p><p>Three.</p><p class='>'>Four.</p></article>", "One two.\n\nThree.\n\nFour."),
        ("<article><p data-x = \"a > b\" y=>One.</p><p z=\"open>Two.</p></article>", "One.\n\nTwo."),
        (f"<article><div class=ad>x</div><p>Short.</p><div class=ad>y</div><p>{LONG}</p></article>", f"Short.\n\n{LONG}"),
        (f"<article><p>{LONG}</p><ul><li><a>a</a><li><a>b</a><li><a>c</a></ul><p>End.</p></article>", f"{LONG}\n\nEnd."),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


BOILER = """user-comments comment-thread reader-comments ad-container advert-wrapper adbox ad ads post-comments comments_list
cookie-banner site-menu nav-top breadcrumb-trail newsletter-signup article-sidebar sponsored-links footer-links commentlist""".split()
HARMLESS = """content-sidebar-wrap has-sidebar share-price address lead intro no-comments with-ads market-share-chart header-image
comment-body-text first-paragraph news adder menuhin""".split()


@pytest.mark.parametrize("name", BOILER)
@pytest.mark.parametrize("kind", ["class", "id"])
def test_named_containers_go(name, kind):
    page = f'<article><p>{LONG}</p><div {kind}="{name}"><p>{LONG}</p><p>Short.</p></div><p>End.</p></article>'
    assert main_text(page) == f"{LONG}\n\nEnd."


@pytest.mark.parametrize("name", HARMLESS)
def test_other_names_stay(name):
    page = f'<article><p>{LONG}</p><div class="{name}"><p>Short.</p></div><p>End.</p></article>'
    assert main_text(page) == f"{LONG}\n\nShort.\n\nEnd."


def made_page(rnd):
    """A page and its main text: the generator knows which blocks are the article's."""
    words = LONG.split() + ["äöü", "<b>", "&", "\"q\"", "it's", "a=b", "汉字", "1 > 2"]

    def prose(least, most):
        return " ".join(rnd.choice(words) for _ in range(rnd.randrange(least, most)))

    def junk():
        body = "".join(f"<p>{escape(prose(1, 40))}</p>" for _ in range(rnd.randrange(1, 4)))
        links = "".join(f'<li><a href="/{i}">{escape(prose(1, 3))}</a></li>' for i in range(rnd.randrange(3, 6)))
        return rnd.choice(
            [
                f"<nav><ul>{links}</ul></nav>",
                f"<footer>{body}</footer>",
                f"<aside>{body}</aside>",
                f'<div class="{rnd.choice(BOILER)}">{body}</div>',
                f"<section id='{rnd.choice(BOILER)}'><div>{body}</div></section>",
                f"<form action='/s'>{body}<input></form>",
                "<script>var x = '<p>no</p>';</script><style>p{}</style><!-- <p>no</p> -->",
                f"<header>{body}</header>",
                f"<div hidden>{body}</div>",
            ]
        )

    parts, text = [], []
    for _ in range(rnd.randrange(1, 9)):
        words_here = prose(1, 60)
        tag = rnd.choice(["p", "p", "p", "h2", "blockquote", "div", "pre", "li", "td"])
        marks = rnd.choice(["", ' class="lead"', " title=it's", ' data-a="x > y"', f" class='{rnd.choice(HARMLESS)}'"])
        inner = escape(words_here).replace(" mat ", " <b>mat</b>\n ").replace(" day", ' <a href="/d">day</a>')
        parts.append(f"<{tag}{marks}>{inner}</{tag}>")
        text.append(" ".join(words_here.split()))
        if rnd.random() < 0.4:
            inside = junk()
            parts.append("" if "<header>" in inside else inside)
    around = [junk() for _ in range(rnd.randrange(4))]
    page = "".join(around) + f"<{rnd.choice(['article', 'main'])}>" + "".join(parts)
    page += ("</article>" if "<article>" in page else "</main>") + "".join(junk() for _ in range(rnd.randrange(3)))
    return f"<!DOCTYPE html><html><head><title>t</title></head><body>{page}</body></html>", "\n\n".join(text)


@pytest.mark.parametrize("seed", range(5))
def test_made_pages(seed):
    rnd = random.Random(seed)
    for _ in range(200):
        page, text = made_page(rnd)
        assert main_text(page) == text, page


def test_given_pages_give_their_article(spark):
    """The given pages have one article each, of headings and paragraphs: its text is all that comes out."""
    import re

    pages = spark.read.parquet(f"{MEDIUM}/pages.parquet")
    found = {r.page_id: r.text for r in html.extract_text(pages.select("page_id", "html")).collect()}
    for row in pages.select("page_id", "html").collect():
        article = re.search(r"<article>(.*)</article>", row.html, re.S).group(1)
        inside = re.sub(r"<!--.*?-->|<(script|style|nav|aside|form)\b.*?</\1>|<div class=\"[a-z -]*\">.*?</div>", " ", article, flags=re.S)
        blocks = re.split(r"</?(?:p|h[1-6]|li|ul|ol|div|table|tr|td|th|blockquote|section)\b[^>]*>", inside)
        texts = [" ".join(html.html.unescape(re.sub(r"<br\s*/?>", " ", b) if "<" in b else b) .split()) for b in blocks]
        texts = [re.sub(r"</?[a-z]+\b[^>]*>", "", t) for t in texts]
        assert found[row.page_id].split() == " ".join(texts).split(), row.page_id


def test_clashing_column_is_replaced(spark):
    pages = spark.createDataFrame([(1, f"<p>{LONG}</p>", "old", "x")], "page_id long, html string, text string, body string")
    row = html.extract_text(pages).first()
    assert (row.text, row.body) == (LONG, "x")
