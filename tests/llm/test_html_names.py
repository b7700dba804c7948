"""Names of wrappers must not cost an article, and boilerplate must still go."""

import pytest

from txnrisk.llm.html import main_text

BODY = "the cat sat on the mat and it was the best of all the mats in the house that day"
ARTICLE = f"<article><p>{BODY}</p></article>"


@pytest.mark.parametrize(
    "page",
    [
        f'<div style="overflow:hidden">{ARTICLE}</div>',
        f'<div title="The hidden valley">{ARTICLE}</div>',
        f'<div data-id="sidebar">{ARTICLE}</div>',
        f'<div class="content-sidebar-wrap">{ARTICLE}</div>',
        f'<div class="wide has-sidebar">{ARTICLE}</div>',
        f'<article class="post comments-open"><p>{BODY}</p></article>',
        f'<main class="notice" id="share"><p>{BODY}</p></main>',
        f'<div class="modal"><div class="popup">{ARTICLE}</div></div>',
        f'<div style="overflow:hidden"><p>{BODY}</p></div>',
    ],
)
def test_text_stays(page):
    assert main_text(page) == BODY


@pytest.mark.parametrize(
    "around", ["hidden", 'class="comments"', "id=sidebar", 'class="main-menu"', 'aria-hidden="true"', 'role="navigation"']
)
def test_no_article_inside_these(around):
    assert main_text(f"<div {around}>{ARTICLE}</div>{ARTICLE}") == BODY


@pytest.mark.parametrize("around", ['class="ad"', 'class="x cookie-banner"', 'id="site-footer"', 'class="share-buttons"', "hidden"])
def test_boilerplate_goes(around):
    assert main_text(f"<div {around}><p>{BODY}</p></div><article><p>{BODY}!</p><div {around}>{BODY}</div></article>") == f"{BODY}!"
