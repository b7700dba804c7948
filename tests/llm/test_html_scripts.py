"""Pages without an article: short paragraphs and other languages."""

import pytest

from txnrisk.llm.html import main_text

EN = "the cat sat on the mat and it was the best of all the mats in the house"
JA = "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。"
RU = "все счастливые семьи похожи друг на друга каждая несчастливая семья несчастлива по своему"
FI = "kaikki onnelliset perheet ovat toistensa kaltaisia jokainen onneton perhe taas omalla tavallaan vaikka aina"
NAV = '<nav><a href="/">home</a></nav>'


@pytest.mark.parametrize("text", [JA, RU, FI, "a short paragraph", EN])
@pytest.mark.parametrize("nav", ["", NAV])
def test_plain_divs(text, nav):
    assert main_text(f"{nav}<div>{text}</div><div>{text}</div>{nav}") == f"{text}\n\n{text}"


def test_other_script_beside_decided_text():
    page = f"<div>{EN}</div>{NAV}<div>{JA}</div>{NAV}<div>{RU}</div>{NAV}"
    assert main_text(page) == f"{EN}\n\n{JA}\n\n{RU}"


def test_boilerplate_alone_gives_nothing():
    assert main_text(f'{NAV}<div><a href="/">some links</a> <a href="/b">and more</a></div><footer>end</footer>') == ""
