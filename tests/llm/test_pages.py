"""URL filters and HTML extraction against plain rules."""

import re

from tests.conftest import MEDIUM
from txnrisk.llm import html, urls

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block")]
RULES += [("com", "/fr/", "allow"), ("com", "/de/", "block")]
ODD_URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/en/12?q=/es/", "x://com/de/#a", "x://notexample.org/es/1"]


def plain_rule(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best and best[2]


def test_explicit_rules(spark):
    pages = spark.read.parquet(f"{MEDIUM}/pages.parquet").select("page_id", "url")
    odd = spark.createDataFrame([(10**6 + i, u) for i, u in enumerate(ODD_URLS)], pages.schema)
    pages = pages.union(odd).union(odd)
    mined = urls.mine_rules(spark.createDataFrame([], "tokens array<string>, blocked boolean"))
    url = {row.page_id: row.url for row in pages.collect()}
    rows = urls.judge(pages, mined).collect()
    assert len(rows) == pages.count()
    for row in rows:
        host, path, rule, verdict = plain_rule(url[row.page_id])
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == (verdict or "allow")


def test_mined_rules_block(spark):
    rows = [(["h:bad", "p:ads", f"p:w{i % 7}"], True) for i in range(60)]
    rows += [(["h:good", "p:ads", f"p:w{i % 7}"], False) for i in range(140)]
    mined = urls.mine_rules(spark.createDataFrame(rows, "tokens array<string>, blocked boolean"))
    assert [r.rule_tokens for r in mined.collect()] == [["h:bad"]]
    pages = spark.createDataFrame([(1, "x://bad/ads"), (2, "x://good/ads"), (None, None)], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urls.judge(pages, mined).collect()} == {1: "block", 2: "allow", None: "allow"}
    assert urls.judge(pages.limit(0), mined).count() == 0


def test_main_text(spark):
    body = "the cat sat on the mat and it was the best of all the mats in the house that day"
    page = f"<nav>menu</nav><article><h1>Tom &amp; Co</h1><p>{body}</p><p>so \n it  is</p></article><footer>end</footer>"
    rows = [(1, page), (2, None), (3, ""), (4, "<p"), (5, f"<div>{body} " * 20_000), (1, page)]
    found = html.extract_text(spark.createDataFrame(rows, "page_id long, html string")).collect()
    texts = [row.text for row in sorted(found, key=lambda r: r.page_id)]
    assert texts[:2] == [f"Tom & Co\n\n{body}\n\nso it is"] * 2
    assert texts[2:5] == ["", "", ""]
    assert len(texts[5]) >= 20_000 * len(body)
