"""Rules are mined where labels carry a signal, at any size, and not where they carry none."""

import math
import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F
from tests.conftest import MEDIUM
from txnrisk.llm import urls

SCHEMA = "tokens array<string>, blocked boolean"


@pytest.mark.parametrize("size", [80, 4000])
def test_signal_below_the_old_thresholds(spark, size):
    """Twelve pages of one host, half as rare as 0.5 % of the larger table; 0.5 of another host's are blocked."""
    rows = [(["h:spam", "h:com", f"p:w{i % 5}"], True) for i in range(12)]
    rows += [(["h:half", "h:com", f"p:w{i % 5}"], i % 2 == 0) for i in range(size)]
    rows += [(["h:good", "h:com", f"p:w{i % 5}"], i % 10 == 0) for i in range(size * 3)]
    mined = {tuple(r.rule_tokens) for r in urls.mine_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert ("h:spam",) in mined
    assert not any("h:good" in rule for rule in mined)
    assert size < 4000 or ("h:half",) in mined


def test_no_rules_from_random_labels(spark):
    rnd = random.Random(2)
    rows = [([f"h:{rnd.randrange(20)}", f"p:{rnd.randrange(20)}", f"p:x{rnd.randrange(5)}"], rnd.random() < 0.25) for _ in range(2000)]
    assert urls.mine_rules(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_given_pages(spark):
    """The given labels say nothing about hosts; labels that do are found on the same pages."""
    pages = spark.read.parquet(f"{MEDIUM}/pages.parquet")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    labelled = urls.labelled_by_document(pages, labels)
    assert urls.mine_rules(labelled).count() == 0
    told = pages.select(urls.tokens_of(urls.host_of(F.col("url")), urls.path_of(F.col("url"))).alias("tokens"))
    told = told.withColumn("blocked", F.array_contains("tokens", "h:www"))
    verdicts = urls.judge(pages, urls.mine_rules(told)).filter("rule IS NULL").groupBy("verdict").count().collect()
    assert {r.verdict for r in verdicts} == {"block", "allow"}


def test_rule_in_the_tail_of_a_long_url(spark):
    deep = [f"p:d{i}" for i in range(30)]
    rows = [(["h:site", *deep, "p:bad"], True) for _ in range(20)] + [(["h:site", *deep, "p:fine", f"p:x{i}"], False) for i in range(60)]
    mined = urls.mine_rules(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.rule_tokens for r in mined] == [["p:bad"]]


def plain_rules(rows, min_rows=5, min_lift=1.5, max_chance=0.05):
    """Rules by counting every combination of the tokens of every basket."""
    total, base = len(rows), sum(b for _, b in rows) / len(rows)
    has = {}
    for i, (tokens, _) in enumerate(rows):
        for token in tokens:
            has.setdefault(token, set()).add(i)
    first = {}
    for token in sorted(has):
        if min_rows <= len(has[token]) < total:
            first.setdefault(frozenset(has[token]), token)
    kept = set(first.values())
    counts, blocked = Counter(), Counter()
    for tokens, label in rows:
        found = sorted(kept & set(tokens))
        for size in range(1, len(found) + 1):
            for c in combinations(found, size):
                counts[c] += 1
                blocked[c] += label
    counts = {c: n for c, n in counts.items() if n >= min_rows}
    rules = {}
    for c, n in counts.items():
        share = blocked[c] / n
        if blocked[c] < min_rows or share < min(base * min_lift, 1 - (1 - base) / min_lift):
            continue
        evidence = n * (share * math.log(share / base) + ((1 - share) * math.log((1 - share) / (1 - base)) if share < 1 else 0))
        if evidence >= math.log(len(counts) / max_chance):
            rules[c] = share
    return {c: s for c, s in rules.items() if not any(set(p) < set(c) and rules[p] >= s for p in rules)}


@pytest.mark.parametrize("seed", range(4))
def test_against_plain_enumeration(spark, seed):
    """Baskets in which blocked ones share combinations of up to five tokens, and some tokens always come together."""
    rnd = random.Random(seed)
    bad = [tuple(rnd.sample(range(12), size)) for size in (1, 3, 4, 5)]
    rows = []
    for _ in range(500):
        tokens = {f"p:{i}" for i in range(12) if rnd.random() < 0.35} | {"h:all"}
        hit = any(all(f"p:{i}" in tokens for i in c) for c in bad[1:])
        tokens |= {"p:twin"} if "p:3" in tokens else set()
        tokens |= {f"p:rare{rnd.randrange(300)}"}
        rows.append((sorted(tokens), rnd.random() < (0.95 if hit else 0.08)))
    found = urls.mine_rules(spark.createDataFrame(rows, SCHEMA)).collect()
    expected = plain_rules(rows)
    assert {tuple(r.rule_tokens): r.confidence for r in found} == pytest.approx(expected)
    assert max(map(len, expected)) > 3 or seed
    assert all(r.index_token in r.rule_tokens for r in found)


def test_plan_is_native_and_labels_may_be_missing(spark):
    rows = [(["h:bad"], True)] * 30 + [(["h:good"], False)] * 90 + [(None, True), (["h:x", None], None), ([], False)]
    mined = urls.mine_rules(spark.createDataFrame(rows, SCHEMA))
    assert [r.rule_tokens for r in mined.collect()] == [["h:bad"]]
    text = mined._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
