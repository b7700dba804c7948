"""Every measure and verdict of the quality rules against a plain version."""

import random

import pytest
from tests.conftest import MEDIUM
from tests.llm import plain
from txnrisk.llm import quality
from txnrisk.llm.registry import op9_quality_rules


def plain_measures(text):
    text = text or ""
    words = plain.words(text)
    n, n_chars, n_symbols, n_dup_lines, n_repeat = plain.quality(text)
    most = max(n_chars, 1)
    found = {"n_words": n, "word_chars": n_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat}
    for size in quality.MAX_WINDOW_SHARE:
        grams = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
        first, again = set(), set()
        for g in grams:
            (again if g in first else first).add(g)
        inside = {j for i, g in enumerate(grams) if g in again for j in range(i, i + size)}
        found[f"share_{size}"] = sum(len(words[j]) for j in inside) / most
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if plain.words(line):
            repeated += sum(map(len, plain.words(line))) if line in seen else 0
            seen.add(line)
    found["line_share"] = repeated / most
    found["symbol_share"] = n_symbols / most
    failed = n < 10 or 100 * n_repeat > 20 * n
    found["base_failed"] = failed
    bad = failed or found["line_share"] > quality.MAX_LINE_SHARE or found["symbol_share"] > quality.MAX_SYMBOL_SHARE
    found["kept"] = not (bad or any(found[f"share_{s}"] > m for s, m in quality.MAX_WINDOW_SHARE.items()))
    return found


def check(rows, found):
    texts = dict(rows)
    assert len(found) == len(rows)
    for row in found:
        for name, value in plain_measures(texts[row.doc_id]).items():
            assert row[name] == pytest.approx(value, abs=1e-12), (row.doc_id, name)


def test_given_documents(spark, medium):
    check([(r.doc_id, r.text) for r in medium.collect()], op9_quality_rules(spark, MEDIUM).collect())


def test_made_and_odd_documents(spark, odd_rows):
    rnd = random.Random(6)
    rows = list(odd_rows)
    for i in range(400):
        words = [rnd.choice(["a", "bé", "漢字", "#x", "ccc", "d*", str(rnd.randrange(40))]) for _ in range(rnd.randrange(120))]
        for _ in range(rnd.randrange(4)):
            words += words[: rnd.randrange(1, 30)]
        text = "".join(w + rnd.choice([" ", " ", " ", "\n", "  ", "\t", "\n\n", "\r\n"]) for w in words)
        rows.append((1000 + i, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(rows, quality.quality_measures(docs).collect())
