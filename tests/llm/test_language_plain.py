"""Language identification against a naive Bayes classifier in plain Python."""

import math
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from tests.conftest import SMALL
from tests.llm.conftest import ODD
from txnrisk.llm import language
from txnrisk.llm.registry import op4_language_id

MASK = (1 << 64) - 1


def plain_grams(text):
    """Hash buckets of all n-grams of 1 to 4 characters."""
    text = (text or "").lower()
    if not any(c.isalpha() for c in text):
        return Counter()
    read = " "
    for c in text:
        if c.isalpha():
            read += c
        elif read[-1] != " ":
            read += " "
    found = Counter()
    for order in (1, 2, 3, 4):
        for i in range(len(read) - order + 1):
            value = 0
            for c in read[i : i + order]:
                value = (value * 0x100000001B3 + ord(c)) & MASK
            found[((value + order) * 0x9E3779B97F4A7C15 & MASK) >> 48] += 1
    return found


def plain_model(rows):
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        counts[lang] += plain_grams(text)
        sizes[lang] += 1
    model = {}
    for lang in sizes:
        total = sum(counts[lang].values()) + 0.1 * (1 << 16)
        model[lang] = (math.log(sizes[lang] / sum(sizes.values())), counts[lang], total)
    return model


def plain_predict(text, model):
    found = plain_grams(text)
    if not found:
        return "und", 0.0
    scores = {
        lang: prior + sum(n * math.log((counts[b] + 0.1) / total) for b, n in found.items())
        for lang, (prior, counts, total) in model.items()
    }
    best = max(sorted(scores), key=scores.get)
    return best, 1 / sum(math.exp(min(700, s - scores[best])) for s in scores.values())


def test_query_against_plain_bayes(spark, small):
    rows = small.select("doc_id", "text", "lang").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows}
    model = plain_model([(r.text, r.lang) for r in rows if r.lang is not None and not held[r.doc_id]])
    found = {r.doc_id: r for r in op4_language_id(spark, SMALL).collect()}
    assert len(found) == len(rows)
    for r in rows:
        lang, score = plain_predict(r.text, model)
        assert found[r.doc_id].held_out == held[r.doc_id]
        assert found[r.doc_id].lang_pred == lang
        assert found[r.doc_id].score == pytest.approx(score, abs=2e-3)


@pytest.mark.parametrize("block", [1, 7, 40])
def test_long_texts_in_blocks(monkeypatch, block):
    monkeypatch.setattr(language, "LONG_BLOCK", block)
    texts = [t[:3000] for t in ODD if t] + ["a  b\n\nc1d ", "  x", "x", "1 2 3", "ΣΑΣ Σ İI ß éé 漢字 \U0001f600 a", "wo rd" * 9 + " "]
    for text in texts:
        found = Counter()
        for bucket in language.long_grams(text.encode()):
            found.update(bucket.tolist())
        assert found == plain_grams(text), text[:50]
        buckets, _, has_letter = language.grams(pa.array([text]))
        assert found == Counter(buckets.tolist())
        assert bool(found) == bool(has_letter[0])


def test_scores_of_long_texts(spark, small, monkeypatch):
    rows = [(r.doc_id, r.text, r.lang) for r in small.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    long = spark.createDataFrame([(i, ((t or "") + " ") * 400) for i, t, _ in rows[:12]], "doc_id long, text string")
    assert max(len(r.text) for r in long.collect()) > language.LONG_BLOCK
    whole = {r.doc_id: r.lang_pred for r in language.predict(long, model).collect()}
    short = {r.doc_id: r.lang_pred for r in language.predict(docs.select("doc_id", "text"), model).collect()}
    assert whole == {i: short[i] for i in whole}


def test_memory_of_a_long_text():
    """A text of 50 MB is read within 600 MB."""
    code = """
import resource
import numpy as np
from txnrisk.llm import language
text = b"some words of a long text " * 2_000_000
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
total = sum(len(b) for b in language.long_grams(text))
after = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
print(total, (after - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 150_000_000 and int(out[1]) < 600
