import re
import string
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from txnrisk.llm import divergence
from txnrisk.llm.divergence import Terms, audit, kept_terms

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def terms_of(text):
    return [t.translate(LOWER) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def plain(docs, least=10, top=10):
    """The audit of (text, lang, source) rows, term by term."""
    having, counts = defaultdict(Counter), defaultdict(Counter)
    groups = {(lang or "", source or "") for _, lang, source in docs}
    for text, lang, source in docs:
        found = terms_of(text)
        having[lang or ""].update(set(found))
        counts[lang or "", source or ""].update(found)
    rows = []
    for lang in {g[0] for g in groups}:
        kept = {t for t, n in having[lang].items() if n >= least}
        sources = sorted(g[1] for g in groups if g[0] == lang)

        def shares(counter):
            total = sum(counter[t] for t in kept)
            return {t: 1 + 10**9 * (counter[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = [(o, sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, (p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, None), ("term", term, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                rows += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(rows)


def audited(frame, **options):
    columns = ("lang", "source", "part", "item", "value", "rank")
    return sorted(tuple(row) for row in audit(frame, **options).select(*columns).collect())


@pytest.mark.parametrize("small_blocks", [False, True])
def test_against_term_by_term(medium, monkeypatch, small_blocks):
    if small_blocks:
        monkeypatch.setattr(divergence, "BLOCK_SOURCES", 6)
        monkeypatch.setattr(divergence, "SHARD_TERMS", 50)
        monkeypatch.setattr(divergence, "COMBINED_ROWS", 1000)
    docs = [(row.text, row.lang, row.source) for row in medium.collect()]
    assert audited(medium) == plain(docs)


def edge_rows():
    long = "é" * 700  # cut at 4, 8, 16 and more bytes, in the middle of a character too
    rows = []
    for i in range(12):
        rows.append((f"word WORD Wörd {long}x {long}{'y' * (i % 2)} abcd abcde abcdefgh{'i' * (i % 3)}", "de", f"s{i % 3}"))
    rows += [("nine " + "word", "de", "s0")] * 9 + [("ten", "de", None)] * 10 + [("eleven1eleven2ten", None, "s1")] * 11
    rows += [(None, "xx", "a"), ("", "xx", "b"), ("12 34", "xx", None), (None, None, None), ("[`{\x7f@", "de", "none")]
    rows += [("tie tie", "tt", s) for s in ("a", "b", "c", "Z", "é") for _ in range(4)]
    return rows


def test_edges(spark):
    rows = edge_rows()
    schema = "text string, lang string, source string"
    assert audited(spark.createDataFrame(rows, schema).repartition(3)) == plain(rows)
    assert audited(spark.createDataFrame(rows, schema), least=1, top=2) == plain(rows, 1, 2)


def test_odd_texts_other_columns_and_empty_table(odd, odd_rows):
    rows = [(text, "en", "src1") for _, text in odd_rows] + [("no id here at all", None, None)] * 2
    assert audited(odd, least=2) == plain(rows, 2)
    assert audited(odd.limit(0)) == []


def test_a_level_goes_on_from_kept_prefixes(spark):
    """What begins with a prefix that was rare the level before is not counted."""
    docs = spark.createDataFrame([("de", "commonword rareword")] * 9 + [("de", "commonness")] * 9, "lang string, body string")
    first = divergence._level(docs, 4, None, 10)
    assert [(row.lang, bytes(row.prefix), row.complete) for row in first.collect()] == [("de", b"comm", False)]
    bitmap = spark.sparkContext.broadcast(divergence._bitmap(first))
    second = divergence._level(docs, 8, bitmap, 1)
    assert {bytes(row.prefix) for row in second.collect()} == {b"commonwo", b"commonne"}
    assert kept_terms(docs, 10).collect() == []
    assert {bytes(row.term) for row in kept_terms(docs, 9).collect()} == {b"commonword", b"commonness", b"rareword"}


def test_terms_of_a_batch():
    texts = ["Ab cD", None, "", "x", "x1y", "1", "éa", "ß!", "end"]
    terms = Terms(pa.array(texts, pa.string()))
    values = terms.prefixes(divergence.np.arange(len(terms.sizes)), None).to_pylist()
    found = [(int(d), v.decode()) for d, v in zip(terms.doc, values)]
    assert found == [(i, t) for i, text in enumerate(texts) for t in terms_of(text)]
