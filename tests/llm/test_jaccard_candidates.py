"""What makes two documents candidates of the Jaccard join: several equal parts, not one by chance."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import plain
from txnrisk.llm import jaccard
from txnrisk.llm.components import connected
from txnrisk.llm.jaccard import Likeness, link_components


@pytest.mark.parametrize("words, above, common", [(4, 85, 40), (5, 80, 30)])
def test_documents_that_share_a_passage_are_no_cluster(spark, words, above, common):
    """A quarter or a third of the words of each document, so some have an equal part or two by chance."""
    rnd = random.Random(3)

    def some(count):
        return [f"w{rnd.randrange(10**9)}" for _ in range(count)]

    passage = some(common)
    texts = [" ".join(passage + some(90)) for _ in range(300)]
    copies = [text + " end" for text in texts[:20]]
    docs = spark.createDataFrame(list(enumerate(texts + copies)), "doc_id long, text string").repartition(5)
    like = Likeness(words, above, 100)
    clusters = connected(jaccard._candidates(docs, "text", like)).groupBy("root").count()
    assert clusters.agg(F.max("count")).first()[0] < 30
    found = {r.doc_id: r.component_id for r in link_components(docs, like).collect()}
    assert found == {i: i - 300 if i >= 300 else i for i in range(320)}


@given(n=st.integers(2, 150), changes=st.integers(0, 30), seed=st.integers(0, 10**6), above=st.sampled_from([80, 85]))
@settings(max_examples=200, deadline=None)
def test_linked_sets_share_the_needed_keys(n, changes, seed, above):
    like = Likeness(5, above, 100)
    rnd = np.random.default_rng(seed)
    x = np.unique(rnd.integers(0, 2**63, n, dtype=np.uint64))
    y = np.unique(np.concatenate((x[min(changes, n - 1) :], rnd.integers(0, 2**63, rnd.integers(0, changes + 1), dtype=np.uint64))))
    if np.array_equal(x, y) or len(np.intersect1d(x, y)) < like.overlap(len(x) + len(y)):
        return
    keys, owners = jaccard.part_keys([x, y], np.array([1, 2], np.uint64), like)
    shared = Counter(int(key) & 15 for key in set(keys[owners == 1]) & set(keys[owners == 2]))
    assert shared and any(count >= need for need, count in shared.items())


@pytest.mark.parametrize("held", [1, 50, 10**6])
@pytest.mark.parametrize("batch", [1, 7, 1000])
def test_shared_keys_against_counting(monkeypatch, held, batch):
    monkeypatch.setattr(jaccard, "HELD_KEYS", held)
    monkeypatch.setattr(jaccard, "PAIRED_NODES", 4)
    rnd = random.Random(held + batch)
    rows = sorted((rnd.randrange(-40, 40) * 16 + 2, rnd.randrange(-9, 9)) for _ in range(200))
    rows += [(5000 * 16 + 2, i % 90) for i in range(300)] + [(6000 * 16 + 2, 7)] * 20
    nodes = defaultdict(set)
    for key, node in rows:
        nodes[key].add(node)
    want = Counter()
    for key, found in nodes.items():
        if len(found) > 4:
            want.update((jaccard.CROWD, key, node) for node in found)
        else:
            want.update((jaccard.PAIR, *pair) for pair in combinations(sorted(found), 2))
    parts = [rows[i : i + batch] for i in range(0, len(rows), batch)]
    batches = [pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*part)], ["key", "node"]) for part in parts]
    out = [row for b in jaccard._shared_keys(iter(batches)) for row in b.to_pylist()]
    assert all(row["need"] == 2 for row in out)
    found = Counter((row["kind"], row["u"], row["v"]) for row in out)
    pairs = {row: n for row, n in found.items() if row[0] == jaccard.PAIR}
    assert pairs == {row: n for row, n in want.items() if row[0] == jaccard.PAIR}
    assert {row for row in found if row[0] == jaccard.CROWD} == {row for row in want if row[0] == jaccard.CROWD}


@pytest.mark.parametrize("paired", [1, 3])
def test_crowds_against_all_pairs(spark, edited, monkeypatch, paired):
    """Also where nearly every shared key is one of many nodes."""
    monkeypatch.setattr(jaccard, "PAIRED_NODES", paired)
    docs = spark.createDataFrame(edited, "doc_id long, text string").repartition(7)
    found = link_components(docs, Likeness(5, 80, 100)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == plain.components(edited, 5, 80, 100)


def test_the_pipeline_stage_compares_few_of_them(spark, monkeypatch):
    """Documents that share a passage are not sent to be compared block by block, each with all others."""
    rnd = random.Random(4)
    words = [f"w{rnd.randrange(10**9)}" for _ in range(30)]
    texts = [" ".join(words + [f"w{rnd.randrange(10**9)}" for _ in range(90)]) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate([*texts, texts[0] + " end"])), "doc_id long, text string").repartition(5)
    sent, joined = [], jaccard._joined

    def counted(rows, like):
        sent.append(rows.count())
        return joined(rows, like)

    monkeypatch.setattr(jaccard, "_joined", counted)
    monkeypatch.setattr(jaccard, "GROUP_NODES", 16)
    kept = {r.doc_id for r in corpus_pipeline.jaccard_join(spark, docs, "").collect()}
    assert kept == set(range(300))
    assert sum(sent) < 301
