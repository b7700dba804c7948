import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import plain
from txnrisk.llm import jaccard
from txnrisk.llm.components import connected
from txnrisk.llm.jaccard import Likeness, keep_one_of_each, link_components


@pytest.mark.parametrize("words, above", [(4, 85), (5, 80)])
@pytest.mark.parametrize("nodes", [2048, 40])
def test_components_against_all_pairs(spark, edited, odd_rows, monkeypatch, words, above, nodes):
    """Also with clusters far larger than a group."""
    monkeypatch.setattr(jaccard, "GROUP_NODES", nodes)
    rows = edited + [(50_000 + i, text) for i, text in odd_rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = link_components(docs, Likeness(words, above, 100)).collect()
    assert len(found) == len(rows)
    want = plain.components(rows, words, above, 100)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want


def test_one_of_each_stays(spark, edited):
    docs = spark.createDataFrame(edited, "doc_id long, text string")
    want = plain.components(edited, 5, 80, 100)
    kept = {r.doc_id for r in keep_one_of_each(docs, Likeness()).collect()}
    assert kept == {component for _, component in want.values()}


def test_odd_tables(spark, odd):
    like = Likeness()
    assert keep_one_of_each(odd, like).columns == odd.columns
    assert link_components(odd.limit(0), like).count() == 0
    rows = link_components(odd, like).collect()
    assert len(rows) == odd.count()
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert [found[i] for i in range(6)] == [(0, 0), (0, 1), (0, 2), (1, 3), (1, 3), (1, 5)]
    assert found[11] == found[12] == (1, 5)
    assert found[None] == (1, None)
    assert keep_one_of_each(odd, like).filter("doc_id IS NULL").count() == 2


def test_a_chain_is_one_component(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (5, 5)], "u long, v long")
    found = {r.node: r.root for r in connected(edges.repartition(5)).collect()}
    assert found == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}


sizes = st.integers(1, 400)


@given(x=sizes, y=sizes, shared=st.integers(0, 400), above=st.sampled_from([80, 85]))
@settings(max_examples=300, deadline=None)
def test_bounds_hold(x, y, shared, above):
    like = Likeness(5, above, 100)
    shared = min(shared, x, y)
    linked = 100 * shared >= above * (x + y - shared)
    assert linked == (shared >= like.overlap(x + y))
    if linked:
        assert x + y - 2 * shared <= like.difference(x + y)
        assert max(x, y) <= like.largest(min(x, y))


@given(n=st.integers(2, 150), changes=st.integers(0, 30), seed=st.integers(0, 10**6), above=st.sampled_from([80, 85]))
@settings(max_examples=200, deadline=None)
def test_linked_sets_share_a_part(n, changes, seed, above):
    like = Likeness(5, above, 100)
    rnd = np.random.default_rng(seed)
    x = np.unique(rnd.integers(0, 2**63, n, dtype=np.uint64))
    y = np.unique(np.concatenate((x[min(changes, n - 1) :], rnd.integers(0, 2**63, rnd.integers(0, changes + 1), dtype=np.uint64))))
    shared = len(np.intersect1d(x, y))
    if np.array_equal(x, y) or shared < like.overlap(len(x) + len(y)):
        return
    keys, owners = jaccard.part_keys([x, y], np.array([1, 2], np.uint64), like)
    assert set(keys[owners == 1]) & set(keys[owners == 2])
