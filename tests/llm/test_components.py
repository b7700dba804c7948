import random

import numpy as np
import pytest

from txnrisk.llm import components
from txnrisk.llm.components import connected, least_nodes


def plain(edges):
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = sorted((top(u), top(v)))
            parent[b] = a
    return {x: top(x) for x in parent}


def graphs():
    rnd = random.Random(4)
    path = [(i, i + 1) for i in range(3000)]
    rnd.shuffle(path)
    shuffled = list(range(5000))
    rnd.shuffle(shuffled)
    yield "path", path
    yield "random path", list(zip(shuffled, shuffled[1:]))
    yield "hub", [(7, i) for i in range(5000)] + [(i, i + 1) for i in range(6000, 6100)] + [(6050, 3)]
    yield "hubs in a chain", [(10_000 * h, 10_000 * h + i) for h in range(1, 6) for i in range(900)] + [(10_000 * h + 5, 10_000 * h + 10_007) for h in range(1, 5)]
    yield "pairs", [(2 * i, 2 * i + 1) for i in range(4000)]
    yield "random", [(rnd.randrange(3000), rnd.randrange(3000)) for _ in range(2500)]
    yield "negative", [(-(2**63), 5), (5, 2**63 - 1), (0, -1)]
    yield "loops and repeats", [(1, 1), (2, 3), (3, 2), (2, 3), (4, 4)]
    yield "nothing", []


@pytest.mark.parametrize("name, edges", graphs(), ids=lambda x: x if isinstance(x, str) else "")
@pytest.mark.parametrize("small", [False, True])
def test_against_plain(spark, monkeypatch, name, edges, small):
    if small:  # many tasks on every level
        monkeypatch.setattr(components, "CHUNK_EDGES", 64)
        monkeypatch.setattr(components, "TASK_LINKS", 20)
    frame = spark.createDataFrame(edges, "u long, v long").repartition(7)
    found = connected(frame).collect()
    assert {row.node: row.root for row in found} == plain(edges)
    assert len({row.node for row in found}) == len(found)


def test_least_nodes():
    rng = np.random.default_rng(0)
    for size in (1, 5, 400):
        u, v = rng.integers(0, size, (2, size))
        nodes, roots = least_nodes(u, v)
        expected = plain(list(zip(u.tolist(), v.tolist())))
        assert {n: r for n, r in zip(nodes.tolist(), roots.tolist()) if n in expected} == expected


def test_a_hub_is_dealt_out(spark):
    """The lookup of roots never joins on a root alone."""
    edges = spark.range(2000).selectExpr("id AS u", "0L AS v").repartition(4)
    level = components._level(edges)
    plan = level._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(u#") == 1
