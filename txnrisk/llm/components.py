"""Connected components of an undirected graph, by contraction.

Each task first finds the components of the edges it holds and keeps one edge per node, its claim, to the least node of its
local component. These claims are dealt out by node, so that all claims on a node meet; a task joins what they
connect, gives each node one root, and is left with links between roots. The links are a far smaller
graph, on which the same is done again until there are none; then the roots are looked up level by level.

A node sends at most one claim from each task, however many edges it has. Only the lookup joins on roots, and
there the children of a root are dealt to ``SALTS`` tasks, and each root that has another root to ``SALTS``
copies, so a component with a third of all nodes is spread as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.tables import discard, stored

#: Edges a task joins at a time before they are dealt out, and links of one task of a later level.
CHUNK_EDGES = 1 << 20
TASK_LINKS = 500_000
SALTS = 16

CLAIM, LINK = 0, 1


def least_nodes(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes of the edges in order, and the least node of the component of each."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            return nodes, nodes[root]
        np.minimum.at(root, high[apart], low[apart])
        while (jumped := root[root]).tobytes() != root.tobytes():
            root = jumped


def _ends(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [batch.column(name).to_numpy() for name in ("u", "v")]


def _claims(edges: DataFrame) -> DataFrame:
    """``u`` and ``v``, the least node connected to it in its task, for all nodes; a least node claims itself."""

    def rows(nodes: np.ndarray, roots: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(_ends(batch))
            size += batch.num_rows
            if size >= CHUNK_EDGES:
                found = least_nodes(*(np.concatenate(ends) for ends in zip(*held)))
                # What stays together is held on to, unless it fills the memory.
                held, size = [found], len(found[0])
                if size >= CHUNK_EDGES // 2:
                    yield rows(*found)
                    held, size = [], 0
        if held:
            yield rows(*least_nodes(*(np.concatenate(ends) for ends in zip(*held))))

    return edges.select("u", "v").where("u != v").mapInArrow(run, "u long, v long")


def _level(edges: DataFrame) -> DataFrame:
    """``kind``, ``u``, ``v``: one claim for each node, and links between the roots they connect.

    A root claims itself in every task, so the task that all claims on it meet in knows that others have it as their root, and
    links it to its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [_ends(batch) for batch in batches]
        if not held:
            return
        u, v = (np.concatenate(ends) for ends in zip(*held))
        nodes, roots = least_nodes(u, v)
        for kind, found in ((CLAIM, np.unique(u)), (LINK, np.unique(v))):
            root = roots[np.searchsorted(nodes, found)]
            others = found != root
            kinds = pa.array(np.full(int(others.sum()), kind, np.int32))
            yield pa.RecordBatch.from_arrays([kinds, pa.array(found[others]), pa.array(root[others])], ["kind", "u", "v"])

    return _claims(edges).repartition("u").mapInArrow(run, "kind int, u long, v long")


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for all nodes of ``edges`` (``u``, ``v``).

    Each level is stored, so lineage stays short; all but the last result are deleted. Edges may repeat, point either
    way or join a node to itself; nodes that only have an edge to themselves are left out.
    """
    levels = []
    while True:
        level = stored(_level(edges), "component-level")
        levels.append(level)
        links = level.filter(F.col("kind") == LINK).select("u", "v")
        count = links.count()
        if not count:
            break
        edges = links.coalesce(max(1, -(-count // TASK_LINKS)))
    roots = None
    for level in reversed(levels):
        claims = level.filter(F.col("kind") == CLAIM).select(F.col("u").alias("node"), F.col("v").alias("root"))
        if roots is not None:
            # Roots that have another root, for each of the tasks that the children of a root are dealt to.
            further = roots.select(
                F.col("node").alias("root"), F.col("root").alias("further"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
            )
            salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")
            mapped = claims.withColumn("salt", salt).join(further, ["root", "salt"], "left")
            mapped = mapped.select("node", F.coalesce("further", "root").alias("root"))
            # A root that is a child of nothing is known by its link alone.
            claims = mapped.unionByName(roots.join(claims, "node", "left_anti"))
        roots = claims
    own = roots.groupBy("root").agg(F.lit(1).alias("one")).select(F.col("root").alias("node"), "root")
    found = stored(roots.unionByName(own), "components")
    for level in levels:
        discard(level)
    return found
