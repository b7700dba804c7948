"""N-gram Jaccard join: all documents linked by a least resemblance of their shingle sets, exactly.

Documents with the same set are one node. Nodes that can be linked are brought together in two
steps.

1. Partition. Two sets of resemblance t differ in at most (1 - t) / (1 + t) of their joint size.
   Hashing shingles into more parts than that leaves at least one part equal in both, and sizes
   are cut into classes so that both use the same number of parts. Parts are made a little more numerous
   and put in one order for all nodes, those of many shingles first, as one with a single shingle says little. A node emits a
   key for each of its first parts, so many that two linked ones have ``need`` keys in common, not just one: a chance
   hit of one key, whose number grows with the square of the table, makes no candidates.
   Pairs are formed for keys of at most ``PAIRED_NODES`` nodes and counted. Of the keys of more nodes, only those of nodes that
   have several such keys count; there each node is a candidate with the least one. A linked pair has enough keys of the one
   kind or of the other, so the connected components of candidates are clusters that no link leaves.
2. Signature tree. The nodes of a cluster are sorted by size into a tree whose nodes hold the
   OR of token bitmaps and the range of sizes below them. A dual traversal leaves out pairs of tree nodes
   whose largest possible overlap is too small, or that lie in one component already; the
   rest is verified on the exact sets.

A cluster is worked on in groups of bounded size. One too large for a group is split by hash: each
split is joined by itself and with the first one, and whatever is not in the largest component
after that is joined with everything, block by block.

Defined results: null and empty texts have no shingle, stay alone and have their own id; a text
with fewer words than a shingle has its whole sequence as one; repeated rows are linked as copies;
null ids are never the id of a component unless all are null; extra columns are ignored. Sets are
told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm.components import connected
from txnrisk.llm.tables import bound_batches, discard, stored
from txnrisk.llm.words import BASE, STEP, document_shingles, mix, slices

CLASS_RATIO = 1.6
#: Keys that two linked nodes have in common, fewer in the classes of the smallest sets; the last bits of a key tell how many.
MOST_NEEDED = 10
NEED_BITS = 4
#: A key of more nodes than that forms no pairs.
PAIRED_NODES = 16
#: Keys of which a task holds the nodes at a time, unless one key has more.
HELD_KEYS = 1 << 17
#: So many other keys make two nodes candidates; keys of more nodes count for a node with so many of them. One of both holds for linked nodes.
PAIRED_LEAST = "least(4, (need + 1) div 2)"
CROWDED_LEAST = f"need + 1 - {PAIRED_LEAST}"
#: Kinds of what ``_shared_keys`` finds.
PAIR, CROWD = 0, 1
FILTER_BITS = 1 << 24
#: Nodes of which a task remembers that it has sent them on; it starts anew beyond this many.
REMEMBERED_NODES = 1 << 18
#: Nodes and shingles that one group of a cluster holds about.
GROUP_NODES = 2048
GROUP_SHINGLES = 4_000_000
LEAF = 32
FANOUT = 8
MAX_BITMAP = 1 << 16


@dataclass(frozen=True)
class Likeness:
    """Two sets are linked when ``below`` times their intersection is at least ``above`` times their union."""

    shingle_words: int = 5
    above: int = 80
    below: int = 100

    def difference(self, sizes):
        """How many elements two linked sets of that joint size can have in only one of them."""
        return sizes * (self.below - self.above) // (self.below + self.above)

    def largest(self, size):
        """The size of the largest set that one of ``size`` can be linked with."""
        return size * self.below // self.above

    def overlap(self, sizes):
        """The least intersection of two linked sets of that joint size."""
        return -(-sizes * self.above // (self.below + self.above))

    @property
    def slack(self) -> float:
        """Parts beyond those needed, as a share, so that weak ones can be left out."""
        return 0.15 if 100 * self.above >= 85 * self.below else 0.3


def class_ends(largest: int) -> np.ndarray:
    """The largest size of each class, up to the class of ``largest``."""
    ends = [1]
    while ends[-1] < largest:
        ends.append(max(ends[-1] + 1, int(ends[-1] * CLASS_RATIO)))
    return np.array(ends)


def set_hash(shingles: np.ndarray) -> np.uint64:
    return mix(mix(shingles ^ STEP).sum(keepdims=True) + (np.array([len(shingles)], np.uint64) * BASE))[0]


def part_keys(sets: list[np.ndarray], nodes: np.ndarray, like: Likeness) -> tuple[np.ndarray, np.ndarray]:
    """Key and node of every part to emit.

    Of two linked sets at most as many parts differ as shingles. Up to the ``need``-th part they have in common, in an order of
    all parts, each has no more than that many others, so it is among the first that each emits.
    """
    sizes = np.array([len(s) for s in sets])
    reach = like.largest(sizes)
    ends = class_ends(int(reach.max(initial=1)))
    first, last = np.searchsorted(ends, sizes), np.searchsorted(ends, reach)
    keys, owners = [], []
    for number in range(int(first.min(initial=0)), int(last.max(initial=-1)) + 1):
        end = int(ends[number])
        needed = like.difference(2 * end)
        chosen = np.flatnonzero((first <= number) & (number <= last) & (sizes > 0))
        if not needed or not len(chosen):
            continue  # only equal sets can be linked
        need = min(MOST_NEEDED, 2 + needed // 2)
        parts = needed + need + int(np.ceil(like.slack * needed))
        tokens = mix(np.concatenate([sets[i] for i in chosen]) + np.uint64((number + 1) * int(STEP) % (1 << 64)))
        row = np.repeat(np.arange(len(chosen)), sizes[chosen])
        at = row * parts + ((tokens >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        counts = np.bincount(at, minlength=len(chosen) * parts).reshape(-1, parts)
        sums = np.zeros(len(chosen) * parts, np.uint64)
        np.add.at(sums, at, mix(tokens))
        place = np.arange(parts, dtype=np.uint64) * STEP + np.uint64(number * int(BASE) % (1 << 64))
        part = mix(sums.reshape(-1, parts) + place)
        order = ((255 - np.minimum(counts, 255)).astype(np.uint64) << np.uint64(56)) | (part >> np.uint64(8))
        allowed = like.difference(sizes[chosen] + np.minimum(reach[chosen], end))
        last_one = np.sort(order, axis=1)[np.arange(len(chosen)), allowed + need - 1]
        emit = order <= last_one[:, None]
        keys.append((part[emit] >> np.uint64(NEED_BITS) << np.uint64(NEED_BITS)) | np.uint64(need))
        owners.append(np.repeat(nodes[chosen], emit.sum(axis=1)))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(keys), np.concatenate(owners)


class Forest:
    """Components of the items of one group."""

    def __init__(self, labels: np.ndarray):
        self.component = np.unique(labels, return_inverse=True)[1]
        self.links: list[tuple[int, int]] = []

    def link(self, a: int, b: int) -> None:
        if self.component[a] != self.component[b]:
            self.links.append((a, b))
            self.component[self.component == self.component[b]] = self.component[a]


class SignatureTree:
    """Sets in order of size; every tree node has the OR of their bitmaps and their range of sizes."""

    def __init__(self, sets: list[np.ndarray], like: Likeness):
        self.like = like
        self.order = np.array(sorted(range(len(sets)), key=lambda i: (len(sets[i]), int(sets[i][0]))))
        self.sets = [sets[i] for i in self.order]
        self.sizes = np.array([len(s) for s in self.sets])
        bits = min(MAX_BITMAP, 1 << max(6, int(4 * self.sizes.max()).bit_length()))
        flags = np.zeros((len(sets), bits), bool)
        for i, s in enumerate(self.sets):
            flags[i, (s & np.uint64(bits - 1)).astype(np.int64)] = True
        self.bitmaps = np.packbits(flags, axis=1).view(np.uint64)
        self.filled = np.bitwise_count(self.bitmaps).sum(axis=1, dtype=np.int64)
        #: Levels from the leaves up: first item, end, OR of bitmaps, least bits set, least and largest size.
        starts = np.arange(0, len(sets), LEAF)
        self.levels = [self._level(starts, self.bitmaps, self.filled, self.sizes, self.sizes, starts)]
        while len(self.levels[-1][0]) > 1:
            below = self.levels[-1]
            at = np.arange(0, len(below[0]), FANOUT)
            self.levels.append(self._level(at, below[2], below[3], below[4], below[5], below[0][at]))

    def _level(self, at, bitmaps, filled, low, high, first):
        end = np.append(first[1:], len(self.sets))
        return (
            first,
            end,
            np.bitwise_or.reduceat(bitmaps, at, axis=0),
            np.minimum.reduceat(filled, at),
            np.minimum.reduceat(low, at),
            np.maximum.reduceat(high, at),
        )

    def _hopeless(self, level: int, a: int, b: int) -> bool:
        """No set below ``a`` can overlap enough with one below ``b``."""
        _, _, bitmaps, filled, low, high = self.levels[level]
        if self.like.largest(high[a]) < low[b]:  # b holds the larger sets
            return True
        shared = int(np.bitwise_count(bitmaps[a] & bitmaps[b]).sum(dtype=np.int64))
        most = min(high[x] - max(0, filled[x] - shared) for x in (a, b))
        return most < self.like.overlap(low[a] + low[b])

    def join(self, forest: Forest) -> None:
        """Link all sets that are alike, as far as they are not connected by then."""
        inner = forest.component[self.order]  # a copy in tree order
        stack = [(len(self.levels) - 1, 0, 0)]
        while stack:
            level, a, b = stack.pop()
            first, end = self.levels[level][:2]
            x, y = inner[first[a] : end[a]], inner[first[b] : end[b]]
            if (x == x[0]).all() and (y == x[0]).all():
                continue
            if a != b and self._hopeless(level, a, b):
                continue
            if level == 0:
                self._join_leaves(range(first[a], end[a]), first[b], end[b], inner, forest)
                continue
            count = len(self.levels[level - 1][0])
            mine = range(a * FANOUT, min(count, (a + 1) * FANOUT))
            other = range(b * FANOUT, min(count, (b + 1) * FANOUT))
            stack += [(level - 1, i, j) for i in mine for j in other if i <= j]

    def _join_leaves(self, mine: range, start: int, end: int, inner: np.ndarray, forest: Forest) -> None:
        like = self.like
        for i in mine:
            others = np.arange(max(i + 1, start), end)
            others = others[(inner[others] != inner[i]) & (self.sizes[others] <= like.largest(self.sizes[i]))]
            if not len(others):
                continue
            least = like.overlap(self.sizes[i] + self.sizes[others])
            missing = np.bitwise_count(self.bitmaps[i] & ~self.bitmaps[others]).sum(axis=1, dtype=np.int64)
            others = others[self.sizes[i] - missing >= least]
            if not len(others):
                continue
            tokens = np.concatenate([self.sets[j] for j in others])
            place = np.minimum(np.searchsorted(self.sets[i], tokens), len(self.sets[i]) - 1)
            ends = np.cumsum(self.sizes[others])
            hits = np.concatenate(([0], np.cumsum(self.sets[i][place] == tokens)))
            shared = hits[ends] - hits[ends - self.sizes[others]]
            for j in others[shared >= like.overlap(self.sizes[i] + self.sizes[others])]:
                if inner[j] != inner[i]:
                    inner[inner == inner[j]] = inner[i]
                    forest.link(int(self.order[i]), int(self.order[j]))


def links_within(sets: list[np.ndarray], labels: np.ndarray, like: Likeness) -> list[tuple[int, int]]:
    """Links between sets of different labels that join all that are alike, and no more than needed."""
    forest = Forest(labels)
    if len(sets) > 1:
        SignatureTree(sets, like).join(forest)
    return forest.links


def _signatures(docs: DataFrame, id_col: str, text_col: str, like: Likeness) -> DataFrame:
    """``doc``, ``n_shingles`` and ``node`` of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                sets = document_shingles(part.column("body"), like.shingle_words)
                nodes = np.array([set_hash(s) for s in sets], np.uint64).astype(np.int64)
                sizes = np.array([len(s) for s in sets], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array(sizes), pa.array(nodes)], ["doc", "n_shingles", "node"]
                )

    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("body"))
    return texts.mapInArrow(run, f"doc {kind}, n_shingles long, node long")


def _distinct_sets(
    part: pa.RecordBatch, like: Likeness, sent: set[int]
) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The different non-empty sets of a batch, their nodes, and a row of each; none that is in ``sent``.

    A node with many copies is thus sent on about once by each task.
    """
    sets = document_shingles(part.column("body"), like.shingle_words)
    nodes = np.array([set_hash(s) for s in sets], np.uint64)
    _, rows = np.unique(nodes, return_index=True)
    rows = np.array([i for i in rows if len(sets[i]) and int(nodes[i]) not in sent], np.int64)
    if len(sent) > REMEMBERED_NODES:
        sent.clear()
    sent.update(nodes[rows].tolist())
    return [sets[i] for i in rows], nodes[rows], rows


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From ``key`` and ``node`` in order of the key, ``kind``, ``need``, ``u``, ``v``: the two nodes of a pair, or key and node."""

    def found(kind: int, keys: np.ndarray, u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        need = (keys & ((1 << NEED_BITS) - 1)).astype(np.int32)
        columns = [np.full(len(u), kind, np.int32), need, u, v]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["kind", "need", "u", "v"])

    def shared(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys and different nodes, both in order, of keys that several nodes have, and the number of nodes of each key."""
        again = np.zeros(len(keys) + 1, bool)
        again[1:-1] = keys[1:] == keys[:-1]
        several = again[1:] | again[:-1]
        keys, nodes = keys[several], nodes[several]
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
        keys, nodes = keys[new], nodes[new]
        _, run, size = np.unique(keys, return_inverse=True, return_counts=True)
        return keys, nodes, size[run]

    def of(keys: np.ndarray, nodes: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, nodes, size = shared(keys, nodes)
        crowd = size > PAIRED_NODES
        yield found(CROWD, keys[crowd], keys[crowd], nodes[crowd])
        keys, nodes = keys[~crowd], nodes[~crowd]
        for step in range(1, min(PAIRED_NODES, len(keys))):
            at = np.flatnonzero(keys[step:] == keys[:-step])
            if not len(at):
                break
            yield found(PAIR, keys[at], nodes[at], nodes[at + step])

    held, size = [], 0
    for batch in batches:
        held.append([batch.column(name).to_numpy() for name in ("key", "node")])
        size += batch.num_rows
        if size < HELD_KEYS:
            continue
        keys, nodes = (np.concatenate(ends) for ends in zip(*held))
        open_key = int(np.searchsorted(keys, keys[-1]))
        yield from of(keys[:open_key], nodes[:open_key])
        keys, nodes = keys[open_key:], np.unique(nodes[open_key:])
        if len(nodes) > PAIRED_NODES:
            # A crowd, whatever follows; those that stay keep it one.
            yield found(CROWD, keys[: len(nodes)], keys[: len(nodes)], nodes)
            nodes = nodes[: PAIRED_NODES + 1]
        held, size = [[keys[: len(nodes)], nodes]], len(nodes)
    if held:
        yield from of(*(np.concatenate(ends) for ends in zip(*held)))


def _candidates(docs: DataFrame, text_col: str, like: Likeness) -> DataFrame:
    """Edges ``u``, ``v`` between nodes that share enough parts; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for part in slices(batch, "body"):
                sets, nodes, _ = _distinct_sets(part, like, sent)
                keys, owners = part_keys(sets, nodes, like)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.astype(np.int64)), pa.array(owners.astype(np.int64))], ["key", "node"]
                )

    parts = docs.select(F.col(text_col).alias("body")).mapInArrow(run, "key long, node long")
    shared = parts.repartition("key").sortWithinPartitions("key").mapInArrow(_shared_keys, "kind int, need int, u long, v long")
    # A node of a crowd may come twice.
    shared = shared.groupBy("kind", "need", "u", "v").agg(F.count("*").alias("keys"))
    shared = stored(shared.filter((F.col("kind") == CROWD) | F.expr(f"keys >= {PAIRED_LEAST}")), "shared-keys")
    crowds = shared.filter(F.col("kind") == CROWD).select("need", F.col("u").alias("key"), F.col("v").alias("u"))
    often = crowds.groupBy("need", "u").count().filter(f"count >= {CROWDED_LEAST}")
    crowds = crowds.join(often.select("need", "u"), ["need", "u"])
    least = crowds.groupBy("key").agg(F.min("u").alias("v"))
    linked = crowds.join(least, "key").filter("u != v").select("u", "v")
    edges = shared.filter(F.col("kind") == PAIR).select("u", "v").unionByName(linked)
    edges = stored(edges, "candidates")
    discard(shared)
    return edges


def _node_filter(nodes: DataFrame) -> bytes:
    """A bitmap that has a bit set for every node, of ``FILTER_BITS`` bits for any number of them."""
    bit = F.pmod("node", F.lit(FILTER_BITS)) + 1
    rows = (
        nodes.groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
        .collect()
    )
    size = 4096  # bytes of one of Spark's bitmaps
    found = bytearray(FILTER_BITS // 8 + size)
    for row in rows:
        found[(row["bucket"] - 1) * size : row["bucket"] * size] = row["bits"]
    return bytes(found)


def _node_texts(docs: DataFrame, text_col: str, nodes: DataFrame, like: Likeness) -> DataFrame:
    """``node`` and a text of it, for nodes that pass the filter; others of the same bit come along."""
    shared = docs.sparkSession.sparkContext.broadcast(_node_filter(nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        sent: set[int] = set()
        for batch in batches:
            for part in slices(batch, "body"):
                _, found, rows = _distinct_sets(part, like, sent)
                at = (found % np.uint64(FILTER_BITS)).astype(np.int64)
                hit = (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[hit].astype(np.int64)), part.column("body").take(pa.array(rows[hit]))],
                    ["node", "body"],
                )

    return docs.select(F.col(text_col).alias("body")).mapInArrow(run, "node long, body string")


def _joined(rows: DataFrame, like: Likeness) -> DataFrame:
    """Links ``u``, ``v`` within each unit of ``rows`` (``task``, ``unit``, ``node``, ``label``, ``body``).

    A task is one group for Python and may hold many units; only units are joined.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        links = []
        for _, unit in frame.groupby("unit", sort=False):
            unit = unit.drop_duplicates("node").sort_values("node")
            sets = document_shingles(pa.array(unit["body"], pa.large_string()), like.shingle_words)
            nodes = unit["node"].to_numpy()
            links += [(nodes[a], nodes[b]) for a, b in links_within(sets, unit["label"].to_numpy(), like)]
        return pd.DataFrame(links, columns=["u", "v"], dtype="int64")

    return rows.groupBy("task").applyInPandas(run, "u long, v long")


def _labelled(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``label``, the component of each by the edges so far."""
    roots = connected(edges).select("node", F.col("root").alias("label"))
    return nodes.join(roots, "node", "left").withColumn("label", F.coalesce("label", "node"))


def node_roots(docs: DataFrame, text_col: str, nodes: DataFrame, like: Likeness) -> DataFrame:
    """``node`` and ``root`` of all nodes that are linked with another; ``nodes`` has ``node``, ``n_shingles``."""
    candidates = _candidates(docs, text_col, like)
    clusters = connected(candidates)
    discard(candidates)
    sized = clusters.join(nodes, "node").select("node", F.col("root").alias("cluster"), "n_shingles")
    sized = stored(sized, "clusters")
    split = F.greatest(
        F.ceil(F.count("*") / GROUP_NODES), F.ceil(F.sum("n_shingles") / GROUP_SHINGLES), F.lit(1)
    ).cast("int")
    sizes = sized.groupBy("cluster").agg(split.alias("splits"), F.sum("n_shingles").alias("shingles"))
    sizes = stored(sizes, "cluster-sizes")
    # Only clusters of several splits are looked up; there are few of them.
    several = sizes.filter("splits > 1").select("cluster", "splits")
    splits = F.coalesce("splits", F.lit(1))
    placed = sized.join(several, "cluster", "left").select(
        "node", "cluster", splits.alias("splits"), F.pmod(F.xxhash64("node"), splits).cast("int").alias("split")
    )
    texts = _node_texts(docs, text_col, sized.select("node"), like)
    texts = texts.join(placed, "node").dropDuplicates(["node"])
    texts = stored(texts, "cluster-texts")

    shingles, large = sizes.agg(F.sum("shingles"), F.max("splits")).first()
    tasks = max(1, -(-(shingles or 0) // (GROUP_SHINGLES // 2)))
    task = F.pmod(F.xxhash64("cluster", "split"), F.lit(tasks))
    unit = F.struct("cluster", "split").cast("string")
    label = F.col("node").alias("label")
    links = stored(_joined(texts.select(task.alias("task"), unit.alias("unit"), "node", label, "body"), like), "links")
    if (large or 1) == 1:
        return connected(links)

    # Clusters of several splits: the first split with each other one.
    texts = texts.filter("splits > 1")
    pair = F.when(F.col("split") == 0, F.sequence(F.lit(1), F.col("splits") - 1)).otherwise(F.array("split"))
    labelled = _labelled(links, texts).withColumn("with", F.explode(pair))
    unit = F.concat_ws(":", "cluster", "with")
    rows = labelled.select(unit.alias("task"), unit.alias("unit"), "node", "label", "body")
    links = links.unionByName(stored(_joined(rows, like), "links"))

    # What is not in the largest component of its cluster, with everything.
    labelled = stored(_labelled(links, texts), "labelled")
    largest = (
        labelled.groupBy("cluster", "label").count().groupBy("cluster").agg(F.max_by("label", F.struct("count", "label")).alias("giant"))
    )
    marked = labelled.join(largest, "cluster").withColumn("rest", F.col("label") != F.col("giant"))
    rests = marked.filter("rest").groupBy("cluster").agg(
        F.greatest(F.ceil(F.count("*") / GROUP_NODES), F.lit(1)).cast("int").alias("rests")
    )
    marked = marked.join(rests, "cluster").withColumn("mine", F.pmod(F.xxhash64("node", F.lit(1)), F.col("rests")).cast("int"))
    every = marked.select("*", F.explode(F.sequence(F.lit(0), F.col("rests") - 1)).alias("a"), F.col("split").alias("b"))
    rest = marked.filter("rest").select("*", F.col("mine").alias("a"), F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("b"))
    unit = F.concat_ws(":", "cluster", "a", "b")
    rows = every.unionByName(rest).select(unit.alias("task"), unit.alias("unit"), "node", "label", "body")
    return connected(links.unionByName(stored(_joined(rows, like), "links")))


def link_components(
    docs: DataFrame, like: Likeness, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its id, ``n_shingles`` and ``component_id``, the least id linked to it."""
    bound_batches(docs.sparkSession)
    members = stored(_signatures(docs, id_col, text_col, like), "signatures")
    nodes = members.filter("n_shingles > 0").groupBy("node").agg(F.first("n_shingles").alias("n_shingles"), F.min("doc").alias("least"), F.count("*").alias("copies"))
    nodes = stored(nodes, "nodes")
    roots = stored(node_roots(docs, text_col, nodes.select("node", "n_shingles"), like), "roots")
    # Only nodes with a link or a copy have another id than their own.
    named = (
        nodes.join(roots, "node", "left")
        .filter("copies > 1 OR root IS NOT NULL")
        .withColumn("root", F.coalesce("root", "node"))
    )
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = named.select("node", "root").join(ids, "root").select("node", "component_id")
    return members.join(ids, "node", "left").select(
        F.col("doc").alias(id_col),
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc")).otherwise(F.col("doc")).alias("component_id"),
    )


def keep_one_of_each(
    docs: DataFrame, like: Likeness, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without those linked to a smaller id; rows that repeat an id are kept or left out together."""
    found = link_components(docs, like, id_col, text_col)
    gone = found.filter(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias("gone_id")).distinct()
    return docs.join(gone, docs[id_col] == gone["gone_id"], "left_anti")


def keep_one_row_of_each(
    docs: DataFrame, like: Likeness, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The first row of each group of linked rows, and one of the rows that repeat id and text.

    Decides by row, so ids may be null or shared. The first has the smallest id, nulls last, then text
    hash; rows that repeat both are ordered by a hash of all columns.
    """
    plain = [name for name, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    rows = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("row_key"))
    rows = stored(rows, "rows")  # a row keeps its key from here on
    row = F.col("row")
    place = F.struct(
        row[id_col].isNull().alias("nameless"),
        row[id_col].alias("id"),
        F.xxhash64(row[text_col]).alias("text_hash"),
        F.xxhash64(*[row[name] for name in plain]).alias("row_hash"),
        "row_key",
    ).alias("place")
    found = link_components(rows.select(place, row[text_col].alias("body")), like, "place", "body")
    found = stored(found, "row-components")
    linked = found.filter(F.col("component_id.row_key") != F.col("place.row_key")).select("place.row_key")
    # Texts without words are linked with nothing, but rows that repeat one are still repeats.
    same = ["place.nameless", "place.id", "place.text_hash"]
    key = F.struct(*same).alias("same")
    textless = found.filter("n_shingles = 0").select("place", F.xxhash64(key).alias("group"), key)
    firsts = textless.groupBy("group", "same").agg(F.min("place").alias("first"), F.count("*").alias("copies"))
    firsts = firsts.filter("copies > 1").select("group", F.col("same").alias("first_same"), "first")
    repeats = (
        textless.join(firsts, "group")
        .filter(F.col("same").eqNullSafe(F.col("first_same")) & (F.col("place.row_key") != F.col("first.row_key")))
        .select("place.row_key")
    )
    return rows.join(linked.unionByName(repeats), "row_key", "left_anti").select(
        *[row[name].alias(name) for name in docs.columns]
    )
