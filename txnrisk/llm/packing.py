"""Packing token sequences into windows by best-fit decreasing.

Each document is tokenized where its row lies. Documents longer than a window are cut into full
windows, which are a sequence each and need no packing, and a rest of at most one piece. Pieces are stored, and the rests
are dealt to packing groups by row position, so a group holds about ``GROUP_PIECES`` of them whatever the keys or
the length of the documents. Only piece lengths are stored and shuffled unless token ids are asked for.

Inside a group pieces are taken by falling length, and each goes to the open window with the
smallest sufficient space, found in a segment tree over remaining capacity.

Defined results: a null or empty text is one piece that holds the end id; repeated rows are packed
one by one; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.tables import bound_batches, stored
from txnrisk.llm.words import LOWER, Spans, buffers, slices, word_bounds, worker_cache

WINDOW = 4096
END_ID = 2
GROUP_PIECES = 2000
#: The first sequence number of those that one full window makes up.
FULL_WINDOWS = 1 << 62
#: Words remembered by a worker with their ids; the memory starts anew beyond this many.
REMEMBERED_WORDS = 1_500_000


#: ASCII punctuation that always begins a new token after a letter; an apostrophe may not.
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[c for c in range(33, 127) if not chr(c).isalnum() and c != 39]] = True
LETTER = np.zeros(256, bool)
LETTER[97:123] = True
#: A word put between the words of one call, whose id marks where each begins.
MARK = "|"


class WordTokenizer:
    """Token ids of texts, for a tokenizer that drops case and white space and never joins across it.

    Equal words have equal ids then, so each distinct word, by its 64-bit hash, is tokenized once per
    worker.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._mark = self._tokenizer.encode(MARK, add_special_tokens=False).ids[0]
        self._forget()

    def _forget(self) -> None:
        #: Hashes of the words met so far in order, and which of the runs of ids belongs to each.
        self._known = np.zeros(0, np.uint64)
        self._run = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)
        self._starts = np.zeros(1, np.int64)

    def _ids_of(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(encoding.ids, np.uint32) for encoding in found]

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        marked = np.array([MARK.encode() in word for word in words], bool)
        hashes = np.concatenate((hashes[~marked], hashes[marked]))
        plain = [word.decode() for word, apart in zip(words, marked) if not apart]
        ids = self._ids_of([f" {MARK} ".join(plain)])[0]
        ends = np.flatnonzero(np.append(ids, self._mark) == self._mark)[: len(plain)]
        rest = self._ids_of([word.decode() for word, apart in zip(words, marked) if apart])
        sizes = np.concatenate((np.diff(ends, prepend=-1) - 1, np.array([len(x) for x in rest], np.int64)))
        runs = np.arange(len(words)) + len(self._starts) - 1
        self._ids = np.concatenate([self._ids, ids[ids != self._mark], *rest])
        self._starts = np.concatenate([self._starts, self._starts[-1] + np.cumsum(sizes)])
        order = np.argsort(hashes)
        at = np.searchsorted(self._known, hashes[order])
        self._known = np.insert(self._known, at, hashes[order])
        self._run = np.insert(self._run, at, runs[order])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a buffer in a row, and where each text's ids begin."""
        if b"<|" not in data.tobytes():  # else the tokenizer's special words could be spelt out
            data = LOWER[data]
            before = np.flatnonzero(LETTER[data[:-1]] & PUNCTUATION[data[1:]]) + 1
            cuts = np.searchsorted(before, offsets, "right")
            offsets = offsets + np.where(np.isin(offsets, before), cuts - 1, cuts)
            data = np.insert(data, before, 32)
        starts, ends, bounds = word_bounds(data, offsets)
        hashes, first, word = np.unique(Spans(data).hash(starts, ends), return_index=True, return_inverse=True)
        if len(self._known) > REMEMBERED_WORDS:
            self._forget()
        at = np.searchsorted(self._known, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self._known)
        new[inside] = self._known[at[inside]] != hashes[inside]
        if new.any():
            raw = data.tobytes()
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist())
            self._learn(hashes[new], [raw[a:b] for a, b in spans])
            at = np.searchsorted(self._known, hashes)
        run = self._run[at][word]
        sizes = np.diff(self._starts)[run]
        total = np.concatenate(([0], np.cumsum(sizes)))
        places = np.arange(total[-1]) + np.repeat(self._starts[run] - total[:-1], sizes)
        return self._ids[places], total[bounds]


def _tokenizer(path: str) -> WordTokenizer:
    cache = worker_cache()
    if path not in cache:
        cache[path] = WordTokenizer(path)
    return cache[path]


def cut_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int | None = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: full windows and each document's rest.

    ``piece_key`` numbers pieces by input split and position in it, so a repeated task
    gives the same numbers.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    bound_batches(docs.sparkSession)
    schema = (
        f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        "piece_key long" + (", ids array<int>" if with_ids else "")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path)
        key = TaskContext.get().partitionId() << 40
        tail = [] if end_id is None else [end_id]
        for batch in batches:
            for part in slices(batch, text_col):
                flat, cuts = tokenizer.encode(*buffers(part.column(text_col)))
                rows, pieces = [], []
                for i in range(len(cuts) - 1):
                    ids = np.concatenate((flat[cuts[i] : cuts[i + 1]], np.array(tail, np.uint32)))
                    for start in range(0, len(ids), window):
                        piece = ids[start : start + window].astype("<u4")
                        rows.append((i, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), key))
                        pieces.append(piece.astype(np.int32))
                        key += 1
                if not rows:
                    continue
                at, start, length, crc, total, keys = (np.array(x, np.int64) for x in zip(*rows))
                columns = [
                    part.column(id_col).take(pa.array(at)),
                    *map(pa.array, (start, length, crc, total, keys)),
                ]
                names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "piece_key"]
                if with_ids:
                    ends = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(pieces))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


class OpenWindows:
    """Open windows by remaining capacity, as a segment tree of counts."""

    def __init__(self, window: int):
        self._leaves = 1 << window.bit_length()
        self._counts = [0] * (2 * self._leaves)
        self._windows: dict[int, list[int]] = {}

    def add(self, window: int, space: int) -> None:
        self._windows.setdefault(space, []).append(window)
        self._change(space, 1)

    def take_tightest(self, length: int) -> tuple[int, int] | None:
        """Remove and return an open window with the least space that is at least ``length``."""
        counts, node = self._counts, self._leaves + length
        if not counts[node]:
            while node > 1 and (node & 1 or not counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self._leaves:
                node = 2 * node if counts[2 * node] else 2 * node + 1
        space = node - self._leaves
        self._change(space, -1)
        return self._windows[space].pop(), space

    def _change(self, space: int, by: int) -> None:
        node = self._leaves + space
        while node:
            self._counts[node] += by
            node >>= 1


def best_fit_decreasing(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """Window number and offset of every piece."""
    placed: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    open_windows, used = OpenWindows(window), 0
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = open_windows.take_tightest(lengths[i])
        if found is None:
            found, used = (used, window), used + 1
        number, space = found
        placed[i] = (number, window - space)
        if space > lengths[i]:
            open_windows.add(number, space - lengths[i])
    return placed


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the rows of ``cut_documents``, which are read several times.

    Full windows are numbered from ``FULL_WINDOWS`` on.
    """
    columns = [c for c in pieces.columns if c != "piece_key"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name in columns)
    full, rests = pieces.filter(F.col("length") == window), pieces.filter(F.col("length") < window)
    groups = max(1, -(-rests.count() // GROUP_PIECES))
    group = F.pmod(F.xxhash64("piece_key"), F.lit(groups))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("piece_key", ignore_index=True)
        placed = best_fit_decreasing(rows["length"].tolist(), window)
        numbers = np.array([number for number, _ in placed], np.int64)
        rows["sequence_id"] = np.int64(key[0]) * (1 << 24) + numbers
        rows["offset"] = np.array([offset for _, offset in placed], np.int64)
        return rows[[*columns, "sequence_id", "offset"]]

    grouped = rests.withColumn("pack_group", group).groupBy("pack_group")
    packed = grouped.applyInPandas(run, f"{schema}, sequence_id long, offset long")
    alone = (F.lit(FULL_WINDOWS) + F.col("piece_key")).alias("sequence_id")
    return packed.unionByName(full.select(*columns, alone, F.lit(0).cast("long").alias("offset")))


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int | None = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most ``window`` ids.

    With ``with_ids`` the pieces carry their ids, so ``sequences`` can put them together.
    """
    pieces = cut_documents(docs, tokenizer_path, id_col, text_col, window, end_id, with_ids)
    return pack(stored(pieces, "pieces"), window)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its ids, at most a window of them, and the length of each piece."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    return (
        packed.groupBy("sequence_id")
        .agg(ordered.alias("pieces"))
        .select("sequence_id", F.flatten("pieces.ids").alias("ids"), F.col("pieces.length").alias("lengths"))
    )
