"""Words, word hashes and word windows of a batch of texts, in numpy.

A batch is one byte buffer with document offsets. A word is a run of bytes other than
``\\x20 \\x09-\\x0D``; no byte of a longer UTF-8 character is among those. Hashes are
polynomials over the bytes, taken from running sums modulo 2**64 and then mixed, so the cost
per byte is a few array operations whatever the window length.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
STEP = np.uint64(0xD6E8FEB86659FD93)
SLICE_BYTES = 1 << 20

WHITE = np.zeros(256, bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker, across its tasks."""
    name = "txnrisk_llm_worker_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``limit`` bytes of ``column``, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``count`` powers of the hash base and of its inverse."""
    cache = worker_cache()
    if len(cache.get("powers", ((),))[0]) < count:
        size = max(count, SLICE_BYTES + 1)
        tables = []
        for base in (BASE, INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table))
        if size > 4 * SLICE_BYTES:  # one very long text: use the tables once
            return tuple(tables)
        cache["powers"] = tuple(tables)
    return cache["powers"]


class Spans:
    """Hashes of byte ranges of one buffer.

    Running sums are taken block by block, so a long buffer needs eight bytes for each of its own and little more.
    """

    def __init__(self, data: np.ndarray):
        table, self._inverse = powers(min(len(data), SLICE_BYTES) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        scale = 1
        for start in range(0, len(data), SLICE_BYTES):
            block = data[start : start + SLICE_BYTES].astype(np.uint64)
            block += np.uint64(1)
            block *= table[: len(block)]
            if start:
                scale = scale * int(table[SLICE_BYTES]) % (1 << 64)
                block *= np.uint64(scale)
            sums = self._sums[start + 1 : start + 1 + len(block)]
            np.cumsum(block, out=sums)
            sums += self._sums[start]

    def _undone(self, starts: np.ndarray) -> np.ndarray:
        """The inverse powers of the places."""
        if len(self._sums) <= SLICE_BYTES + 1:
            return self._inverse[starts]
        steps = np.full(len(self._sums) // SLICE_BYTES + 1, self._inverse[SLICE_BYTES], np.uint64)
        steps[0] = 1
        return self._inverse[starts % SLICE_BYTES] * np.cumprod(steps)[starts // SLICE_BYTES]

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._undone(starts))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the index of each document's first word (one more than documents)."""
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(WHITE[data], out=inside[1:-1])
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    starts[cuts] = inside[1:-1][cuts]
    ends[cuts - 1] = inside[1:-1][cuts - 1]
    first = np.flatnonzero(starts)
    return first, np.flatnonzero(ends) + 1, np.searchsorted(first, offsets)


def owners(bounds: np.ndarray) -> np.ndarray:
    """The document of each item, from the index of each document's first item."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def windows(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every window of ``size`` words that lies in one document."""
    count = max(0, len(hashes) - size + 1)
    inside = np.zeros(len(hashes) + 1, bool)
    counts = np.diff(bounds)
    long = counts >= size
    marks = np.zeros(len(hashes) + 1, np.int32)
    np.add.at(marks, bounds[:-1][long], 1)
    np.add.at(marks, bounds[1:][long] - size + 1, -1)
    inside = np.cumsum(marks[:count]) > 0
    at = np.flatnonzero(inside)
    value = hashes[at]
    for j in range(1, size):
        value = value * STEP + hashes[at + j]
    return at, mix(value)


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """Per document the sorted distinct hashes of its word windows.

    A document with fewer words has its whole sequence as one, an empty one has none.
    """
    at, value = windows(hashes, bounds, size)
    cuts = np.searchsorted(at, bounds)
    counts = np.diff(bounds)
    found = []
    for i, count in enumerate(counts):
        if count >= size:
            found.append(np.unique(value[cuts[i] : cuts[i + 1]]))
        elif count:
            whole = np.uint64(count)
            with np.errstate(over="ignore"):
                for h in hashes[bounds[i] : bounds[i + 1]]:
                    whole = whole * STEP + h
            found.append(mix(np.array([whole], np.uint64)))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def document_shingles(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The shingle set of every text, ASCII letters lower-cased."""
    data, offsets = buffers(texts)
    data = LOWER[data]
    starts, ends, bounds = word_bounds(data, offsets)
    return shingles(Spans(data).hash(starts, ends), bounds, size)
