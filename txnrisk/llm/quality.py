"""Quality rules on repetition: how much of a text lies in word windows and lines that it repeats.

Rolling hashes of several window lengths are taken in numpy over a batch of documents at a time;
a document never leaves its task and no rows are shuffled.

Defined results: a null or empty text has zero words and fails the base rule; extra columns are
kept by ``keep_good`` and ignored by ``quality_measures``; repeated rows are judged alike; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from txnrisk.llm.tables import bound_batches
from txnrisk.llm.words import STEP, Spans, buffers, mix, owners, slices, windows, word_bounds

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
BASE_WINDOW = 5

#: Largest share of a text's word characters in repeated windows of that many words.
MAX_WINDOW_SHARE = {3: 0.3, 5: 0.2, 8: 0.15}
MAX_LINE_SHARE = 0.3
MAX_SYMBOL_SHARE = 0.1

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    + "".join(f"share_{size} double, " for size in MAX_WINDOW_SHARE)
    + "line_share double, symbol_share double, base_failed boolean, kept boolean"
)


def _per_document(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(values)))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _repeated(hashes: np.ndarray, document: np.ndarray) -> np.ndarray:
    """Which hashes occur twice or more in their document."""
    own = mix(hashes + (document.astype(np.uint64) + np.uint64(1)) * STEP)
    ordered = np.sort(own)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    return np.isin(own, np.unique(twice)) if len(twice) else np.zeros(len(own), bool)


def _covered(words: int, firsts: np.ndarray, size: int) -> np.ndarray:
    """Which words lie in one of the windows."""
    marks = np.zeros(words + 1, np.int32)
    np.add.at(marks, firsts, 1)
    np.add.at(marks, firsts + size, -1)
    return np.cumsum(marks[:-1]) > 0


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """The columns of ``MEASURES`` for a batch of texts."""
    data, offsets = buffers(texts)
    starts, ends, bounds = word_bounds(data, offsets)
    points = np.zeros(len(data) + 1, np.int32 if len(data) < 1 << 31 else np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    chars = (points[ends] - points[starts]).astype(np.int64)
    del points
    spans = Spans(data)
    hashes = spans.hash(starts, ends)
    document = owners(bounds)

    n_words = np.diff(bounds)
    word_chars = _per_document(chars, bounds)
    symbols = np.zeros(256, bool)
    symbols[list(SYMBOLS)] = True
    n_symbols = np.diff(np.searchsorted(np.flatnonzero(symbols[data]), offsets))

    # A line ends at a line feed or with its document; only lines with a word count.
    feeds = np.flatnonzero(data == 10)
    heads = np.unique(np.concatenate((feeds + 1, offsets[:-1])))
    heads = heads[heads < len(data)]
    line_document = np.searchsorted(offsets, heads, "right") - 1
    next_feed = np.append(feeds, len(data))[np.searchsorted(feeds, heads)]
    tails = np.minimum(next_feed, offsets[line_document + 1])
    first_word = np.searchsorted(starts, heads)
    has_word = first_word < np.searchsorted(starts, tails)
    heads, tails, line_document = heads[has_word], tails[has_word], line_document[has_word]
    line_hash = mix(spans.hash(heads, tails) + line_document.astype(np.uint64) * STEP)
    del spans  # eight bytes for each of the text
    _, first_seen = np.unique(line_hash, return_index=True)
    again = np.ones(len(line_hash), bool)
    again[first_seen] = False
    line_bounds = np.searchsorted(line_document, np.arange(len(bounds)))
    n_dup_lines = _per_document(again, line_bounds)
    char_sums = np.concatenate(([0], np.cumsum(chars)))
    line_chars = char_sums[np.searchsorted(starts, tails)] - char_sums[np.searchsorted(starts, heads)]
    most = np.maximum(word_chars, 1)
    shares = {"line_share": _per_document(line_chars * again, line_bounds) / most}

    for size in sorted({*MAX_WINDOW_SHARE, BASE_WINDOW}):
        firsts, window_hash = windows(hashes, bounds, size)
        inside = _covered(len(starts), firsts[_repeated(window_hash, document[firsts])], size)
        if size == BASE_WINDOW:
            n_repeat_words = _per_document(inside, bounds)
        if size in MAX_WINDOW_SHARE:
            shares[f"share_{size}"] = _per_document(chars * inside, bounds) / most
    shares["symbol_share"] = n_symbols / most

    base_failed = (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)
    bad = base_failed | (shares["line_share"] > MAX_LINE_SHARE) | (shares["symbol_share"] > MAX_SYMBOL_SHARE)
    for size, limit in MAX_WINDOW_SHARE.items():
        bad |= shares[f"share_{size}"] > limit
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": n_symbols,
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat_words,
        **{f"share_{size}": shares[f"share_{size}"] for size in MAX_WINDOW_SHARE},
        "line_share": shares["line_share"],
        "symbol_share": shares["symbol_share"],
        "base_failed": base_failed,
        "kept": ~bad,
    }


def quality_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, the measures and the verdict."""
    kind = docs.schema[id_col].dataType.simpleString()
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                found = measure(part.column(text_col))
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col), *map(pa.array, found.values())], [id_col, *found]
                )

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {MEASURES}")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that pass, with all their columns."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                yield part.filter(pa.array(measure(part.column(text_col))["kept"]))

    return docs.mapInArrow(run, docs.schema)
