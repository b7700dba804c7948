"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, counted over the corpus.

Each text is encoded by tokenizer A (byte-level, as space + text) and B (pieces, which adds the space itself). Byte
offsets where tokens of both end cut a text into groups; a token of A and one of B are linked where their bytes
overlap. The count of a linked pair of ids is the number of documents that hold it.

1. First pass: every task counts the documents of each linked pair it meets.
2. The distinct pairs are dealt into shards of about ``SHARD_PAIRS``, and each shard gets a minimal perfect hash:
   levels of bits in which every key that shares its bit with no other is placed, the rest goes on, and a key's
   number is the count of bits set before its own. Counts of the first pass are added up in dense vectors indexed
   by that number, one a task, and the vectors are added up in a tree, slice by slice. Keys are kept beside the
   counts, so a key of another shard is told apart.
3. Second pass: documents are aligned again and their links looked up, in one shard at a time.

A shard holds at most some ``SHARD_PAIRS`` keys and counts of 8 bytes each whatever the corpus, which bounds what is
broadcast; a corpus with more pairs takes more shards, and a lookup pass for each.

Both tokenizers cut at a single space between visible characters, whatever stands around it. So texts are cut
there, and a worker encodes and aligns each distinct cut once, as long as it remembers it. A text of more than
``LONG_BLOCK`` bytes is worked on block by block; only a cut, a run without such a space, is always held whole.

Defined results: null and empty texts, and those whose tokens do not give back the bytes of space + text, have
no tokens: all counts 0 and an empty digest. Repeated rows and ids count as documents of their own; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.tables import bound_batches, stored
from txnrisk.llm.words import buffers, mix, slices, worker_cache

SHARD_PAIRS = 2_000_000
#: Counts in one slice of a dense vector, and tasks whose slices one step of the tree adds up.
SLICE_COUNTS = 1 << 16
FAN_IN = 32
#: Distinct cuts and pairs a worker remembers; each memory starts anew beyond it.
REMEMBERED_CUTS = 600_000
REMEMBERED_PAIRS = 4_000_000
HELD_BYTES = 16 << 20
#: Bytes of one long text that are worked on at a time.
LONG_BLOCK = 1 << 20
#: Bytes of new cuts that are put together for one call of a tokenizer.
CALL_BYTES = 1 << 14
GAMMA = 2.0
COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
SEED_STEP = np.uint64(0x9E3779B97F4A7C15)

#: Bytes that can stand next to a space at which a text is cut: visible ASCII, or part of a longer character.
VISIBLE = np.zeros(256, bool)
VISIBLE[33:127] = True
VISIBLE[128:] = True
#: First bytes of all characters beyond ASCII that some tokenizer may take for white space.
WIDE_SPACE = np.zeros(256, bool)
WIDE_SPACE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
PIECE_SPACE = "▁"


def byte_level_alphabet() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: visible Latin-1 stands for itself, the rest follows 255."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(rest)}


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all items of runs of a flat array, run by run."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Vocabulary:
    """A byte string for each number."""

    def __init__(self, entries: list[bytes]):
        self.size = np.array([len(e) for e in entries], np.int64)
        self._start = np.cumsum(self.size) - self.size
        self._bytes = np.frombuffer(b"".join(entries), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        return self._bytes[_places(self._start[ids], self.size[ids])]


class ByteTokenizer:
    """Tokenizer A: a byte-level file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        alphabet = byte_level_alphabet()
        entries = [b""] * self._tokenizer.get_vocab_size()
        for token, number in self._tokenizer.get_vocab().items():
            entries[number] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.vocabulary = Vocabulary(entries)

    def encode(self, spaced: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(spaced, add_special_tokens=False)
        return [np.array(encoding.ids, np.int64) for encoding in found]


class PieceTokenizer:
    """Tokenizer B: a sentencepiece model that puts a space before every text."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = []
        for number in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(number)
            if self._model.is_byte(number):
                entries.append(bytes([int(piece[3:5], 16)]))
            else:
                entries.append(piece.replace(PIECE_SPACE, " ").encode())
        self.vocabulary = Vocabulary(entries)

    def encode(self, spaced: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self._model.encode([text[1:] for text in spaced], num_threads=1)]


def cut_at_spaces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Space + each text in one buffer, cut before each space at which both tokenizers cut.

    Returns the buffer, the starts of all cuts and one more, the number of the first cut of each text and one more,
    and which cuts may be encoded next to others. An empty text has no cut.
    """
    sizes = np.diff(offsets)
    begins = offsets[:-1][sizes > 0]
    data = np.insert(data, begins, 32)
    begins = begins + np.arange(len(begins))
    padded = np.concatenate((np.zeros(3, np.uint8), data, np.zeros(1, np.uint8)))
    third, second, last = padded[:-3], padded[1:-2], padded[2:-1]  # the bytes before each place, and the end
    wide = (last >= 128) & ((second == 0xC2) | ((second >= 128) & np.isin(third, [0xE1, 0xE2, 0xE3])))
    before = VISIBLE[last] & ~wide
    safe = (data == 32) & VISIBLE[padded[4:]] & ~WIDE_SPACE[padded[4:]]
    start = safe & before[:-1]
    start[begins] = True
    starts = np.append(np.flatnonzero(start), len(data))
    counts = np.searchsorted(starts[:-1], begins)
    first = np.zeros(len(sizes) + 1, np.int64)
    first[-1] = len(starts) - 1
    first[:-1][sizes > 0] = counts
    first[:-1] = np.minimum.accumulate(np.where(sizes > 0, first[:-1], first[-1])[::-1])[::-1]
    return data, starts, first, safe[starts[:-1]] & before[starts[1:]]


def align(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of A and B (by position) that overlap, and the ends that both share.

    ``a`` and ``b`` are the ends of the tokens of one text, or of several in a row.
    """
    begin_a = np.concatenate(([0], a))[: len(a)]
    low = np.searchsorted(b, begin_a, "right")
    high = np.searchsorted(b, a, "left")
    counts = high - low + 1
    return np.repeat(np.arange(len(a)), counts), _places(low, counts), np.intersect1d(a, b, assume_unique=True)


class Numbers:
    """A growing array."""

    def __init__(self, kind):
        self._held = np.zeros(1 << 12, kind)
        self._size = 0

    def extend(self, values: np.ndarray) -> None:
        need = self._size + len(values)
        if need > len(self._held):
            self._held = np.concatenate((self._held[: self._size], np.zeros(max(need, len(self._held)), self._held.dtype)))
        self._held[self._size : need] = values
        self._size = need

    @property
    def values(self) -> np.ndarray:
        return self._held[: self._size]


class Aligner:
    """Aligns texts; remembers cuts and pairs it has met.

    ``pairs`` has the key of each remembered pair, ``a_id * width + b_id``, in order of appearance. The groups are
    only spelt out ``with_text``.
    """

    def __init__(self, a_path: str, b_path: str, with_text: bool = True):
        self._with_text = with_text
        self._a, self._b = ByteTokenizer(a_path), PieceTokenizer(b_path)
        self.width = len(self._b.vocabulary.size)
        a_size = len(self._a.vocabulary.size)
        kinds = ((a_size, b","), (a_size, b"|"), (self.width, b","), (self.width, b";"))
        self._decimal = Vocabulary([b"%d%s" % (i, mark) for size, mark in kinds for i in range(size)])
        self.era = 0  # grows when pairs are numbered anew
        self._forget_pairs()

    def _forget_pairs(self) -> None:
        self._pair_number: dict[int, int] = {}
        self.pairs = Numbers(np.int64)
        self.era += 1
        self._forget_cuts()

    def _forget_cuts(self) -> None:
        self._cut_number: dict[bytes, int] = {}
        self._good = Numbers(bool)  # whether the bytes of each cut come back
        self._sizes = [Numbers(np.int64) for _ in range(4)]  # tokens of A and B, groups, links
        self._link = Numbers(np.int32)  # pair numbers of all links, cut by cut
        self._link_end = Numbers(np.int64)
        self._text = Numbers(np.uint8)  # the groups as text, a semicolon after each, cut by cut
        self._text_end = Numbers(np.int64)
        self._text_size = Numbers(np.int64)
        self._held_bytes = 0

    @staticmethod
    def _tokens(tokenizer, cuts: list[bytes], sizes: np.ndarray, call_heads: np.ndarray) -> tuple:
        """Token ids of all cuts in a row, how many each has, and whether they give back its bytes.

        The cuts of one call are encoded together, and one by one if that does not give back all their bytes.
        """
        spell, size = tokenizer.vocabulary.spell, tokenizer.vocabulary.size
        joined = [b"".join(cuts[i:j]) for i, j in zip(call_heads[:-1], call_heads[1:])]
        flat, counts, good = [], [], np.ones(len(cuts), bool)
        for i, raw, ids in zip(call_heads[:-1], joined, tokenizer.encode([raw.decode() for raw in joined])):
            j = i + 1 if len(raw) == sizes[i] else i + np.searchsorted(np.cumsum(sizes[i:]), len(raw)) + 1
            wanted, at = np.cumsum(sizes[i:j]), np.cumsum(size[ids])
            last = np.searchsorted(at, wanted)
            if spell(ids).tobytes() == raw and (at[last] == wanted).all():
                flat.append(ids)
                counts.append(np.diff(last, prepend=-1))
                continue
            for k, alone in zip(range(i, j), tokenizer.encode([cut.decode() for cut in cuts[i:j]])):
                good[k] = spell(alone).tobytes() == cuts[k]
                flat.append(alone)
                counts.append(np.array([len(alone)]))
        return np.concatenate(flat), np.concatenate(counts), good

    def _learn(self, cuts: list[bytes], apart: np.ndarray) -> None:
        """Add cuts, in order, to the memory; those that stand ``apart`` are not encoded next to others."""
        sizes = np.array([len(c) for c in cuts], np.int64)
        call = np.cumsum(sizes) // CALL_BYTES
        new = np.ones(len(cuts), bool)
        new[1:] = (call[1:] != call[:-1]) | apart[1:] | apart[:-1]
        heads = np.append(np.flatnonzero(new), len(cuts))
        found = [self._tokens(t, cuts, sizes, heads) for t in (self._a, self._b)]
        good = found[0][2] & found[1][2]
        (a, n_a), (b, n_b) = ((ids[np.repeat(good, n)], n * good) for ids, n, _ in found)
        end_a, end_b = self._a.vocabulary.size[a].cumsum(), self._b.vocabulary.size[b].cumsum()
        left, right, common = align(end_a, end_b)
        keys = a[left] * self.width + b[right]
        numbers = self._pair_number
        distinct, back = np.unique(keys, return_inverse=True)
        before = len(numbers)
        own = np.fromiter((numbers.setdefault(k, len(numbers)) for k in distinct.tolist()), np.int64, len(distinct))
        self.pairs.extend(distinct[own >= before])  # numbered in this order
        self._link.extend(own[back].astype(np.int32))

        # Cut by cut: how many groups end and how many links begin in it.
        cut_end = (sizes * good).cumsum()
        n_groups, n_links = (
            np.diff(np.searchsorted(places, cut_end, "right"), prepend=0) * good for places in (common, end_a[left])
        )
        for held, values in zip(self._sizes, (n_a, n_b, n_groups, n_links)):
            held.extend(values)
        first = len(self._good.values)
        self._good.extend(good)
        self._link_end.extend((self._link_end.values[-1] if first else 0) + n_links.cumsum())
        if self._with_text:
            text, text_sizes = self._group_text(a, b, end_a, end_b, common)
            text_end = np.concatenate(([0], text_sizes.cumsum()))
            text_size = np.diff(text_end[np.concatenate(([0], n_groups.cumsum()))])
            self._text_end.extend((self._text_end.values[-1] if first else 0) + text_size.cumsum())
            self._text_size.extend(text_size)
            self._text.extend(text)
        self._cut_number.update(zip(cuts, range(first, first + len(cuts))))
        self._held_bytes += int(sizes.sum())

    def _group_text(self, a, b, end_a, end_b, common) -> tuple[np.ndarray, np.ndarray]:
        """The text of all groups in a row, and the size of each: ids of A, a bar, ids of B, a semicolon."""
        to_a, to_b = np.searchsorted(end_a, common, "right"), np.searchsorted(end_b, common, "right")
        group_a = np.searchsorted(common, end_a)
        group_b = np.searchsorted(common, end_b)
        # Every id is spelt with what follows it, at its place among the ids of both sides.
        last_a, last_b = end_a == common[group_a], end_b == common[group_b]
        kinds = len(self._a.vocabulary.size), self.width
        ids = np.empty(len(a) + len(b), np.int64)
        before_b = np.concatenate(([0], to_b))
        ids[np.arange(len(a)) + before_b[group_a]] = a + last_a * kinds[0]
        ids[np.arange(len(b)) + to_a[group_b]] = 2 * kinds[0] + b + last_b * kinds[1]
        spelt = self._decimal.size[ids].cumsum()
        sizes = np.diff(spelt[to_a + to_b - 1], prepend=0)
        return self._decimal.spell(ids), sizes

    def numbers(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The remembered cuts of all texts in a row, and the number of the first one of each text and one more."""
        data, starts, first, joinable = cut_at_spaces(data, offsets)
        return self._remembered(data, starts, joinable), first

    def blocks(self, data: np.ndarray) -> Iterator[np.ndarray]:
        """The remembered cuts of one long text, about ``LONG_BLOCK`` bytes of it at a time.

        Cuts are known by their numbers until the next block only.
        """
        data, starts, _, joinable = cut_at_spaces(data, np.array([0, len(data)]))
        edges = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(data), LONG_BLOCK)), len(starts) - 1))
        for i, j in zip(edges[:-1], edges[1:]):
            block = starts[i : j + 1] - starts[i]
            yield self._remembered(data[starts[i] : starts[j]], block, joinable[i:j])

    def _remembered(self, data: np.ndarray, starts: np.ndarray, joinable: np.ndarray) -> np.ndarray:
        if len(self._pair_number) > REMEMBERED_PAIRS:
            self._forget_pairs()
        if len(self._cut_number) > REMEMBERED_CUTS or self._held_bytes > HELD_BYTES:
            self._forget_cuts()
        array = pa.Array.from_buffers(
            pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(np.ascontiguousarray(data))]
        )
        coded = array.dictionary_encode()
        at = coded.indices.to_numpy()
        distinct = coded.dictionary.to_pylist()
        known = self._cut_number
        number = np.fromiter((known.get(c, -1) for c in distinct), np.int64, len(distinct))
        new = np.flatnonzero(number < 0)
        if len(new):
            where = np.zeros(len(distinct), np.int64)
            where[at] = np.arange(len(at))  # a place of each distinct cut
            self._learn([distinct[i] for i in new], ~joinable[where[new]])
            number[new] = np.arange(len(self._good.values) - len(new), len(self._good.values))
        return number[at]

    def links(self, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pair numbers of all links of the cuts, and where each cut's end."""
        counts = self._sizes[3].values[cuts]
        places = _places(self._link_end.values[cuts] - counts, counts)
        return self._link.values[places], counts.cumsum()

    def sums(self, cuts: np.ndarray) -> list[np.ndarray]:
        """Tokens of A and B, groups and links of each cut."""
        return [held.values[cuts] for held in self._sizes]

    def spelt(self, cuts: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Which texts have only cuts whose bytes come back."""
        return _between((~self._good.values[cuts]).astype(np.int64), first) == 0

    def text(self, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The groups of the cuts as text, and where each cut's end."""
        sizes = self._text_size.values[cuts]
        return self._text.values[_places(self._text_end.values[cuts] - sizes, sizes)], sizes.cumsum()

    def digests(self, cuts: np.ndarray, first: np.ndarray, spelt: np.ndarray) -> list[str]:
        """The SHA-256 of each text's groups; '' if there are none or its bytes do not come back."""
        text, ends = self.text(cuts)
        ends = np.concatenate(([0], ends))[first].tolist()
        groups = zip(ends[:-1], ends[1:], spelt.tolist())
        # The last group has no semicolon.
        return [hashlib.sha256(text[i : j - 1]).hexdigest() if good and j > i else "" for i, j, good in groups]


def _aligner(a_path: str, b_path: str, with_text: bool) -> Aligner:
    """The aligner of a worker, which keeps one."""
    cache, key = worker_cache(), (a_path, b_path, with_text)
    if cache.get("aligner", (None,))[0] != key:
        cache.pop("aligner", None)
        cache["aligner"] = key, Aligner(*key)
    return cache["aligner"][1]


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys, in levels of bits.

    The number of a key is that of set bits before its own; a key that is none of those given has any number, or -1.
    """

    MAX_LEVELS = 64

    def __init__(self, levels: list[np.ndarray]):
        self._levels = levels
        set_bits = [np.bitwise_count(level).astype(np.int64) for level in levels]
        starts = np.concatenate(([0], np.cumsum([s.sum() for s in set_bits]))).astype(np.int64)
        self._before = [start + np.cumsum(s) - s for start, s in zip(starts, set_bits)]
        self.size = int(starts[-1])

    @staticmethod
    def _place(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            hashed = mix(keys.astype(np.uint64) + SEED_STEP * np.uint64(level + 1))
        return ((hashed >> np.uint64(32)) * np.uint64(bits) >> np.uint64(32)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> "PerfectHash":
        levels = []
        while len(keys):
            if len(levels) == cls.MAX_LEVELS:
                raise ValueError("keys are not distinct")
            words = int(GAMMA * len(keys)) // 64 + 1
            at = cls._place(keys, len(levels), 64 * words)
            alone = np.bincount(at, minlength=64 * words) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            keys = keys[~alone[at]]
        return cls(levels)

    def number(self, keys: np.ndarray) -> np.ndarray:
        found = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for depth, (level, before) in enumerate(zip(self._levels, self._before)):
            if not len(left):
                break
            at = self._place(keys[left], depth, 64 * len(level))
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (level[word] >> bit & np.uint64(1)).astype(bool)
            below = level[word] & ((np.uint64(1) << bit) - np.uint64(1))
            found[left[hit]] = (before[word] + np.bitwise_count(below))[hit]
            left = left[~hit]
        return found

    def pack(self) -> list[bytes]:
        return [level.tobytes() for level in self._levels]

    @classmethod
    def unpack(cls, levels: list[bytes]) -> "PerfectHash":
        return cls([np.frombuffer(level, np.uint64) for level in levels])


class PairTable:
    """Keys and counts of one shard by perfect hash."""

    def __init__(self, levels: list[bytes], keys: bytes, counts: bytes | None = None):
        self._hash = PerfectHash.unpack(levels)
        self._keys = np.frombuffer(keys, np.int64)
        self._counts = None if counts is None else np.frombuffer(counts, np.int64)

    def number(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for keys that are not in the table."""
        if not len(self._keys):
            return np.full(len(keys), -1, np.int64)
        found = self._hash.number(keys)
        return np.where((found >= 0) & (self._keys[found] == keys), found, -1)

    def count(self, keys: np.ndarray) -> np.ndarray:
        """The count of each key, 0 for keys that are not in the table."""
        found = self.number(keys)
        if not len(self._keys):
            return np.zeros(len(keys), np.int64)
        return np.where(found >= 0, self._counts[found], 0)


def pair_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``pair`` and ``docs``: for each task, in how many of its documents a pair is linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a_path, b_path, False)
        counts, era = np.zeros(0, np.int64), aligner.era

        def flushed() -> Iterator[pa.RecordBatch]:
            met = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[met]), pa.array(counts[met])], ["pair", "docs"])

        pairs = aligner.pairs.values
        for batch in batches:
            for part in slices(batch, "body"):
                data, offsets = buffers(part.column("body"))
                if len(offsets) == 2 and len(data) > LONG_BLOCK:
                    keys = _long_pairs(aligner, data)
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.ones(len(keys), np.int64))], ["pair", "docs"])
                    continue
                cuts, first = aligner.numbers(data, offsets)
                if aligner.era != era:  # pairs are numbered anew
                    yield from flushed()
                    counts, era = np.zeros(0, np.int64), aligner.era
                pairs = aligner.pairs.values
                if len(counts) < len(pairs):
                    counts = np.concatenate((counts, np.zeros(len(pairs) - len(counts) + 1024, np.int64)))
                once = _distinct_cuts(cuts, first, aligner.spelt(cuts, first))
                links, ends = aligner.links(once[1])
                doc = np.repeat(once[0], np.diff(ends, prepend=0))
                held = _distinct(doc * len(counts) + links)
                counts += np.bincount(held % len(counts), minlength=len(counts))
        yield from flushed()

    return docs.select("body").mapInArrow(run, "pair long, docs long")


def _long_pairs(aligner: Aligner, data: np.ndarray) -> np.ndarray:
    """The distinct linked pairs of one long text; none if its bytes do not come back."""
    found = np.zeros(0, np.int64)
    for cuts in aligner.blocks(data):
        if not aligner.spelt(cuts, np.array([0, len(cuts)])).all():
            return found[:0]
        links, _ = aligner.links(np.unique(cuts))
        found = np.union1d(found, aligner.pairs.values[np.unique(links)])
    return found


def _long_result(aligner: Aligner, data: np.ndarray, pairs: "PairTable", highest: np.ndarray) -> tuple[list[int], str]:
    """The counts and the digest of one long text."""
    totals, digest, held = np.zeros(len(COUNTS), np.int64), hashlib.sha256(), b""
    for cuts in aligner.blocks(data):
        if not aligner.spelt(cuts, np.array([0, len(cuts)])).all():
            return [0] * len(COUNTS), ""
        numbers, times = np.unique(aligner.links(cuts)[0], return_counts=True)
        keys = aligner.pairs.values[numbers]
        counts = pairs.count(keys)
        best = (counts > 0) & (counts == highest[keys // aligner.width])
        totals += [*(int(s.sum()) for s in aligner.sums(cuts)), int((times * best).sum()), int((times * counts).sum())]
        text = held + aligner.text(cuts)[0].tobytes()
        digest.update(text[:-1])
        held = text[-1:]  # the last group has no semicolon
    return totals.tolist(), digest.hexdigest() if totals[0] else ""


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in order; by sorting, which is quicker here than a hash table."""
    ordered = np.sort(values)
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return ordered[new]


def _distinct_cuts(cuts: np.ndarray, first: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and cut of every different cut of each wanted text."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    chosen = wanted[doc]
    width = int(cuts.max(initial=0)) + 1
    once = _distinct(doc[chosen] * width + cuts[chosen])
    return once // width, once % width


def build_shards(partials: DataFrame, shards: int) -> DataFrame:
    """``shard``, ``levels`` and ``keys``: the perfect hash of each shard's distinct pairs and the pairs by number."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        keys = rows["pair"].to_numpy(np.int64)
        hashed = PerfectHash.of(keys)
        ordered = np.zeros(len(keys), np.int64)
        ordered[hashed.number(keys)] = keys
        return pd.DataFrame({"shard": [key[0]], "levels": [hashed.pack()], "keys": [ordered.tobytes()]})

    distinct = partials.select("pair").distinct().withColumn("shard", _shard(shards))
    return distinct.groupBy("shard").applyInPandas(run, "shard int, levels array<binary>, keys binary")


def _shard(shards: int):
    return F.pmod(F.xxhash64("pair"), F.lit(shards)).cast("int")


def dense_counts(partials: DataFrame, table) -> DataFrame:
    """``slice`` and ``counts``: the dense vector of a shard (broadcast), added up over all tasks in a tree."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = PairTable(*table.value)
        counts = np.zeros(max(1, len(pairs._keys)), np.int64)
        for batch in batches:
            at = pairs.number(batch.column("pair").to_numpy())
            inside = at >= 0
            np.add.at(counts, at[inside], batch.column("docs").to_numpy()[inside])
        task = TaskContext.get().partitionId()
        rows = []
        for number in range(-(-len(counts) // SLICE_COUNTS)):
            part = counts[number * SLICE_COUNTS : (number + 1) * SLICE_COUNTS]
            if part.any():
                rows.append((number, task // FAN_IN, part.tobytes()))
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.binary())],
            ["slice", "branch", "counts"],
        )

    def added(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for part in batch.column("counts"):
                total = total + np.frombuffer(part.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k.as_py() for k in key[:1]], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["slice", "counts"]
        )

    rows = partials.mapInArrow(vectors, "slice int, branch int, counts binary")
    branches = rows.groupBy("slice", "branch").applyInArrow(added, "slice int, counts binary")
    return branches.groupBy("slice").applyInArrow(added, "slice int, counts binary")


def _collected(vector: DataFrame, size: int) -> np.ndarray:
    """The dense vector of one shard, whose size is bounded."""
    counts = np.zeros(size, np.int64)
    for row in vector.collect():
        part = np.frombuffer(row["counts"], np.int64)
        counts[row["slice"] * SLICE_COUNTS :][: len(part)] = part[: size - row["slice"] * SLICE_COUNTS]
    return counts


def lookup(docs: DataFrame, a_path: str, b_path: str, table, best) -> DataFrame:
    """Align the documents again and look their links up in one shard.

    ``table`` and ``best`` are broadcast: the shard, and the highest count of each id of A in all shards.
    """
    kind = docs.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, {', '.join(f'{name} long' for name in COUNTS)}, groups_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a_path, b_path, True)
        pairs, highest = PairTable(*table.value), best.value
        era, counts, is_best = -1, np.zeros(0, np.int64), np.zeros(0, bool)
        for batch in batches:
            for part in slices(batch, "body"):
                data, offsets = buffers(part.column("body"))
                if len(offsets) == 2 and len(data) > LONG_BLOCK:
                    sums, digest = _long_result(aligner, data, pairs, highest)
                    values = [part.column("doc"), *(pa.array([s], pa.int64()) for s in sums), pa.array([digest], pa.string())]
                    yield pa.RecordBatch.from_arrays(values, ["doc", *COUNTS, "groups_sha256"])
                    continue
                cuts, first = aligner.numbers(data, offsets)
                if aligner.era != era:
                    era, counts, is_best = aligner.era, np.zeros(0, np.int64), np.zeros(0, bool)
                keys = aligner.pairs.values[len(counts) :]
                if len(keys):
                    found = pairs.count(keys)
                    counts = np.concatenate((counts, found))
                    is_best = np.concatenate((is_best, (found > 0) & (found == highest[keys // aligner.width])))
                spelt = aligner.spelt(cuts, first)
                links, ends = aligner.links(cuts)
                ends = np.concatenate(([0], ends))
                bounds = ends[first]
                per_link = (is_best[links].astype(np.int64), counts[links])
                sums = [_between(values, first) for values in aligner.sums(cuts)]
                sums += [_between(values, bounds) for values in per_link]
                digests = pa.array(aligner.digests(cuts, first, spelt), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), *(pa.array(s * spelt) for s in sums), digests],
                    ["doc", *COUNTS, "groups_sha256"],
                )

    return docs.mapInArrow(run, schema)


def _between(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate((np.zeros(1, np.int64), np.cumsum(values)))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def align_documents(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_pairs: int = SHARD_PAIRS,
) -> DataFrame:
    """One row per document: its id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``."""
    spark = docs.sparkSession
    context = spark.sparkContext
    bound_batches(spark)
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("body"))
    partials = stored(pair_counts(rows, a_path, b_path), "pair-counts")
    distinct = partials.select("pair").distinct().count()
    shards = max(1, -(-distinct // shard_pairs))
    built = stored(build_shards(partials, shards), "pair-shards")

    a_size = len(ByteTokenizer(a_path).vocabulary.size)
    width = len(PieceTokenizer(b_path).vocabulary.size)
    highest = np.zeros(a_size, np.int64)
    tables = []
    for number in range(shards):
        row = built.filter(F.col("shard") == number).first()
        levels, keys = ([bytes(x) for x in row["levels"]], bytes(row["keys"])) if row else ([], b"")
        shard = context.broadcast((levels, keys))
        mine = partials.filter(_shard(shards) == number)
        vector = stored(dense_counts(mine, shard), "dense-counts")
        ids = np.frombuffer(keys, np.int64) // width
        np.maximum.at(highest, ids, _collected(vector, len(ids)))
        tables.append((levels, keys, vector))
    best = context.broadcast(highest)

    passes = []
    for levels, keys, vector in tables:
        counts = _collected(vector, len(keys) // 8)
        passes.append(lookup(rows, a_path, b_path, context.broadcast((levels, keys, counts.tobytes())), best))
    found = passes[0]
    if len(passes) > 1:
        # A shard knows the counts of its own pairs only. Rows equal in all else are repeats of one document.
        for more in passes[1:]:
            found = found.unionByName(more)
        repeats = F.count("*") / F.lit(len(passes))
        sums = [F.call_function("div", F.sum(name), repeats.cast("long")).cast("long").alias(name) for name in COUNTS[4:]]
        found = (
            found.groupBy("doc", *COUNTS[:4], "groups_sha256")
            .agg(*sums, repeats.cast("int").alias("repeats"))
            .withColumn("repeat", F.explode(F.sequence(F.lit(1), F.col("repeats"))))
        )
    return found.select(F.col("doc").alias(id_col), *COUNTS, "groups_sha256")
