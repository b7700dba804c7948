import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.conftest import ODD
from txnrisk.llm import alignment
from txnrisk.llm.alignment import PerfectHash, align_documents

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TOUGH = [
    "  two spaces first and  between and last ",
    "a b   c　d 　 e   f  g",
    "it's we'll I'M 'tis ' s",
    "<|endoftext|> <s> </s> <0x41> <unk>",
    "a ▁ b ▁c d▁e",
    "\r\n\r\n tabs\t\t \tmixed \n \n x",
    "naïve café 漢字 かな 😀 👩‍👩‍👧 é é",
    "x" * 5000 + " " + "ab " * 50,
    "﻿ start \x00 nul \x7f del",
    " ",
    "\n",
]


def plain(docs):
    """All columns for (id, text) rows, token by token."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    alphabet, free = {}, 256
    for code in range(256):
        if chr(code).isprintable() and code not in (32, 173):
            alphabet[chr(code)] = code
        else:
            alphabet[chr(free)] = code
            free += 1
    names = {number: token for token, number in a.get_vocab().items()}

    def bytes_a(number):
        return bytes(alphabet[c] for c in names[number])

    def bytes_b(number):
        piece = b.id_to_piece(number)
        if re.fullmatch("<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    held, found = defaultdict(set), []
    for row, (_, text) in enumerate(docs):
        tokens = [[], []]
        if text:
            ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            spelt = [[bytes_a(i) for i in ids[0]], [bytes_b(i) for i in ids[1]]]
            if all(b"".join(s) == (" " + text).encode() for s in spelt):
                for side in (0, 1):
                    at = 0
                    for i, s in zip(ids[side], spelt[side]):
                        tokens[side].append((i, at, at + len(s)))
                        at += len(s)
        links, j = [], 0
        for i, start, end in tokens[0]:
            while tokens[1][j][2] <= start:
                j += 1
            k = j
            while k < len(tokens[1]) and tokens[1][k][1] < end:
                links.append((i, tokens[1][k][0]))
                k += 1
        for pair in links:
            held[pair].add(row)
        ends = sorted({x[2] for x in tokens[0]} & {y[2] for y in tokens[1]})
        groups, places = [], [0, 0]
        for end in ends:
            side = []
            for t in (0, 1):
                first = places[t]
                while places[t] < len(tokens[t]) and tokens[t][places[t]][2] <= end:
                    places[t] += 1
                side.append(",".join(str(x[0]) for x in tokens[t][first : places[t]]))
            groups.append(side)
        text_of = ";".join("|".join(side) for side in groups)
        found.append((len(tokens[0]), len(tokens[1]), len(ends), links, hashlib.sha256(text_of.encode()).hexdigest() if text_of else ""))
    count = {pair: len(rows) for pair, rows in held.items()}
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return [
        (doc, n_a, n_b, n_groups, len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), digest)
        for (doc, _), (n_a, n_b, n_groups, links, digest) in zip(docs, found)
    ]


def rows_of(frame):
    return Counter(tuple(row) for row in frame.collect())


@pytest.mark.parametrize("shard_pairs", [alignment.SHARD_PAIRS, 3000])
def test_against_token_by_token(spark, small, shard_pairs):
    docs = [(row.doc_id, row.text) for row in small.collect()]
    docs += [(1000 + i, text) for i, text in enumerate(ODD + TOUGH)]
    docs += [(1000, "two words"), (None, "two words"), (None, "two words"), (None, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert rows_of(align_documents(frame, A, B, shard_pairs=shard_pairs)) == Counter(plain(docs))


@pytest.mark.parametrize("shard_pairs", [alignment.SHARD_PAIRS, 500])
def test_long_texts_in_blocks(spark, small, monkeypatch, shard_pairs):
    """Blocks, and memories that start anew between them, change nothing."""
    docs = [(row.doc_id, row.text) for row in small.collect()][:60]
    docs += [(1000 + i, text) for i, text in enumerate(TOUGH + ["tail 　\n", "a " * 400 + "▁", "word " * 300])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    for name, value in (("LONG_BLOCK", 50), ("REMEMBERED_CUTS", 30), ("REMEMBERED_PAIRS", 90)):
        monkeypatch.setattr(alignment, name, value)
    monkeypatch.setattr(alignment, "slices", lambda batch, column: (batch.slice(i, 1) for i in range(batch.num_rows)))
    assert rows_of(align_documents(frame, A, B, shard_pairs=shard_pairs)) == Counter(plain(docs))


def test_blocks_of_a_long_text(monkeypatch):
    """The counts and digest of a text do not depend on where its blocks end, nor on what is remembered."""
    texts = [t for t in ODD + TOUGH if t and len(t) < 50_000] + ["tail 　\n", "a " * 400 + "▁", "word w" * 300]
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        whole = alignment.Aligner(A, B)
        keys = alignment._long_pairs(whole, data)
        hashed = PerfectHash.of(keys)
        ordered = np.zeros(len(keys), np.int64)
        ordered[hashed.number(keys)] = keys
        counts = ordered % 7 + 1
        table = alignment.PairTable(hashed.pack(), ordered.tobytes(), counts.tobytes())
        highest = np.zeros(60_000, np.int64)
        np.maximum.at(highest, ordered // whole.width, counts)
        expected = alignment._long_result(whole, data, table, highest)
        with monkeypatch.context() as patch:
            for name, value in (("LONG_BLOCK", 40), ("REMEMBERED_CUTS", 5), ("REMEMBERED_PAIRS", 9)):
                patch.setattr(alignment, name, value)
            pieces = alignment.Aligner(A, B)
            assert (alignment._long_pairs(pieces, data) == keys).all()
            assert alignment._long_result(pieces, data, table, highest) == expected
            assert len(list(pieces.blocks(data))) >= min(2, len(text) // 400)


def test_random_texts(spark):
    rnd = random.Random(3)
    letters = list("abcé漢😀'<|>0 7.,") + [" "] * 12 + ["\n", "\t", " ", "　", "▁", " ", "\x85", "\x1f", "the", "tion"]
    docs = [(i, "".join(rnd.choices(letters, k=rnd.randrange(60)))) for i in range(600)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows_of(align_documents(frame, A, B)) == Counter(plain(docs))


def test_memory_of_a_worker_starts_anew(monkeypatch):
    """Small memories give the same counts."""
    monkeypatch.setattr(alignment, "REMEMBERED_CUTS", 5)
    monkeypatch.setattr(alignment, "REMEMBERED_PAIRS", 5)
    texts = ["some words of one text", "other words", None, "some words again 　", "many more words of text"] * 3
    small = alignment.Aligner(A, B)
    for text in texts:
        cuts, first = small.numbers(*alignment.buffers(pa.array([text], pa.string())))
        fresh = alignment.Aligner(A, B)
        other, other_first = fresh.numbers(*alignment.buffers(pa.array([text], pa.string())))
        assert [s.tolist() for s in small.sums(cuts)] == [s.tolist() for s in fresh.sums(other)]
        digests = small.digests(cuts, first, small.spelt(cuts, first))
        assert digests == fresh.digests(other, other_first, fresh.spelt(other, other_first))
    assert small.era > 1


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 50_000))
    hashed = PerfectHash.of(keys)
    assert hashed.size == len(keys)
    assert sorted(hashed.number(keys).tolist()) == list(range(len(keys)))
    assert PerfectHash.unpack(hashed.pack()).number(keys).tolist() == hashed.number(keys).tolist()
    assert PerfectHash.of(keys[:0]).number(keys[:3]).tolist() == [-1, -1, -1]


def test_other_keys_are_told_apart():
    keys = np.arange(0, 2000, 2)
    hashed = PerfectHash.of(keys)
    ordered = np.zeros(len(keys), np.int64)
    ordered[hashed.number(keys)] = keys
    table = alignment.PairTable(hashed.pack(), ordered.tobytes(), (ordered * 3).tobytes())
    assert table.count(np.arange(2000)).tolist() == [k * 3 if k % 2 == 0 else 0 for k in range(2000)]


def test_other_columns_and_empty_table(spark, odd):
    found = align_documents(odd, A, B)
    assert found.count() == odd.count()
    assert align_documents(odd.limit(0), A, B).collect() == []
