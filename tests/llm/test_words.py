"""Hashes of long buffers are those of short ones, and long texts need little memory."""

import subprocess
import sys

import numpy as np
import pytest

from txnrisk.llm import words


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 1000])
def test_blocks_change_no_hash(monkeypatch, size):
    data = np.random.default_rng(size).integers(0, 256, size, dtype=np.uint8)
    starts, ends = np.triu_indices(size + 1) if size < 100 else (np.arange(size), np.minimum(np.arange(size) + 90, size))
    whole = words.Spans(data).hash(starts, ends)
    monkeypatch.setattr(words, "SLICE_BYTES", 64)
    assert (words.Spans(data).hash(starts, ends) == whole).all()


def test_equal_ranges_have_equal_hashes():
    data = np.frombuffer(b"abcabc" * 400_000, np.uint8)  # several blocks
    starts = np.arange(0, len(data) - 3, 3)
    assert len(set(words.Spans(data).hash(starts, starts + 3).tolist())) == 1


@pytest.mark.parametrize(
    "call",
    [
        "quality.measure(text)",
        "words.document_shingles(text, 4)",
        "lines.Lines(pa.record_batch([pa.array([1]), pa.array([2]), text], ['doc', 'text_hash', 'body']), 1)",
    ],
)
def test_memory_of_a_long_text(call):
    """A text of 20 MB is read within 600 MB."""
    code = f"""
import random, resource
import pyarrow as pa
from txnrisk.llm import lines, quality, words
rnd = random.Random(1)
text = pa.array([" ".join(str(rnd.randrange(10**6)) + ("" if i % 30 else chr(10)) for i in range(2_900_000))])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
found = {call}
after = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
print(text.nbytes, (after - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 19_000_000 and int(out[1]) < 600, out
