"""What mixing takes is what the plan says, to the token, in the stage and at the end of the pipeline."""

from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tests.conftest import SMALL
from tests.llm import plain
from tokenizers import Tokenizer
from txnrisk.llm import mixing, quality
from txnrisk.llm.registry import MIX, domain_of, tokenizer_path


def path_of(docs):
    rows = docs.withColumn("domain", domain_of(F.col("source"))).collect()
    return {r.doc_id: (r.domain, r.lang, r.source) for r in rows}


def first_words(text, count):
    """``text`` up to the end of its word ``count``."""
    end = 0
    for word in plain.words(text)[:count]:
        end = text.index(word, end) + len(word)
    return text if count == len(plain.words(text)) else text[:end]


def test_first_words(spark, odd_rows):
    rows = [(i, text, n) for i, text in odd_rows if text for n in (1, 3, 20_000)] + [(50, " \n a\t b  c ", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    found = docs.select("text", "n", mixing.first_words(F.col("text"), F.col("n")).alias("cut")).collect()
    for r in found:
        n = min(r.n, len(plain.words(r.text)))
        assert plain.words(r.cut) == plain.words(r.text)[:n]
        assert r.text.startswith(r.cut)


def test_tokens_of_each_leaf(spark, small):
    path = path_of(small)
    rows = [(r.doc_id, r.text, *path[r.doc_id]) for r in small.collect()]
    want = Counter()
    for (doc, _, n), times in plain.mixed(rows, MIX.weights, MIX.total, MIX.max_epochs, MIX.seed).items():
        want[path[doc]] += n * times
    found = Counter()
    for r in corpus_pipeline.mix_sources(spark, small, SMALL).collect():
        assert r.n_chars == len(r.text)
        found[path[r.doc_id]] += len(plain.words(r.text))
    assert found == want


def test_tokens_of_their_own_need_a_cut(small):
    with pytest.raises(ValueError):
        mixing.mix(small, MIX, F.lit("d"), tokens=F.char_length("text"))


def test_run_against_plain_stages(spark, small):
    kept = {r.doc_id for r in quality.quality_measures(small).filter("kept").collect()}
    path = path_of(small)
    texts = plain.near_lines([(r.doc_id, r.text) for r in small.collect() if r.doc_id in kept], least=1)
    groups = plain.components(list(texts.items()), 5, 80, 100)
    texts = {doc: text for doc, text in texts.items() if groups[doc][1] == doc}
    taken = plain.mixed([(d, t, *path[d]) for d, t in texts.items()], MIX.weights, MIX.total, MIX.max_epochs, MIX.seed)
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for (doc, _, n), times in taken.items():
        size = len(tokenizer.encode(first_words(texts[doc], n), add_special_tokens=False).ids) + 1
        for start in range(0, size, 4096):
            want[doc, start, size] += times
    found = Counter((r.doc_id, r.start, r.doc_tokens) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert found == want
