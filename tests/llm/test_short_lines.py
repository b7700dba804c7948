"""Lines of any length count in the query and in the pipeline."""

import random

import corpus_pipeline
from pyspark.sql import functions as F
from tests.conftest import SMALL
from tests.llm import plain
from tests.llm.test_lines import edited_lines
from txnrisk.llm import lines
from txnrisk.llm.registry import op8_line_dedup


def test_any_length_against_all_pairs(spark, small, odd_rows):
    rows = edited_lines([(r.doc_id, r.text) for r in small.collect()], random.Random(4))
    rows += [(9000 + i, text) for i, text in odd_rows] + [(9100 + i, "short\none\n\n}") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = plain.near_lines(rows, least=1)
    assert {r.doc_id: r.text for r in lines.drop_repeated_lines(docs, min_words=1).collect()} == want
    assert want != plain.near_lines(rows)


def test_query_uses_every_length(spark, small):
    want = plain.near_lines([(r.doc_id, r.text) for r in small.collect()], least=1)
    assert {r.doc_id: r.text for r in op8_line_dedup(spark, SMALL).collect()} == want


def test_copies_leave_no_stub(spark):
    body = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"Short title\n{body}\nThe end") for i in range(40)]  # exact copies
    rows += [(100 + i, f"Short title\n{body.replace('word7 ', f'z{i} ')}\nThe end") for i in range(20)]  # near ones
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.lit(0).cast("long"))
    left = corpus_pipeline.line_dedup(spark, docs.repartition(4), SMALL)
    left = corpus_pipeline.jaccard_join(spark, left, SMALL).collect()
    assert [(r.doc_id, r.text) for r in left] == [rows[0]]
