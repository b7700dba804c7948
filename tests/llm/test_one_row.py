"""One row of each group stays, with ids that are null, repeated or shared by different texts."""

from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from tests.conftest import SMALL
from tests.llm import plain
from txnrisk.llm.jaccard import Likeness, keep_one_row_of_each

A = " ".join(f"alpha{i}" for i in range(40))
B = " ".join(f"beta{i}" for i in range(40))
C = " ".join(f"gamma{i}" for i in range(40))


def run(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return Counter((r.doc_id, r.text) for r in keep_one_row_of_each(docs, Likeness()).collect())


def test_null_ids(spark):
    found = run(spark, [(None, A)] * 3 + [(None, A + " end"), (None, B), (7, B), (None, None), (None, None), (None, "")])
    assert found in (
        Counter([(None, a), (7, B), (None, None), (None, "")]) for a in (A, A + " end")
    )


def test_repeated_rows(spark):
    assert run(spark, [(1, A), (2, B), (3, ""), (4, None)] * 2) == Counter([(1, A), (2, B), (3, ""), (4, None)])


def test_different_texts_of_one_id(spark):
    # The link of B to row 1 leaves C, the other text of id 5.
    assert run(spark, [(1, B), (5, B), (5, C), (6, A)]) == Counter([(1, B), (5, C), (6, A)])


def test_against_all_pairs(spark, small, odd_rows):
    rows = [(r.doc_id, r.text) for r in small.collect()] + [(9000 + i, text) for i, text in odd_rows]
    want = plain.components(rows, 5, 80, 100)
    kept = Counter((doc, text) for doc, text in rows if want[doc][1] == doc)
    assert run(spark, rows + rows) == kept


def test_pipeline_stage_on_a_table_loaded_twice(spark, small):
    once = Counter(r.doc_id for r in corpus_pipeline.jaccard_join(spark, small, SMALL).collect())
    docs = small.union(small).withColumn("row", F.lit("kept")).withColumn("row_key", F.lit("kept"))
    out = corpus_pipeline.jaccard_join(spark, docs, SMALL)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == once
