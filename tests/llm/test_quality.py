from tests.llm import plain
from txnrisk.llm.quality import keep_good, quality_measures


def test_base_measures(spark, medium, odd, odd_rows):
    for docs, rows in ((medium, medium.collect()), (odd, odd.collect())):
        text = {row.doc_id: row.text for row in rows}
        found = quality_measures(docs).collect()
        assert len(found) == len(rows)
        for row in found:
            assert tuple(row)[1:6] == plain.quality(text[row.doc_id])
            failed = row.n_words < 10 or 100 * row.n_repeat_words > 20 * row.n_words
            assert row.base_failed == failed
            assert not (failed and row.kept)


def test_labelled_quality(spark, medium):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    rows = quality_measures(medium).join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    poor = [r.kept for r in rows if r.quality == 0]
    assert all(good)
    assert sum(poor) <= 0.1 * len(poor)


def test_filter_keeps_columns_and_rows(spark, odd, medium):
    assert keep_good(odd).columns == odd.columns
    kept = {r.doc_id for r in keep_good(medium).collect()}
    assert kept == {r.doc_id for r in quality_measures(medium).collect() if r.kept}
    empty = odd.limit(0)
    assert keep_good(empty).count() == 0
    assert quality_measures(empty).count() == 0
