from collections import defaultdict

import corpus_pipeline
from pyspark.sql import functions as F
from tests.conftest import SMALL


def test_sequences_are_gapless(spark):
    sequences = defaultdict(list)
    for row in corpus_pipeline.run(spark, SMALL).collect():
        sequences[row.sequence_id].append((row.offset, row.length))
    for found in sequences.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= 4096


def test_a_run_leaves_only_what_its_result_reads(spark, tmp_path, monkeypatch):
    folder = tmp_path / "shared"
    monkeypatch.setattr("txnrisk.sources.tables.shared_dir", lambda _: str(folder))
    corpus_pipeline.run(spark, SMALL).count()
    # The last stage's input, and the pieces that its own result reads.
    assert sorted(path.name.split("-")[0] for path in folder.iterdir()) == ["mixing", "pieces"]


def test_stages_keep_columns_and_take_empty_tables(spark, small):
    docs = small
    for name in ("gone", "gone_id", "cut_doc", "doc", "text_hash", "row"):
        docs = docs.withColumn(name, F.lit("kept"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns
        assert stage(spark, docs.limit(0), SMALL).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SMALL).count() == 0
