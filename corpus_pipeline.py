"""From raw documents to packed training sequences, one stage after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.llm import jaccard, lines, mixing, packing, quality
from txnrisk.llm.registry import MIX, domain_of, tokenizer_path
from txnrisk.llm.tables import read
from txnrisk.sources.tables import discard, materialize, scratch


def with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` as it is after a stage has changed texts."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines, of any length, that repeat an earlier one, up to one word."""
    return with_length(lines.drop_repeated_lines(docs, min_words=1))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by five-word shingles, whatever its id."""
    return jaccard.keep_one_row_of_each(docs, jaccard.Likeness(5, 80, 100))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, in the target proportions; rows repeat by epoch, the last of a leaf cut."""
    return with_length(mixing.mix(docs, MIX, domain_of(F.col("source"))))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Token ids and near lines are beyond SQL, so the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is stored for the next stage.

    What a stage stores on the way is deleted once its result is written, and so is what the next stage has read.
    """
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs = materialize(stage(spark, docs, sf_dir), name, outlast=True)
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
