"""Every operator of this package as a query over one folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.llm import (
    alignment,
    divergence,
    fingerprints,
    html,
    jaccard,
    language,
    lines,
    mixing,
    oracle,
    packing,
    quality,
    secrets,
    urls,
    warc,
)
from txnrisk.llm.tables import read


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: The domains are dealt out by the number in a source's name; the test tables name none.
DOMAINS = ("web", "books", "news", "forum")
MIX = mixing.Plan(
    weights={"web": 4, "books": 3, "news": 2, "forum": 1, "*/en": 6, "*/de": 2, "*/fr": 2, "*/es": 1},
    max_epochs=4,
    seed=7,
)


def domain_of(source: Column) -> Column:
    number = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]{1,9})$", 1).try_cast("int")
    return F.coalesce(F.element_at(F.array(*map(F.lit, DOMAINS)), F.pmod(number, F.lit(len(DOMAINS))) + 1), F.lit("other"))


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of each document and its edited text, and how alike they are."""
    return fingerprints.edited_pairs(read(spark, folder, "documents"))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many tokens of each document each epoch takes."""
    docs = read(spark, folder, "documents")
    return mixing.selection(docs, MIX, domain_of(F.col("source")))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    packed = packing.pack_documents(read(spark, folder, "documents"), tokenizer_path())
    return packed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of each document, learned from three quarters of them."""
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.filter(~language.held_out("doc_id")))
    rows = docs.select("doc_id", language.held_out("doc_id").alias("held_out"), "text")
    return language.predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def op5_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on each page's URL."""
    pages = read(spark, folder, "pages")
    labelled = urls.labelled_by_document(pages, read(spark, folder, "labels"))
    return urls.judge(pages, urls.mine_rules(labelled))


def op6_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in each document; sources are owners, the languages of a source its repositories."""
    return secrets.summary(secrets.scan(read(spark, folder, "documents")))


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """The component of each document by shared 4-word shingles."""
    return jaccard.link_components(read(spark, folder, "documents"), jaccard.Likeness(4, 85, 100))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The documents without the lines, of any length, that repeat an earlier one up to one word."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return lines.drop_repeated_lines(docs, min_words=1).withColumn("n_chars", F.char_length("text").cast("long"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Repetition measures and the verdict on each document."""
    return quality.quality_measures(read(spark, folder, "documents"))


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of each page."""
    pages = html.extract_text(read(spark, folder, "pages").select("page_id", "url", "html"))
    return pages.withColumn("n_chars", F.char_length("text").cast("long"))


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """How the tokens of two tokenizers cover each document, with corpus counts of linked ids."""
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return alignment.align_documents(read(spark, folder, "documents"), *paths)


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """How far the sources of each language lie apart, and the terms that set each source off."""
    return divergence.audit(read(spark, folder, "documents"))


def op13_warc(spark: SparkSession, folder: str) -> DataFrame:
    """What the WARC archives of all pages hold, looked up by URL and read back."""
    return warc.round_trip(read(spark, folder, "pages").select("page_id", "url", "html"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_fingerprints": op1_fingerprints,
        "op2_mixing": op2_mixing,
        "op3_packing": op3_packing,
        "op4_language_id": op4_language_id,
        "op5_url_filters": op5_url_filters,
        "op6_secret_scans": op6_secret_scans,
        "op7_jaccard_join": op7_jaccard_join,
        "op8_line_dedup": op8_line_dedup,
        "op9_quality_rules": op9_quality_rules,
        "op10_html_extraction": op10_html_extraction,
        "op11_token_alignment": op11_token_alignment,
        "op12_source_divergence": op12_source_divergence,
        "op13_warc": op13_warc,
    }


def llm_oracles() -> dict[str, str]:
    """DuckDB SQL for the operators that SQL can express."""
    return dict(oracle.SQL)
