"""Secret scans with corpus-wide ownership, in DataFrame functions only.

Patterns give candidate spans in each text. The hash of each candidate's value is counted over the
whole corpus by distinct owner and repository: a value in many places is an example that people copy,
one with few owners looks live. Spans of the base kinds are always reported; the further kinds only
where the value looks live.

Texts never leave the task that scans them; what is shuffled is one short row per span, and counts
by owner are combined before they are shuffled, so a value copied into a third of all texts costs no
more than any other. Values are kept as hashes only.

Defined results: a null or empty text has no spans; null owners count as one owner; repeated rows
are reported one by one; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm.tables import stored

#: Pattern of each base kind, in the order in which spans that start together are listed.
BASE = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
MIN_ASSIGNED = 6
MORE = {
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "web_token": r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}",
    "issued": r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9_-]{20,}|AIza[0-9A-Za-z_-]{35})",
    "login": r"://[^\s:/@]++:[^\s:/@]{6,}+@",
}
KINDS = [*BASE, *MORE]
#: A value with this many owners or repositories is a copied example.
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 5


def _matches(text: Column, kind: str, pattern: str) -> Column:
    """Each match with the number of code points between it and the match before."""
    group = F.lit(2 if kind == "assign" else 0)
    found = F.arrays_zip(
        F.split(text, pattern, -1).alias("before"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), group).alias("value"),
    )
    rows = F.transform(
        F.filter(found, lambda m: m["hit"].isNotNull()),
        lambda m, i: F.struct(
            F.lit(KINDS.index(kind)).alias("rank"),
            i.alias("number"),
            F.char_length(m["before"]).alias("gap"),
            F.char_length(m["hit"]).alias("width"),
            F.char_length(m["value"]).alias("value_width"),
            F.sha2(m["value"], 256).alias("value_hash"),
        ),
    )
    nothing = F.array().cast(
        "array<struct<rank:int,number:int,gap:int,width:int,value_width:int,value_hash:string>>"
    )
    return F.when(text.rlike(pattern), rows).otherwise(nothing)


def candidates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner: Column | None = None,
    repository: Column | None = None,
) -> DataFrame:
    """One row per candidate span, and one with null columns for a text without any."""
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", "source", "lang") if repository is None else repository
    text = F.coalesce(F.col(text_col), F.lit(""))
    every = F.concat(*[_matches(F.col("body"), k, p) for k, p in {**BASE, **MORE}.items()])
    rows = (
        docs.select(
            F.col(id_col),
            F.monotonically_increasing_id().alias("row_key"),
            F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
            F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
            text.alias("body"),
        )
        .select(id_col, "row_key", "owner", "repository", F.explode_outer(every).alias("span"))
        .select(id_col, "row_key", "owner", "repository", "span.*")
    )
    before = Window.partitionBy("row_key", "rank").orderBy("number")
    end = F.sum(F.col("gap") + F.col("width")).over(before.rowsBetween(Window.unboundedPreceding, 0))
    return (
        rows.withColumn("end", end)
        .withColumn("start", F.col("end") - F.col("width"))
        .withColumn(
            "value_hash",
            F.when((F.col("rank") != KINDS.index("assign")) | (F.col("value_width") >= MIN_ASSIGNED), F.col("value_hash")),
        )
        .select(id_col, "row_key", "owner", "repository", "rank", "start", "end", "value_hash")
    )


def ownership(spans: DataFrame) -> DataFrame:
    """How many owners and repositories have each value."""
    return (
        spans.filter("value_hash IS NOT NULL")
        .groupBy("value_hash", "owner", "repository")
        .agg(F.count("*").alias("copies"))
        .groupBy("value_hash", "owner")
        .agg(F.count("*").alias("repositories"), F.sum("copies").alias("copies"))
        .groupBy("value_hash")
        .agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("copies").alias("copies"))
        .withColumn(
            "example",
            (F.col("owners") >= EXAMPLE_OWNERS) | (F.col("repositories") >= EXAMPLE_REPOSITORIES),
        )
    )


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner: Column | None = None,
    repository: Column | None = None,
) -> DataFrame:
    """One row per document with its spans: arrays of kind, place, owners of the value and verdict."""
    spans = stored(candidates(docs, id_col, text_col, owner, repository), "secret-spans")
    known = ownership(spans).select(F.col("value_hash").alias("join_key"), "owners", "example")
    # Rows without a value get a key of their own, or they would all meet in one task.
    joined = spans.withColumn("join_key", F.coalesce("value_hash", F.col("row_key").cast("string"))).join(
        known, "join_key", "left"
    )
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("rank") + 1)
    reported = F.col("value_hash").isNotNull() & ((F.col("rank") < len(BASE)) | ~F.col("example"))
    span = F.struct("start", "rank", "end", kind.alias("kind"), "owners", "example")
    return joined.groupBy("row_key", id_col).agg(
        F.sort_array(F.collect_list(F.when(reported, span))).alias("spans")
    ).drop("row_key")


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def summary(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, digest and list of each document's spans."""

    def count(test) -> Column:
        return F.size(F.filter("spans", test)).cast("long")

    def of_kind(kind: str):
        return lambda s: s["kind"] == kind

    return scanned.select(
        id_col,
        *[count(of_kind(k)).alias(f"n_{k}") for k in BASE],
        F.sha2(listed(F.filter("spans", lambda s: s["rank"] < len(BASE))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        count(lambda s: ~s["example"]).alias("n_live"),
        count(lambda s: s["example"]).alias("n_example"),
    )
