"""Document fingerprints: bottom-k sketches of shingle hashes, in Spark SQL functions only.

A fingerprint is the sorted array of the ``k`` smallest distinct 64-bit hashes of a text's word
shingles. Two fingerprints of the same ``k`` merge into that of the joined shingle sets, and
give unbiased estimates of resemblance, containment and the number of distinct shingles. Texts with
at most ``k`` shingles are compared exactly.

Defined results: a null or empty text has an empty fingerprint; a text with fewer words than a
shingle has its whole sequence as one; two empty fingerprints resemble each other fully, an empty
and another one not at all; repeated rows have equal fingerprints; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
K = 128
#: Rows sorted together when the next row in id order is looked up, and the most such buckets.
BUCKET_ROWS = 2000
MAX_BUCKETS = 100_000
#: Cells of about equally many rows that ids are cut into before the buckets.
CELLS = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def shingle_hashes(text: Column, size: int = SHINGLE_WORDS) -> Column:
    """Hashes of all word windows of a text, repeats included."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def windows(h: Column) -> Column:
        whole = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        each = F.transform(
            F.slice(h, 1, F.greatest(F.size(h) - F.lit(size - 1), F.lit(0))),
            lambda first, i: F.xxhash64(first, *[F.get(h, i + j) for j in range(1, size)]),
        )
        return F.when(F.size(h) < size, whole).otherwise(each)

    return let(F.transform(words, lambda w: F.xxhash64(w)), windows)


def bottom(hashes: Column, k: int = K) -> Column:
    """The ``k`` smallest distinct values in order."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def fingerprint(text: Column, k: int = K, size: int = SHINGLE_WORDS) -> Column:
    return bottom(shingle_hashes(text, size), k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The fingerprint of both shingle sets together."""
    return bottom(F.concat(a, b), k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Shared shingles as a share of all, estimated from the smallest hashes of the union."""
    return let(
        F.struct(merge(a, b, k).alias("u"), F.array_intersect(a, b).alias("both")),
        lambda s: F.when(
            F.size(s["u"]) > 0,
            F.size(F.array_intersect(s["u"], s["both"])).cast("double") / F.size(s["u"]),
        ).otherwise(F.lit(1.0)),
    )


def distinct_shingles(a: Column, k: int = K) -> Column:
    """How many distinct shingles: exact below ``k``, else from the largest hash kept."""
    width = F.element_at(a, -1) / F.lit(2.0**64) + 0.5
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / width)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The share of ``a``'s shingles that ``b`` has too; 1 for an empty ``a``."""
    shared = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """Sixteen hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def with_fingerprint(
    docs: DataFrame, text_col: str = "text", into: str = "fingerprint", k: int = K, size: int = SHINGLE_WORDS
) -> DataFrame:
    return docs.withColumn(into, fingerprint(F.col(text_col), k, size))


def merge_by(parts: DataFrame, keys: list[str], fingerprint_col: str = "fingerprint", k: int = K) -> DataFrame:
    """One fingerprint per key from those of its parts.

    Hashes are made distinct and cut to the ``k`` smallest of a key in each task before they are
    shuffled, so a key with any number of parts sends ``k`` rows per task.
    """
    smallest = Window.partitionBy(*keys).orderBy("fingerprint_hash")
    return (
        parts.select(*keys, F.explode_outer(fingerprint_col).alias("fingerprint_hash"))
        .withColumn("fingerprint_rank", F.dense_rank().over(smallest))
        .filter(F.col("fingerprint_rank") <= k + 1)  # a null, from an empty part, takes a rank
        .groupBy(*keys)
        .agg(bottom(F.collect_set("fingerprint_hash"), k).alias(fingerprint_col))
    )


def with_next(
    rows: DataFrame,
    id_col: str,
    text_col: str,
    columns: list[str],
    derive: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Add ``next``: the given columns of the row that follows by id, or of the first row after the last.

    Equal ids follow each other by text hash, null ids come first. Rows are dealt into buckets of
    adjoining ids, each with a copy of the row that opens the next one, so each row is shuffled once
    and no task sorts more than a bucket. Buckets are cells of equally many rows cut evenly by id, and null ids are cut
    by text hash, so ids far from the others do not widen a bucket. ``derive`` adds columns to all rows before that, once.
    """
    order = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"))
    shares = [i / CELLS for i in range(CELLS + 1)]
    cuts, named, count = rows.agg(F.percentile_approx(id_col, shares, 20 * CELLS), F.count(id_col), F.count("*")).first()
    buckets = max(1, min(MAX_BUCKETS, count // BUCKET_ROWS))
    keyed = rows.select("*", order.alias("next_order"))
    keyed = keyed.withColumn("next_bucket", _bucket(id_col, sorted(set(cuts or [0])), buckets, named, count))

    firsts = keyed.groupBy("next_bucket").agg(F.min("next_order").alias("first"))
    by_bucket = Window.orderBy("next_bucket")
    opening = firsts.select(
        F.col("next_bucket").alias("closes"),
        F.coalesce(
            F.lead("first").over(by_bucket),
            F.first("first").over(by_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("opens"),
    )
    openers = (
        # One row per bucket, so at most MAX_BUCKETS of them are broadcast.
        keyed.join(F.broadcast(opening), F.col("next_order").eqNullSafe(F.col("opens")))
        .drop("next_bucket", "opens")
        .withColumnRenamed("closes", "next_bucket")
        .dropDuplicates(["next_bucket"])
        .withColumn("next_opens", F.lit(True))
    )
    within = Window.partitionBy("next_bucket").orderBy("next_opens", "next_order")
    return (
        derive(keyed.withColumn("next_opens", F.lit(False)).unionByName(openers))
        .withColumn("next", F.lead(F.struct(*columns)).over(within))
        .filter(~F.col("next_opens"))
        .drop("next_opens", "next_bucket", "next_order")
    )


def _bucket(id_col: str, cuts: list, buckets: int, named: int, count: int) -> Column:
    """The number of a row's bucket, in the order of ids and text hashes; negative ones are for null ids."""
    share = F.col("next_order.hash") / F.lit(2.0**64) + 0.5
    nameless = max(1, buckets * (count - named) // max(count, 1))
    of_null = F.least(F.floor(share * nameless), F.lit(nameless - 1)) - nameless
    if len(cuts) == 1:
        return F.when(F.col(id_col).isNull(), of_null).otherwise(F.lit(0)).cast("long")
    bounds = F.array(*map(F.lit, cuts))
    cell = F.greatest(F.size(F.filter(bounds, lambda cut: cut <= F.col(id_col))), F.lit(1))
    cell = F.least(cell, F.lit(len(cuts) - 1))
    inner = max(1, -(-buckets // (len(cuts) - 1)))
    low, high = F.element_at(bounds, cell), F.element_at(bounds, cell + 1)
    inside = F.floor((F.col(id_col) - low) * F.lit(float(inner)) / (high - low))
    inside = F.least(F.greatest(inside, F.lit(0)), F.lit(inner - 1))
    return F.when(F.col(id_col).isNull(), of_null).otherwise((cell - 1) * inner + inside).cast("long")


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint against that of its edited text and of the next document.

    The edited text has its last half replaced by the first half as many code points of the next.
    """
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    n = F.char_length("body")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left(F.col("body"), n - half), F.left(F.col("next.body"), half))
    return (
        with_next(rows, id_col, "body", ["body", "print"], lambda rows: with_fingerprint(rows, "body", "print"))
        .select(id_col, n.cast("long").alias("n_chars"), "print", F.col("next.print").alias("next_print"), edited.alias("edited"))
        .select("*", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("edited")).alias("edited_print"))
        .select(
            id_col,
            "n_chars",
            "edited_sha256",
            as_text(F.col("print")).alias("fingerprint"),
            as_text(F.col("edited_print")).alias("edited_fingerprint"),
            resemblance(F.col("print"), F.col("edited_print")).alias("near_edited"),
            resemblance(F.col("print"), F.col("next_print")).alias("near_next"),
            distinct_shingles(F.col("print")).alias("n_shingles"),
            containment(F.col("print"), F.col("edited_print")).alias("contained_in_edited"),
        )
    )
