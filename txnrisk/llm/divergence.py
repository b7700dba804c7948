"""Source divergence audit: how the word use of each source of a language differs from the others'.

Terms are runs of ASCII letters and characters beyond ASCII, ``A-Z`` lower-cased. A language keeps the
terms that at least ``least_docs`` of its documents have; they are found by iceberg prefix refinement.

1. Every level cuts terms to a byte prefix, of ``FIRST_BYTES`` bytes first and twice as many each time, and
   counts the distinct documents of each prefix. A prefix below the threshold is discarded with everything that
   begins with it, so rare terms, which are most of all terms, are never counted as a whole.
2. A term no longer than the prefix is complete: kept, or discarded. The rest goes on to the next level,
   until none is left.

Kept prefixes travel to the next level as a bitmap of ``FILTER_BITS`` bits for any number of them. A false hit costs
one more counted prefix and changes nothing, as each level counts exactly what it lets through. Counts are
combined in each task before they are shuffled, so a frequent prefix sends one row a task.

Shares ``p`` of kept terms are smoothed and scaled to whole numbers, and all arithmetic is exact. Pairs of
sources are compared in blocks of sources and shards of terms: only terms that occur in one of the sources
are looked at, all others have the same value for a pair.

Defined results: null text, language and source count as ''; every row is a document, repeated rows and null
ids too; a document without terms still makes its group occur; a language without kept terms has pairs of value
0; ties are ranked by item in UTF-8 order; extra columns are ignored; an empty table gives an empty result. Texts are
worked on whole, about a megabyte of them at a time; a longer text by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm.tables import bound_batches, stored
from txnrisk.llm.words import LOWER, Spans, buffers, mix, slices

LEAST_DOCS = 10
FIRST_BYTES = 4
FILTER_BITS = 1 << 24
#: Rows that a task combines before it sends them on.
COMBINED_ROWS = 1 << 20
#: Terms of a shard and sources of a block, which bound the matrix one task holds.
SHARD_TERMS = 4096
BLOCK_SOURCES = 32
SCALE = 1_000_000_000

IN_TERM = np.zeros(256, bool)
IN_TERM[97:123] = True
IN_TERM[128:] = True


class Terms:
    """All terms of a batch of texts: their bytes in a row, their lengths and the document of each."""

    def __init__(self, texts: pa.Array):
        data, offsets = buffers(texts)
        data = LOWER[data]
        inside = IN_TERM[data]
        open_ = np.zeros(len(data) + 1, bool)  # a term begins, or one has just ended
        open_[1:-1] = inside[1:] != inside[:-1]
        open_[0], open_[-1] = inside[:1].any(), inside[-1:].any()
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        joined = np.unique(cuts[inside[cuts] & inside[cuts - 1]])  # terms that touch across documents
        bounds = np.sort(np.concatenate((np.flatnonzero(open_), joined, joined)))
        self.starts, ends = bounds[0::2], bounds[1::2]
        self.data = data
        self.sizes = ends - self.starts
        self.doc = np.searchsorted(offsets, self.starts, "right") - 1

    def prefixes(self, chosen: np.ndarray, size: int | None) -> pa.Array:
        """The first ``size`` bytes of each chosen term, all bytes without a size."""
        sizes = self.sizes[chosen] if size is None else np.minimum(self.sizes[chosen], size)
        ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))
        at = np.arange(ends[-1]) + np.repeat(self.starts[chosen] - ends[:-1], sizes)
        return pa.Array.from_buffers(
            pa.large_binary(), len(chosen), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(self.data[at]))]
        )


def _bits(langs: list[str], lang: np.ndarray, values: pa.Array, code: np.ndarray, size: int | None) -> np.ndarray:
    """The bit of each pair of a language and the first ``size`` bytes of a value, both given by number."""
    values = values.cast(pa.large_binary())
    _, offsets, data = values.buffers()
    ends = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    last = ends[1:] if size is None else np.minimum(ends[1:], ends[:-1] + size)
    value_hash = Spans(raw).hash(ends[:-1], last)
    lang_hash = np.array([int.from_bytes(hashlib.md5(name.encode()).digest()[:8]) for name in langs], np.uint64)
    return (mix(value_hash[code] ^ lang_hash[lang]) % np.uint64(FILTER_BITS)).astype(np.int64)


def _bitmap(prefixes: DataFrame) -> bytes:
    """A bitmap with a bit set for every row of ``lang``, ``prefix``; of the same size for any number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "prefix"):
                lang = part.column("lang").dictionary_encode()
                every = np.arange(part.num_rows)
                bits = _bits(lang.dictionary.to_pylist(), lang.indices.to_numpy(), part.column("prefix"), every, None)
                yield pa.RecordBatch.from_arrays([pa.array(bits + 1)], ["bit"])

    bit = F.col("bit")
    rows = (
        prefixes.select("lang", "prefix")
        .mapInArrow(run, "bit long")
        .groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
        .collect()
    )
    size = 4096  # bytes of one of Spark's bitmaps
    found = bytearray(FILTER_BITS // 8 + size)
    for row in rows:
        found[(row["bucket"] - 1) * size : row["bucket"] * size] = row["bits"]
    return bytes(found)


def _is_set(bitmap: bytes, bits: np.ndarray) -> np.ndarray:
    return (np.frombuffer(bitmap, np.uint8)[bits >> 3] >> (bits & 7).astype(np.uint8) & 1).astype(bool)


def _combined(batches: Iterator[pa.RecordBatch], keys: list[str], count: str) -> Iterator[pa.RecordBatch]:
    """The batches with equal keys summed, as far as ``COMBINED_ROWS`` rows at a time go."""
    held, rows = [], 0

    def summed(table: pa.Table) -> pa.Table:
        return table.group_by(keys).aggregate([(count, "sum")]).rename_columns([*keys, count])

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows > COMBINED_ROWS:
            table = summed(pa.Table.from_batches(held))
            if table.num_rows > COMBINED_ROWS // 2:  # little repeats: hold no more of it
                yield from table.to_batches()
                held, rows = [], 0
            else:
                held, rows = table.to_batches(), table.num_rows
    if held:
        yield from summed(pa.Table.from_batches(held)).to_batches()


def _level(docs: DataFrame, size: int, parents, least: int) -> DataFrame:
    """``lang``, ``prefix`` and ``complete`` of the prefixes that enough documents have.

    ``parents`` is the broadcast bitmap of the kept prefixes of half the size, if there is a level before.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                terms = Terms(part.column("body"))
                chosen = np.arange(len(terms.sizes)) if parents is None else np.flatnonzero(terms.sizes > size // 2)
                if not len(chosen):
                    continue
                lang = part.column("lang").dictionary_encode()
                lang_of, langs = lang.indices.to_numpy(), lang.dictionary.to_pylist()
                found = terms.prefixes(chosen, size).dictionary_encode()
                code = found.indices.to_numpy().astype(np.int64) * 2 + (terms.sizes[chosen] <= size)
                width = 2 * len(found.dictionary)
                # Each prefix once a document, then the documents of each language.
                once = np.unique(terms.doc[chosen] * width + code)
                key, docs_with = np.unique(lang_of[once // width] * width + once % width, return_counts=True)
                lang_at, code = key // width, key % width
                if parents is not None:
                    hit = _is_set(parents.value, _bits(langs, lang_at, found.dictionary, code // 2, size // 2))
                    lang_at, code, docs_with = lang_at[hit], code[hit], docs_with[hit]
                yield pa.RecordBatch.from_arrays(
                    [
                        lang.dictionary.take(pa.array(lang_at)),
                        found.dictionary.take(pa.array(code // 2)).cast(pa.binary()),
                        pa.array(code % 2 == 1),
                        pa.array(docs_with.astype(np.int64)),
                    ],
                    ["lang", "prefix", "complete", "docs"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _combined(counted(batches), ["lang", "prefix", "complete"], "docs")

    rows = docs.select("lang", "body").mapInArrow(run, "lang string, prefix binary, complete boolean, docs long")
    enough = rows.groupBy("lang", "prefix", "complete").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= least)
    return enough.drop("docs")


def kept_terms(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """``lang`` and ``term`` (binary) of the terms that ``least`` documents of a language have.

    ``docs`` has ``lang`` and ``body``, neither of them null.
    """
    context = docs.sparkSession.sparkContext
    size, parents, complete = FIRST_BYTES, None, []
    while True:
        found = stored(_level(docs, size, parents, least), "prefixes")
        complete.append(found.filter("complete").select("lang", F.col("prefix").alias("term")))
        open_ = found.filter("NOT complete")
        if open_.isEmpty():
            break
        parents, size = context.broadcast(_bitmap(open_)), 2 * size
    result = complete[0]
    for more in complete[1:]:
        result = result.unionByName(more)
    return result


def term_counts(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term`` and ``n``, how often the source's documents have each kept term they have."""
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(kept.withColumnRenamed("term", "prefix")))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                terms = Terms(part.column("body"))
                if not len(terms.sizes):
                    continue
                group = pa.StructArray.from_arrays([part.column("lang"), part.column("source")], ["lang", "source"])
                names, group_of = _distinct(group)
                found = terms.prefixes(np.arange(len(terms.sizes)), None).dictionary_encode()
                width = len(found.dictionary)
                key, n = np.unique(group_of[terms.doc] * width + found.indices.to_numpy(), return_counts=True)
                group_at, code = key // width, key % width
                langs = names.field("lang").to_pylist()
                hit = _is_set(bitmap.value, _bits(langs, group_at, found.dictionary, code, None))
                name = names.take(pa.array(group_at[hit]))
                yield pa.RecordBatch.from_arrays(
                    [
                        name.field("lang"),
                        name.field("source"),
                        found.dictionary.take(pa.array(code[hit])).cast(pa.binary()),
                        pa.array(n[hit].astype(np.int64)),
                    ],
                    ["lang", "source", "term", "n"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _combined(counted(batches), ["lang", "source", "term"], "n"):
            rows = pa.Table.from_batches([batch]).group_by(["lang", "term"], use_threads=False)
            yield from rows.aggregate([("source", "list"), ("n", "list")]).rename_columns(["lang", "term", "sources", "ns"]).to_batches()

    # A term travels once a task with the sources that have it, and all of it meets by language and term.
    rows = docs.mapInArrow(run, "lang string, term binary, sources array<string>, ns array<long>")
    rows = rows.repartition("lang", "term").select("lang", "term", F.inline(F.arrays_zip("sources", "ns")))
    sums = rows.groupBy("lang", "sources", "term").agg(F.sum("ns").alias("n"))
    return sums.join(kept, ["lang", "term"], "left_semi").select("lang", F.col("sources").alias("source"), "term", "n")


def _distinct(rows: pa.StructArray) -> tuple[pa.StructArray, np.ndarray]:
    """The different rows of a struct array, and which of them each row is."""
    seen: dict[tuple, int] = {}
    at = np.fromiter((seen.setdefault(tuple(r.values()), len(seen)) for r in rows.to_pylist()), np.int64, len(rows))
    first = np.unique(at, return_index=True)[1]
    return rows.take(pa.array(first)), at


def share(n: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(SCALE * (n + 2) / (total + 2 * kept))``, exact for any counts; null without kept terms."""
    below = total + kept * 2
    narrow = F.call_function("div", (n + 2) * SCALE, F.nullif(below, F.lit(0)))
    above = F.lit(SCALE).cast("decimal(38,0)") * (n.cast("decimal(20,0)") + 2)
    wide = F.call_function("div", above, F.nullif(below.cast("decimal(20,0)"), F.lit(0)))
    return F.lit(1) + F.when(n < SCALE, narrow).otherwise(wide)


def gap(p, q):
    """How far apart two shares are; of columns of Spark."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_sums(rows: DataFrame) -> DataFrame:
    """Sums of gaps over the terms of each unit, less those of the terms' absence, for both orders of a pair.

    ``rows`` has ``lang``, ``shard``, ``a``, ``b`` (the unit), ``block``, ``source``, ``term`` and ``p``; a row with a null
    term gives the share of absent terms, and every source of the unit has one.
    """

    def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) * (p - q) // (p + q)

    def run(key: tuple, unit: pd.DataFrame) -> pd.DataFrame:
        lang, _, first, second = key
        base = unit[unit["term"].isna()].sort_values("source")
        names = base["source"].to_numpy()
        absent, block = base["p"].to_numpy(np.int64), base["block"].to_numpy()
        present = unit[unit["term"].notna()]
        column, terms = pd.factorize(present["term"])
        shares = np.repeat(absent[:, None], len(terms), axis=1)
        shares[np.searchsorted(names, present["source"].to_numpy()), column] = present["p"].to_numpy(np.int64)
        found = []
        for i in np.flatnonzero(block == first):
            others = np.flatnonzero((block == second) & ((names > names[i]) if first == second else True))
            sums = gaps(shares[i], shares[others]).sum(axis=1) - gaps(absent[i], absent[others]) * len(terms)
            for j, value in zip(others, sums.tolist()):
                found += [(lang, names[i], names[j], value), (lang, names[j], names[i], value)]
        return pd.DataFrame(found, columns=["lang", "source", "item", "part_sum"])

    schema = "lang string, source string, item string, part_sum long"
    return rows.groupBy("lang", "shard", "a", "b").applyInPandas(run, schema)


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least: int = LEAST_DOCS,
    top: int = 10,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    Part ``pair`` ranks all other sources of the language by the sum of gaps, part ``term`` the ``top`` terms that
    the source has more often than the language as a whole.
    """
    bound_batches(docs.sparkSession)
    empty = F.lit("")
    docs = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), empty).alias("lang"),
        F.coalesce(F.col(source_col).cast("string"), empty).alias("source"),
        F.coalesce(F.col(text_col), empty).alias("body"),
    )
    kept = stored(kept_terms(docs, least), "kept-terms")
    counts = stored(term_counts(docs, kept), "term-counts")

    sizes = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = (
        docs.select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("kept", zero).alias("kept"))
    )
    groups = groups.withColumn("absent", F.coalesce(share(zero, F.col("total"), F.col("kept")), F.lit(1)))
    groups = stored(groups, "groups")

    mine = share(F.col("n"), F.col("total"), F.col("kept")).alias("p")
    shares = counts.join(groups.drop("absent"), ["lang", "source"]).select("lang", "source", "term", "n", mine, "kept")
    pairs = _pairs(groups, shares)

    lang_totals = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    in_lang = Window.partitionBy("lang", "term")
    whole = share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q")
    terms = (
        shares.withColumn("lang_n", F.sum("n").over(in_lang))
        .join(lang_totals, "lang")
        .select("lang", "source", F.col("term").cast("string").alias("item"), "p", whole)
        .filter("p > q")
        .select("lang", "source", F.lit("term").alias("part"), "item", gap(F.col("p"), F.col("q")).alias("value"))
    )
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    ranked = terms.withColumn("rank", rank).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", rank).unionByName(ranked)


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """The summed gaps of all ordered pairs of sources of a language."""
    wide = groups.groupBy("lang").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    blocks = -(-wide // BLOCK_SOURCES)
    shard_count = F.greatest(F.ceil(F.col("kept") / SHARD_TERMS), F.lit(1)).cast("int")
    block = F.pmod(F.xxhash64("source"), F.lit(blocks)).cast("int")
    null = F.lit(None).cast("binary")
    absent = groups.filter("kept > 0").select(
        "lang", "source", null.alias("term"), F.col("absent").alias("p"),
        F.explode(F.sequence(F.lit(0), shard_count - 1)).alias("shard"),
    )
    present = shares.select("lang", "source", "term", "p", F.pmod(F.xxhash64("term"), shard_count).cast("int").alias("shard"))
    rows = (
        absent.unionByName(present)
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .withColumn("a", F.least("block", "other"))
        .withColumn("b", F.greatest("block", "other"))
    )
    sums = _pair_sums(rows).groupBy("lang", "source", "item").agg(F.sum("part_sum").alias("value"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("absent").alias("other_absent"))
    every = groups.join(other, "lang").filter("source != item")
    nothing = gap(F.col("absent"), F.col("other_absent")) * F.col("kept")
    value = F.when(F.col("kept") > 0, nothing + F.coalesce("value", F.lit(0))).otherwise(F.lit(0).cast("long"))
    return every.join(sums, ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")
    )
