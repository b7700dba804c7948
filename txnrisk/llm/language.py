"""Language identification: multinomial naive Bayes over hashed character n-grams.

Fitting counts n-grams of a bounded sample of labelled texts, ``SAMPLE_PER_LANGUAGE`` expected
rows of each language taken by a hash of the id; the counts come to the driver as one dense matrix
of at most ``CLASS_BLOCK`` rows by ``BUCKETS`` at a time, so its size is fixed. Scoring
broadcasts one block of log probabilities after another, whatever the number of languages; each
pass adds a block's scores to a running best and a running sum.

Letters are lower-cased, and every run of other characters counts as one space. A text of more than ``LONG_BLOCK`` bytes is
worked on block by block, so it needs little more memory than itself.

Defined results: a null text or one without a letter is ``und`` with score 0, and so is every text
when there is nothing to learn from; rows with a null language or id teach nothing; repeated rows
are predicted alike; extra columns are ignored by fitting and scoring.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.words import buffers, slices, worker_cache

BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
SMOOTHING = 0.1
SAMPLE_PER_LANGUAGE = 20_000
CLASS_BLOCK = 64
UNDETERMINED = "und"
SLICE = 1 << 20
#: Bytes of a long text that are worked on at a time, and where a block may end.
LONG_BLOCK = 1 << 20
WORD_END = re.compile(rb"[\x09-\x0D\x20]")


def _letters() -> np.ndarray:
    """Which code points are letters."""
    cache = worker_cache()
    if "letters" not in cache:
        cache["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return cache["letters"]


def _normal(parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of each text as a space, its letters with one space between words, and a space; with the text of each.

    Also whether each text has a letter.
    """
    codes = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")
    document = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    letter = _letters()[codes]
    has_letter = np.bincount(document[letter], minlength=len(parts)) > 0
    before = np.zeros(len(codes), bool)
    before[1:] = letter[:-1] & (document[1:] == document[:-1])
    keep = letter | before
    codes = np.where(letter, codes, 32)[keep]
    document = document[keep]
    heads = np.flatnonzero(np.diff(document, prepend=-1))
    return np.insert(codes, heads, 32), np.insert(document, heads, document[heads]), has_letter


def _hashed(codes: np.ndarray, first: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of each order the buckets of the n-grams that begin among the first codes."""
    value = np.zeros(len(codes), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        value = value[: max(0, len(codes) - order + 1)] * np.uint64(0x100000001B3) + codes[order - 1 :].astype(np.uint64)
        if order in ORDERS:
            mixed = (value[:first] + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
            yield order, (mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and document of every n-gram, and whether each document has a letter."""
    data, offsets = buffers(texts)
    raw = data.tobytes()
    parts = [raw[a:b].decode().lower() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    codes, document, has_letter = _normal(parts)
    buckets, owners = [], []
    for order, bucket in _hashed(codes, len(codes)):
        inside = document[: len(bucket)] == document[order - 1 :]
        buckets.append(bucket[inside])
        owners.append(document[: len(bucket)][inside])
    return np.concatenate(buckets), np.concatenate(owners), has_letter


def long_grams(text: bytes) -> Iterator[np.ndarray]:
    """The buckets of all n-grams of one long text, a block of it at a time; nothing if it has no letter.

    Blocks end behind white space, so no word is cut, and each begins with the last codes of the one before.
    """
    tail, at, reach = np.zeros(0, np.uint32), 0, max(ORDERS) - 1
    while at < len(text):
        end = min(len(text), at + LONG_BLOCK)
        if end < len(text):
            found = WORD_END.search(text, end)
            end = found.end() if found else len(text)
        codes = _normal([text[at:end].decode().lower()])[0].astype(np.uint32)
        at = end
        if len(tail) and len(codes) and tail[-1] == 32:
            codes = codes[1:]  # the space that begins the block is the one that ended the last
        codes = np.concatenate((tail, codes))
        # N-grams that reach into the next block are left to it.
        first = len(codes) if at == len(text) else max(0, len(codes) - reach)
        for _, bucket in _hashed(codes, first):
            yield bucket
        tail = codes[first:]


def sample(docs: DataFrame, lang_col: str, id_col: str, per_language: int) -> DataFrame:
    """About ``per_language`` rows of each language, chosen by a hash of the id."""
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    sizes = labelled.groupBy(lang_col).count().filter(F.col("count") > per_language).collect()
    chance = F.lit(1.0)
    for row in sizes:
        chance = F.when(F.col(lang_col) == row[0], F.lit(per_language / row[1])).otherwise(chance)
    drawn = F.pmod(F.xxhash64(F.lit(17), F.col(id_col).cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return labelled.filter(drawn < chance)


def count_grams(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """How often each bucket occurs in each language, and per language the rows (bucket -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, text_col, SLICE):
                labels, codes = np.unique(np.array(part.column(lang_col).to_pylist(), object), return_inverse=True)
                if (long := _long_text(part, text_col)) is not None:
                    found = np.zeros(BUCKETS + 1, np.int64)
                    for bucket in long_grams(long):
                        found[1:] += np.bincount(bucket, minlength=BUCKETS)
                    found[0] = 1
                    totals[labels[0]] = totals.get(labels[0], 0) + found
                    continue
                bucket, owner, _ = grams(part.column(text_col))
                for i, label in enumerate(labels):
                    found = np.bincount(bucket[codes[owner] == i] + 1, minlength=BUCKETS + 1)
                    found[0] = (codes == i).sum()
                    totals[label] = totals.get(label, 0) + found
                if len(totals) > CLASS_BLOCK:
                    yield from _rows(totals)
                    totals = {}
        yield from _rows(totals)

    return (
        docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias(text_col))
        .withColumnRenamed("lang", lang_col)
        .mapInArrow(run, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )


def _rows(totals: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for label, counts in totals.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([label] * len(at), pa.string()), pa.array((at - 1).astype(np.int32)), pa.array(counts[at])],
            ["lang", "bucket", "n"],
        )


class LanguageModel:
    """Log probabilities by language and bucket, in blocks of at most ``CLASS_BLOCK`` languages."""

    def __init__(self, blocks: list[tuple[list[str], np.ndarray, np.ndarray]]):
        self.blocks = blocks

    @property
    def languages(self) -> list[str]:
        return [name for names, _, _ in self.blocks for name in names]


def fit(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    id_col: str = "doc_id",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> LanguageModel:
    """Learn from all rows of ``docs``, or from a sample of the frequent languages."""
    columns = docs.select(F.col(id_col).alias("row_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("body"))
    counts = count_grams(sample(columns, "lang", "row_id", per_language), "lang", "body").persist()
    try:
        sizes = dict(counts.filter("bucket = -1").orderBy("lang").select("lang", "n").collect())
        names, blocks = sorted(sizes), []
        rows = sum(sizes.values())
        for start in range(0, len(names), CLASS_BLOCK):
            block = names[start : start + CLASS_BLOCK]
            found = counts.filter(F.col("lang").isin(block) & (F.col("bucket") >= 0)).toPandas()
            matrix = np.full((len(block), BUCKETS), SMOOTHING, np.float64)
            matrix[found["lang"].map({n: i for i, n in enumerate(block)}), found["bucket"]] += found["n"]
            matrix = np.log(matrix / matrix.sum(axis=1, keepdims=True)).astype(np.float32)
            prior = np.array([math.log(sizes[name] / rows) for name in block])
            blocks.append((block, prior, matrix))
        return LanguageModel(blocks)
    finally:
        counts.unpersist()


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``, the probability of that language among the learned ones."""
    spark = docs.sparkSession
    kept = docs.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    state = docs.withColumns(
        {
            "lang_pred": F.lit(None).cast("string"),
            "best_log": F.lit(float("-inf")),
            "sum_log": F.lit(float("-inf")),
        }
    )
    for names, prior, matrix in model.blocks:
        shared = spark.sparkContext.broadcast((names, prior, matrix))
        state = state.mapInArrow(
            _scorer(shared, text_col), f"{fields}, lang_pred string, best_log double, sum_log double"
        )
    sure = F.col("lang_pred").isNotNull()
    return state.select(
        *kept,
        F.coalesce("lang_pred", F.lit(UNDETERMINED)).alias("lang_pred"),
        F.when(sure, F.least(F.lit(1.0), F.exp(F.col("best_log") - F.col("sum_log")))).otherwise(0.0).alias("score"),
    )


def _long_text(part: pa.RecordBatch, text_col: str) -> bytes | None:
    """The text of a batch that is one long text."""
    if part.num_rows != 1 or not part.column(text_col)[0].is_valid:
        return None
    text = part.column(text_col)[0].as_buffer()
    return text.to_pybytes() if text.size > LONG_BLOCK else None


def _scorer(shared, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, prior, matrix = shared.value
        labels = np.array(names, object)
        for batch in batches:
            for part in slices(batch, text_col, SLICE):
                scores = np.empty((len(labels), part.num_rows))
                if (long := _long_text(part, text_col)) is not None:
                    scores[:, 0], has_letter = prior, np.zeros(1, bool)
                    for bucket in long_grams(long):
                        counts = np.bincount(bucket, minlength=BUCKETS)
                        scores[:, 0] += matrix @ counts.astype(np.float64)
                        has_letter |= len(bucket) > 0
                else:
                    bucket, owner, has_letter = grams(part.column(text_col))
                    for i in range(len(labels)):
                        scores[i] = np.bincount(owner, matrix[i][bucket], part.num_rows) + prior[i]
                old = {name: part.column(name) for name in part.schema.names}
                best = old["best_log"].to_numpy(zero_copy_only=False)
                total = old["sum_log"].to_numpy(zero_copy_only=False)
                winner = scores.argmax(axis=0)
                top = scores[winner, np.arange(part.num_rows)]
                better = (top > best) & has_letter
                choice = np.where(better, labels[winner], np.array(old["lang_pred"].to_pylist(), object))
                old["lang_pred"] = pa.array(choice.tolist(), pa.string())
                old["best_log"] = pa.array(np.where(better, top, best))
                old["sum_log"] = pa.array(np.logaddexp(total, np.logaddexp.reduce(scores, axis=0)))
                yield pa.RecordBatch.from_arrays(list(old.values()), list(old))

    return run


def held_out(id_col: str = "doc_id") -> Column:
    """A quarter of the ids, by checksum; never used for fitting by ``op4_language_id``."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
