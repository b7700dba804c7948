"""Removing repeated lines, up to one edited word, by a deletion-neighbourhood join.

A line goes if an earlier line of the corpus has the same words, or, from ``edit_from`` words on, differs by
one word inserted, deleted or replaced. Lines are compared by their words, ASCII letters lower-cased; earlier
means a smaller document id, then text hash, then line number. ``edit_from`` is a parameter: one word of a
short line is most of it, so by default lines of fewer than ``EDIT_FROM`` words must be equal.

1. Every line is stored with the hash of its words, of 128 bits, and its place. A line that can lose words also has
   keys of its halves: one edit leaves the words before or those behind the middle as they are, so
   lines within the bound share a key. They are made for the line's own length and for that of a line one shorter.
2. Lines that share a half with a different line are candidates. Each emits a hashed key for itself and for itself without
   each of its words in the other half. Equal keys join lines: a line equals another without one word, or both are equal without the word at the same
   place. No pairs are formed: the earliest line of each key is all that the others must know.
3. The words of both lines of each match are compared, and only matches of at most one edit count.

Candidates are found by a bitmap of the shared keys, some 64 bits for each up to ``MOST_BITS`` in all; a false hit costs keys and
changes nothing. Each batch sends equal lines and keys on once, and a line that very many documents share is answered from a
broadcast table of at most ``HOT_SHARE`` lines. Intermediate tables are deleted as soon as nothing reads them.

Defined results: lines of fewer than ``min_words`` words stay, so with 1 every line that has a word
counts; null and empty texts stay as they
are; a document that loses all its words goes, one that had none stays; rows that repeat both id and
text count as one document and are cut alike, also with a null id; null ids come last; ids may be of any type
that can be ordered; extra columns are kept. If two different lines have the same key by chance, neither is removed for it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm.tables import bound_batches, discard, stored
from txnrisk.llm.words import BASE, INVERSE, LOWER, STEP, Spans, buffers, mix, powers, slices, word_bounds
from txnrisk.sources.files import delete
from txnrisk.sources.tables import scratch_dir

MIN_WORDS = 5
EDIT_FROM = 8
#: Bits of the bitmap of shared halves: the least and the most, and how many for each.
LEAST_BITS = 1 << 20
MOST_BITS = 1 << 28
BITS_EACH = 64
#: Lines that more than this share of all lines repeat are at most as many.
HOT_SHARE = 1000
#: Lines whose words a task has sent on; it starts anew beyond this many.
REMEMBERED_LINES = 1 << 17
WHITE = r"[\x20\x09-\x0D]+"

VARIANT, WITNESS, TEXT = range(3)
WHOLE = -1


class Lines:
    """The lines with enough words of a batch of texts, in order of document and line."""

    def __init__(self, part: pa.RecordBatch, min_words: int):
        data, offsets = buffers(part.column("body"))
        self.data = LOWER[data]
        self.starts, self.ends, bounds = word_bounds(self.data, offsets)
        self.words = Spans(self.data).hash(self.starts, self.ends)
        feeds = np.flatnonzero(self.data == 10)
        # Lines before each word, in the whole batch and at the start of its document.
        line = np.searchsorted(feeds, self.starts)
        document = np.repeat(np.arange(part.num_rows), np.diff(bounds))
        new = np.ones(len(self.starts), bool)
        new[1:] = (line[1:] != line[:-1]) | (document[1:] != document[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(self.starts))
        enough = last - first >= min_words
        first, last = first[enough], last[enough]
        owner = document[first]
        number = line[first] - np.searchsorted(feeds, offsets[owner])
        keys = [("doc", "ascending"), ("text_hash", "ascending")]
        table = pa.Table.from_arrays([part.column("doc"), part.column("text_hash")], ["doc", "text_hash"])
        rank = np.empty(part.num_rows, np.int64)
        rank[pc.sort_indices(table, sort_keys=keys, null_placement="at_end").to_numpy()] = np.arange(part.num_rows)
        order = np.lexsort((number, rank[owner]))
        self.first, self.last, self.owner = first[order], last[order], owner[order]
        self.number = number[order].astype(np.int32)
        self.count = self.last - self.first
        self._part = part
        self._powers, self._inverse = powers(len(self.words) + 1)
        self._sums = self._running(self.words)
        size = self.count.astype(np.uint64) * BASE
        self.hash = mix(self._range(self._sums, self.first, self.last) + size)
        other = self._running(mix(self.words + STEP))
        self.hash2 = mix(self._range(other, self.first, self.last) + size)

    def _running(self, words: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * self._powers[: len(words)], out=sums[1:])
        return sums

    def _range(self, sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (sums[b] - sums[a]) * self._inverse[a]

    def distinct(self, chosen: np.ndarray) -> np.ndarray:
        """Of the chosen lines, the earliest of each content."""
        _, index = np.unique(self.hash[chosen], return_index=True)
        return np.sort(chosen[index])

    def halves(self, chosen: np.ndarray) -> np.ndarray:
        """Four keys of each chosen line: its first and last words, as one of its length and as one that is one longer."""
        first, last, count = self.first[chosen], self.last[chosen], self.count[chosen]
        keys = np.empty((len(chosen), 4), np.uint64)
        for j, length in enumerate((count, count - 1)):
            middle = length // 2
            tag = length.astype(np.uint64) * INVERSE
            keys[:, 2 * j] = mix(self._range(self._sums, first, first + middle) + tag)
            keys[:, 2 * j + 1] = mix(self._range(self._sums, last - (length - middle), last) + tag + STEP)
        return keys

    def variants(self, chosen: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Key, role and line of each chosen line as a whole and without each word that an edit can be at.

        ``shared`` tells which of the four halves another line has: the edit is in the other half.
        """
        count = self.count[chosen]
        low = np.where(shared[:, 1] | shared[:, 3], 0, (count - 1) // 2)
        high = np.where(shared[:, 0] | shared[:, 2], count, np.maximum(count // 2, (count - 1) // 2 + 1))
        size = high - low
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        line = np.repeat(chosen, size)
        a, b = self.first[line], self.last[line]
        word = a + place
        left = (self._sums[word] - self._sums[a]) * self._inverse[a]
        right = (self._sums[b] - self._sums[word + 1]) * self._inverse[a + 1]
        without = mix(left + right + (self.count[line] - 1).astype(np.uint64) * BASE)
        keys = np.concatenate((self.hash[chosen], without))
        roles = np.concatenate((np.full(len(chosen), WHOLE), place))
        return keys, roles, np.concatenate((chosen, line))

    def content(self, line: np.ndarray) -> list[pa.Array]:
        return [pa.array(values[line].astype(np.int64)) for values in (self.hash, self.hash2)]

    def place(self, line: np.ndarray) -> list[pa.Array]:
        owner = pa.array(self.owner[line])
        return [self._part.column("doc").take(owner), self._part.column("text_hash").take(owner), pa.array(self.number[line])]

    def neighbours(self, chosen: np.ndarray, shared: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The earliest line of each key and role; for the others, that line as a witness."""
        keys, roles, line = self.variants(chosen, shared)
        order = np.lexsort((line, roles, keys))
        keys, roles, line = keys[order], roles[order], line[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (roles[1:] != roles[:-1])
        head, rest = np.flatnonzero(new), np.flatnonzero(~new)
        yield self._found(VARIANT, line[head], line[head], line[head], keys[head], roles[head])
        if len(rest):
            earliest = line[head[np.searchsorted(head, rest, "right") - 1]]
            yield self._found(WITNESS, line[rest], earliest, earliest)

    def texts(self, chosen: np.ndarray) -> pa.RecordBatch:
        """The words of lines."""
        raw = self.data.tobytes()
        spans = zip(self.starts[self.first[chosen]].tolist(), self.ends[self.last[chosen] - 1].tolist())
        return self._found(TEXT, chosen, chosen, chosen, words=[raw[a:b].decode() for a, b in spans])

    def _found(self, kind, line, seen, place, key=None, role=None, words=None) -> pa.RecordBatch:
        n = len(line)
        columns = [
            pa.array(np.full(n, kind, np.int32)),
            pa.nulls(n, pa.int64()) if key is None else pa.array(key.astype(np.int64)),
            pa.nulls(n, pa.int32()) if role is None else pa.array(role.astype(np.int32)),
            *self.content(line),
            *self.content(seen),
            *self.place(place),
            pa.nulls(n, pa.string()) if words is None else pa.array(words, pa.string()),
        ]
        names = ["kind", "key", "role", "h1", "h2", "seen1", "seen2", "doc", "text_hash", "line", "words"]
        return pa.RecordBatch.from_arrays(columns, names)


def _all_lines(texts: DataFrame, min_words: int, edit_from: int) -> DataFrame:
    """Every line with its hash and place, and the keys of its halves where a batch has it first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                lines = Lines(part, min_words)
                every = np.arange(len(lines.hash))
                chosen = lines.distinct(every[lines.count >= edit_from])
                sizes = np.zeros(len(every) + 1, np.int32)
                sizes[chosen + 1] = 4
                keys = pa.array(lines.halves(chosen).ravel().astype(np.int64))
                halves = pa.ListArray.from_arrays(pa.array(sizes.cumsum(), pa.int32()), keys)
                columns = [*lines.content(every), *lines.place(every), halves]
                yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "doc", "text_hash", "line", "halves"])

    kind = texts.schema["doc"].dataType.simpleString()
    return texts.mapInArrow(run, f"h1 long, h2 long, doc {kind}, text_hash long, line int, halves array<long>")


def _candidates(texts: DataFrame, shared, edit_from: int) -> DataFrame:
    """Variants, matches inside a batch, and the words of all lines that share a half with another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        size = np.uint64(len(bits) * 8)
        sent: set[int] = set()
        for batch in batches:
            for part in slices(batch, "body"):
                lines = Lines(part, edit_from)
                chosen = lines.distinct(np.arange(len(lines.hash)))
                at = (lines.halves(chosen) % size).astype(np.int64)
                hit = (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
                chosen, hit = chosen[hit.any(axis=1)], hit[hit.any(axis=1)]
                yield from lines.neighbours(chosen, hit)
                new = np.array([i for i in chosen if int(lines.hash[i]) not in sent], np.int64)
                if len(sent) > REMEMBERED_LINES:
                    sent.clear()
                sent.update(lines.hash[new].tolist())
                yield lines.texts(new)

    kind = texts.schema["doc"].dataType.simpleString()
    schema = f"kind int, key long, role int, h1 long, h2 long, seen1 long, seen2 long, doc {kind}, text_hash long, line int, words string"
    return texts.mapInArrow(run, schema)


def _shared_halves(lines: DataFrame) -> bytes:
    """A bitmap of the half keys that two different lines have."""
    keys = (
        lines.select("h1", F.explode("halves").alias("key"))
        .groupBy("key")
        .agg(F.min("h1").alias("least"), F.max("h1").alias("most"))
        .filter("least < most")
        .select("key")
    )
    keys = stored(keys, "shared-halves")
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * keys.count()).bit_length()))
    # Keys are unsigned in the batches, and the size is a power of two.
    bit = F.col("key").bitwiseAND(F.lit(size - 1)) + 1
    rows = (
        keys.groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
        .collect()
    )
    discard(keys)
    found, step = bytearray(size // 8), 4096  # bytes of one of Spark's bitmaps
    for row in rows:
        found[(row["bucket"] - 1) * step : row["bucket"] * step] = row["bits"]
    return bytes(found)


def _place() -> Column:
    return F.struct(F.col("doc").isNull().alias("nameless"), "doc", "text_hash", "line").alias("place")


def _one_edit(a: Column, b: Column) -> Column:
    """Whether two texts differ by at most one word inserted, deleted or replaced."""
    first, second = F.split(a, WHITE), F.split(b, WHITE)
    longer = F.when(F.size(first) >= F.size(second), first).otherwise(second)
    shorter = F.when(F.size(first) >= F.size(second), second).otherwise(first)
    both = F.struct(longer.alias("long"), shorter.alias("short"))

    def check(pair: Column) -> Column:
        long, short = pair["long"], pair["short"]
        apart = F.array_position(F.zip_with(F.slice(long, 1, F.size(short)), short, lambda x, y: x != y), True)
        rest = F.slice(long, apart.cast("int") + 1, F.size(long)) == F.slice(
            short, F.when(F.size(long) == F.size(short), apart + 1).otherwise(apart).cast("int"), F.size(short)
        )
        return (F.size(long) - F.size(short) <= 1) & ((apart == 0) | rest)

    return F.get(F.transform(F.array(both), check), F.lit(0))


def _witnesses(found: DataFrame) -> DataFrame:
    """``h1``, ``h2`` and ``witness``, the earliest place of a line within the bound, for lines that have one earlier."""
    role, key = Window.partitionBy("key", "role"), Window.partitionBy("key")
    whole = F.col("role") == WHOLE
    me = F.struct(_place(), F.col("h1").alias("h1"), F.col("h2").alias("h2")).alias("me")
    matched = (
        found.filter(F.col("kind") == VARIANT)
        .select("key", "role", me)
        .repartition("key")  # serves all three windows
        .withColumn("same", F.min("me").over(role))
        .withColumn("whole", F.min(F.when(whole, F.col("me"))).over(key))
        .withColumn("cut", F.min(F.when(~whole, F.col("me"))).over(key))
        .select("me", F.least("same", F.when(whole, F.col("cut")).otherwise(F.col("whole"))).alias("seen"))
        .filter("seen.place < me.place")
        .select("me.h1", "me.h2", F.col("seen.h1").alias("seen1"), F.col("seen.h2").alias("seen2"), "seen.place")
    )
    inside = found.filter(F.col("kind") == WITNESS).select("h1", "h2", "seen1", "seen2", _place())
    pairs = matched.unionByName(inside).groupBy("h1", "h2", "seen1", "seen2").agg(F.min("place").alias("place"))
    words = found.filter(F.col("kind") == TEXT).groupBy("h1", "h2").agg(F.min("words").alias("words"))
    other = words.select(F.col("h1").alias("seen1"), F.col("h2").alias("seen2"), F.col("words").alias("seen_words"))
    verified = pairs.join(words, ["h1", "h2"]).join(other, ["seen1", "seen2"]).filter(_one_edit(F.col("words"), F.col("seen_words")))
    return verified.groupBy("h1", "h2").agg(F.min("place").alias("witness"))


def repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    edit_from: int = EDIT_FROM,
) -> DataFrame:
    """The numbers of the lines to remove, one row per document that has any: ``doc``, ``text_hash``, ``gone``; stored."""
    spark = docs.sparkSession
    bound_batches(spark)
    texts = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("body"))
    lines = stored(_all_lines(texts, min_words, edit_from), "lines")
    shared = spark.sparkContext.broadcast(_shared_halves(lines))
    path = f"{scratch_dir(spark)}/line-variants-{uuid.uuid4().hex}"
    candidates = _candidates(texts, shared, edit_from)
    candidates.write.partitionBy("kind").parquet(path)
    witnesses = stored(_witnesses(spark.read.schema(candidates.schema).parquet(path)), "witnesses")
    delete(spark, path)

    firsts = lines.groupBy("h1", "h2").agg(F.min(_place()).alias("first"), F.count("*").alias("copies"))
    # Only lines that occur twice or have a near one earlier lose anything.
    near = F.coalesce(F.col("witness") < F.col("first"), F.lit(False)).alias("near")
    verdicts = firsts.join(witnesses, ["h1", "h2"], "left").select("h1", "h2", "first", "copies", near)
    verdicts = stored(verdicts.filter("copies > 1 OR near"), "verdicts")
    hot = verdicts.filter(F.col("copies") > lines.count() // HOT_SHARE).select(
        F.col("h1").alias("hot1"), F.col("h2").alias("hot2"), F.col("first").alias("hot_first"), F.col("near").alias("hot_near")
    )
    # At most HOT_SHARE rows.
    rows = lines.select("h1", "h2", _place()).join(F.broadcast(hot), (F.col("h1") == F.col("hot1")) & (F.col("h2") == F.col("hot2")), "left")
    frequent = rows.filter("hot1 IS NOT NULL").select("place", F.col("hot_first").alias("first"), F.col("hot_near").alias("near"))
    others = rows.filter("hot1 IS NULL").join(verdicts, ["h1", "h2"]).select("place", "first", "near")
    gone = (
        frequent.unionByName(others)
        .filter(F.col("near") | (F.col("place") != F.col("first")))
        .groupBy("place.doc", "place.text_hash")
        .agg(F.collect_set("place.line").alias("gone"))
    )
    gone = stored(gone, "gone-lines")
    for table in (lines, witnesses, verdicts):
        discard(table)
    return gone


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    edit_from: int = EDIT_FROM,
) -> DataFrame:
    """``docs`` with repeated lines cut from the text, without the documents that have no word left."""
    text = F.col("row")[text_col]
    # Each document travels as one column, so that no name can clash.
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.withColumns({"text_hash": F.xxhash64(text), "doc": F.col("row")[id_col]})
    gone = repeated_lines(docs, id_col, text_col, min_words, edit_from).select(
        F.col("doc").alias("gone_doc"), F.col("text_hash").alias("gone_hash"), "gone"
    )
    same = F.col("doc").eqNullSafe(F.col("gone_doc")) & (F.col("text_hash") == F.col("gone_hash"))
    stays = F.filter(F.split(text, "\n", -1), lambda line, i: ~F.array_contains("gone", i))
    rest = F.array_join(stays, "\n")
    cut = F.col("gone").isNotNull()
    return (
        rows.join(gone, same, "left")
        .withColumn("body", F.when(cut, rest).otherwise(text))
        .filter(~cut | F.col("body").rlike(r"[^\x20\x09-\x0D]"))
        .select(*[(F.col("body") if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
    )
