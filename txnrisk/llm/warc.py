"""WARC archives of pages with a two-level capture index.

Writing. Every page becomes one record, compressed by itself, in an archive of about ``ARCHIVE_BYTES`` in the
shared folder. Of pages with equal payloads of at least ``least_bytes`` bytes the one with the smallest id is a
response, and the others are revisits that name it and hold no payload; smaller pages are all responses. Each attempt of a task
writes files of its own, and only places that Spark has committed are ever read, so lost executors and
repeated tasks leave unused files at worst.

Index. Captures are sorted by their URL with the host reversed (``com,example,www)/path``), by ranges over all tasks,
and cut into compressed blocks. The directory has the first and last key of each block and is stored by itself. A
URL is looked up by binary search among the parts of the index (``MAX_PARTS`` at most, keys cut to
``BOUND_BYTES``, which bounds what is broadcast), then among the directory entries of its part, and only the
blocks found are read and unpacked. Records are then read by byte range, neighbours together.

Defined results: a null page is an empty payload; of equal payloads whose smallest id occurs several times, all with that id are
responses; a null id is never the smallest, and pages with nulls only are all responses. A null URL has the key ''
and is found by a null; a URL without ``://`` is its own key. Repeated rows are written and read one by one, extra columns are
ignored, an empty table gives empty archives and an empty result. A page is held whole, one or a few at a time.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.tables import bound_batches, stored
from txnrisk.sources.tables import scratch_dir

LEAST_BYTES = 100
ARCHIVE_BYTES = 256 << 20
#: Captures and bytes of one block, captures of one part of the index, parts at most.
BLOCK_CAPTURES = 1024
BLOCK_BYTES = 1 << 18
PART_CAPTURES = 1 << 18
MAX_PARTS = 20_000
BOUND_BYTES = 256
#: Queries that one task searches a directory for, and URLs looked for in one reading of a block.
GROUP_QUERIES = 50_000
BLOCK_QUERIES = 2048
#: Bytes read at once, and bytes of an archive that one group of reads covers.
READ_BYTES = 4 << 20
READ_GROUP_BYTES = 32 << 20
#: Payloads that more than this share of the pages have are few, so their first pages can be broadcast.
HOT_SHARE = 500
OUTPUT_ROWS = 1000

CAPTURE = "url string, file string, offset long, length long"


def reversed_host_key(url: Column) -> Column:
    """``scheme://WWW.example.com/path`` as ``com,example,www)/path``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    labels = F.reverse(F.split(F.translate(host, upper, lower), r"\."))
    key = F.concat(F.array_join(labels, ","), F.lit(")"), F.substring(rest, F.char_length(host) + 1, F.char_length(rest)))
    return F.coalesce(F.when(F.instr(url, "://") > 0, key).otherwise(url), F.lit(""))


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that all executors reach, and its path there."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


# ------------------------------------------------------------------ records


def with_first_pages(pages: DataFrame, id_col: str, html_col: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``row`` (the page), ``payload_bytes``, ``digest`` and ``first``, the page that a revisit refers to.

    The first pages of very frequent payloads are joined without moving any page, and small pages
    need none; a payload in the other join has at most one in ``HOT_SHARE`` of all pages.
    """
    payload = F.coalesce(F.col("row")[html_col], F.lit(""))
    rows = pages.select(F.struct("*").alias("row")).select(
        "row", F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload.cast("binary"), 256).alias("digest")
    )
    large = rows.filter(F.col("payload_bytes") >= least_bytes)
    groups = large.groupBy("digest").agg(F.min(F.col("row")[id_col]).alias("first"), F.count("*").alias("copies"))
    groups = stored(groups.filter("copies > 1 AND first IS NOT NULL"), "equal-payloads")
    hot = groups.filter(F.col("copies") > pages.count() // HOT_SHARE).select(
        F.col("digest").alias("hot_digest"), F.col("first").alias("hot_first")
    )
    rows = rows.join(F.broadcast(hot), F.col("digest") == F.col("hot_digest"), "left").drop("hot_digest")
    settled = F.col("hot_first").isNotNull() | (F.col("payload_bytes") < least_bytes)
    large_only = F.when(F.col("payload_bytes") >= least_bytes, F.col("hot_first")).alias("first")
    names = ("row", "payload_bytes", "digest")
    return rows.filter(settled).select(*names, large_only).unionByName(
        rows.filter(~settled).join(groups.select("digest", "first"), "digest", "left").select(*names, "first")
    )


def _record(page: str | None, url: str | None, digest: str, size: int, first: str | None, payload: bytes, date: str) -> bytes:
    """One WARC record. A revisit has the header block of the response only."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page}:{url}:{digest}").urn
    fields = [("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", date)]
    if url is not None:
        target = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)
        fields.append(("WARC-Target-URI", target))
    if page is not None:
        fields.append(("Page-ID", json.dumps(page)))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if first is None:
        block += payload
    else:
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        fields.append(("Refers-To-Page-ID", json.dumps(first)))
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


@dataclass
class Record:
    """A record read back: its header fields, the size of the full payload, and the payload a response holds."""

    fields: dict[str, str]
    payload_bytes: int
    payload: bytes | None

    @classmethod
    def parse(cls, raw: bytes) -> "Record":
        version, _, rest = raw.partition(b"\r\n")
        head, _, rest = rest.partition(b"\r\n\r\n")
        if version != b"WARC/1.1":
            raise ValueError("not a WARC record")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n"))
        block = rest[: int(fields["Content-Length"])]
        if rest[len(block) :] != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(http.decode().rsplit("Content-Length: ", 1)[1])
        if fields["WARC-Type"] == "revisit":
            return cls(fields, size, None)
        if len(payload) != size or f"sha256:{hashlib.sha256(payload).hexdigest()}" != fields["WARC-Payload-Digest"]:
            raise ValueError("a payload is not the one that was written")
        return cls(fields, size, payload)

    def page(self, field: str = "Page-ID") -> str | None:
        return json.loads(self.fields[field]) if field in self.fields else None


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = LEAST_BYTES,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write all pages and return where each record lies: ``url``, ``file``, ``offset``, ``length``; stored.

    ``folder`` is one that all executors reach, by default one in ``spark.checkpoint.dir``.
    """
    spark = pages.sparkSession
    bound_batches(spark)
    folder = folder or f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        system.create_dir(base, recursive=True)
        stem = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        out, name, at, number = None, "", 0, 0
        try:
            for batch in batches:
                places = []
                for row in batch.to_pylist():
                    if out is None:
                        name, at, number = f"{stem}-{number:04d}.warc.gz", 0, number + 1
                        out = system.open_output_stream(f"{base}/{name}", compression=None)
                    payload = (row["html"] or "").encode()
                    raw = _record(row["page"], row["url"], row["digest"], row["payload_bytes"], row["first"], payload, date)
                    member = gzip.compress(raw, 6, mtime=0)
                    out.write(member)
                    places.append((row["url"], name, at, len(member)))
                    at += len(member)
                    if at >= ARCHIVE_BYTES:
                        out.close()
                        out = None
                yield _rows(places, ("url", "file", "offset", "length"))
        finally:
            if out is not None:
                out.close()

    def field(name: str) -> Column:
        return F.col("row")[name]

    rows = with_first_pages(pages, id_col, html_col, least_bytes)
    page, first = field(id_col).cast("string"), F.col("first").cast("string")
    revisit = F.col("first").isNotNull() & ~field(id_col).eqNullSafe(F.col("first"))
    rows = rows.select(
        page.alias("page"),
        field(url_col).alias("url"),
        F.when(~revisit, field(html_col)).alias("html"),
        "payload_bytes",
        "digest",
        F.when(revisit, first).alias("first"),
    )
    places = stored(rows.mapInArrow(run, CAPTURE), "captures")
    return places.withColumn("file", F.concat(F.lit(folder + "/"), "file"))


def _rows(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    kinds = {"offset": pa.int64(), "length": pa.int64(), "payload_bytes": pa.int64(), "part": pa.int32(), "block": pa.int32(), "payload": pa.binary()}
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.string())) for c, n in zip(columns, names)], list(names))


# -------------------------------------------------------------------- index


@dataclass(frozen=True)
class CaptureIndex:
    """``blocks`` has ``part``, ``block``, ``first_key``, ``last_key`` and ``data``, ``directory`` all but the data."""

    blocks: DataFrame
    directory: DataFrame


def build_index(captures: DataFrame) -> CaptureIndex:
    """Sort captures by reversed-host key into compressed blocks, and list the blocks in a directory."""
    count = captures.count()
    parts = min(MAX_PARTS, max(1, -(-count // PART_CAPTURES)))
    # File and offset make every row different, so no URL is too frequent for one part.
    order = ("key", "url", "file", "offset")
    rows = captures.select(reversed_host_key(F.col("url")).alias("key"), "url", "file", "offset", "length")
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows = rows.withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number, part = [], 0, 0, None

        def block() -> pa.RecordBatch:
            lines = "\n".join(json.dumps(line, separators=(",", ":")) for line in held)
            names = ["part", "block", "first_key", "last_key", "data"]
            values = [[part], [number], [held[0][0]], [held[-1][0]], [zlib.compress(lines.encode(), 6)]]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["part"] != part or len(held) >= BLOCK_CAPTURES or size >= BLOCK_BYTES):
                    yield block()
                    held, size, number = [], 0, number + 1
                part = row["part"]
                held.append((row["key"], row["url"], row["file"], row["offset"], row["length"]))
                size += len(row["key"]) + len(row["url"] or "")
        if held:
            yield block()

    schema = "part int, block int, first_key string, last_key string, data binary"
    blocks = stored(rows.mapInArrow(run, schema), "capture-blocks")
    directory = stored(blocks.select("part", "block", "first_key", "last_key"), "capture-directory")
    return CaptureIndex(blocks, directory)


def _cut(key: str) -> bytes:
    """A key as far as it bounds a part; the order of whole keys is kept."""
    return key.encode()[:BOUND_BYTES]


def lookup(index: CaptureIndex, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """All captures of the given URLs: ``url``, ``file``, ``offset``, ``length``. A URL asked for twice counts once."""
    spark = urls.sparkSession
    queries = urls.select(F.col(url_col).alias("url")).distinct()
    queries = queries.select("url", reversed_host_key(F.col("url")).alias("key"))
    # The bounds of each part: at most MAX_PARTS rows of twice BOUND_BYTES.
    cut = [F.substring(F.encode(agg, "UTF-8"), 1, BOUND_BYTES).alias(name) for agg, name in ((F.min("first_key"), "low"), (F.max("last_key"), "high"))]
    bounds = index.directory.groupBy("part").agg(*cut).orderBy("low", "high", "part").collect()
    shared = spark.sparkContext.broadcast(
        ([r["part"] for r in bounds], [bytes(r["low"]) for r in bounds], [bytes(r["high"]) for r in bounds])
    )

    def find_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, low, high = shared.value
        for batch in batches:
            found = []
            for url, key in zip(*(column.to_pylist() for column in batch.columns)):
                near = _cut(key)
                found += [(p, url, key) for p in parts[bisect_left(high, near) : bisect_right(low, near)]]
            yield _rows(found, ("part", "url", "key"))

    placed = stored(queries.mapInArrow(find_parts, "part int, url string, key string"), "placed-queries")
    most = placed.groupBy("part").count().agg(F.max("count")).first()[0] or 0
    groups = max(1, -(-most // GROUP_QUERIES))

    def find_blocks(entries: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        entries = entries.sort_values("block")
        first = [k.encode() for k in entries["first_key"]]
        last = [k.encode() for k in entries["last_key"]]
        numbers = entries["block"].tolist()
        wanted: dict[int, list] = {}
        for url, key in zip(asked["url"], asked["key"]):
            key = key.encode()
            for block in numbers[bisect_left(last, key) : bisect_right(first, key)]:
                wanted.setdefault(block, []).append(url)
        rows = [
            (int(entries["part"].iloc[0]), block, found[i : i + BLOCK_QUERIES])
            for block, found in wanted.items()
            for i in range(0, len(found), BLOCK_QUERIES)
        ]
        return pd.DataFrame(rows, columns=["part", "block", "urls"])

    group = F.pmod(F.xxhash64("url"), F.lit(groups)).cast("int").alias("group")
    asked = placed.select("part", "url", "key", group).groupBy("part", "group")
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    entries = index.directory.select("*", every).groupBy("part", "group")
    wanted = entries.cogroup(asked).applyInPandas(find_blocks, "part int, block int, urls array<string>")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asked_for = set(row["urls"])
                lines = zlib.decompress(row["data"]).decode().split("\n")
                found = [tuple(line[1:]) for line in map(json.loads, lines) if line[1] in asked_for]
                yield _rows(found, ("url", "file", "offset", "length"))

    blocks = index.blocks.select("part", "block", "data").join(wanted, ["part", "block"])
    return blocks.select("urls", "data").mapInArrow(unpack, CAPTURE)


# ------------------------------------------------------------------ reading


def read_records(captures: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records at the given places, read by byte range and checked.

    ``page_id`` and ``refers_to`` as text, ``url``, ``payload_bytes``, ``payload_digest``, ``record_type``, and with
    ``with_payload`` the ``payload`` of responses.
    """
    names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
    names += ("payload",) if with_payload else ()
    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"

    def ranges(rows: list[dict]) -> Iterator[list[dict]]:
        """Runs of records that follow one another in a file."""
        run, size = [], 0
        for row in rows:
            follows = run and row["file"] == run[-1]["file"] and row["offset"] == run[-1]["offset"] + run[-1]["length"]
            if run and (not follows or size + row["length"] > READ_BYTES):
                yield run
                run, size = [], 0
            run.append(row)
            size += row["length"]
        if run:
            yield run

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            for run in ranges(batch.to_pylist()):
                if run[0]["file"] != name:
                    if file is not None:
                        file.close()
                    name = run[0]["file"]
                    system, path = file_system(name)
                    file = system.open_input_file(path)
                start = run[0]["offset"]
                raw = file.read_at(run[-1]["offset"] + run[-1]["length"] - start, start)
                found = []
                for row in run:
                    record = Record.parse(gzip.decompress(raw[row["offset"] - start :][: row["length"]]))
                    digest = record.fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    values = (record.page(), row["url"], record.payload_bytes, digest, record.fields["WARC-Type"])
                    values += (record.page("Refers-To-Page-ID"),)
                    found.append(values + ((record.payload,) if with_payload else ()))
                yield _rows(found, names)
        if file is not None:
            file.close()

    near = F.floor(F.col("offset") / READ_GROUP_BYTES)
    rows = captures.select("url", "file", "offset", "length").repartition("file", near).sortWithinPartitions("file", "offset")
    return rows.mapInArrow(read, schema + (", payload binary" if with_payload else ""))


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all pages, index them, look every URL up and read its records back."""
    captures = write_archives(pages, None, id_col, url_col, html_col)
    records = read_records(lookup(build_index(captures), pages, url_col))
    kind = pages.schema[id_col].dataType
    return records.select(
        F.col("page_id").cast(kind).alias(id_col),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
