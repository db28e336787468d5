"""WARC archives of pages, and a two-level capture index over them.

Archives are plain ``.warc.gz`` content: one gzip member for each record.  Spark's text writer writes them: a record is
handed over without its last byte, and that byte, zero in every gzip member of less than 16 MiB, is the line separator.
Larger records are several members.

The index sorts captures by reversed-host key into compressed blocks.  A lookup finds the range of a key among the
first keys of the partitions, then its blocks in the sparse directory of those, both by binary search, and reads the
records of the block's entries by path, offset and length.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.llm.scratch import Scratch
from zoneflow.llm.urlfilter import host_of

REVISIT_BYTES = 1_000  # equal payloads of at least so many bytes are stored once
RECORDS_PER_FILE = 2_000
BLOCK_ENTRIES = 3_000
MEMBER_BYTES = 8 << 20
READ_STEP, READ_BYTES = 1 << 15, 4 << 20
OPENED = {"file", "hdfs", "s3", "s3a", "gs"}  # kinds of files that tasks can open themselves
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value

# --- records -----------------------------------------------------------------


def gzip_members(data: bytes) -> bytes:
    """``data`` as gzip members that each hold at most 8 MiB, so the last byte of each is zero."""
    out = []
    for at in range(0, max(1, len(data)), MEMBER_BYTES):
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        out.append(packer.compress(data[at : at + MEMBER_BYTES]) + packer.flush())
    return b"".join(out)


def record(kind: str, page: int | None, uri: str, day: str, payload: bytes | None, size: int, sha1: bytes, refers) -> bytes:
    """One record; ``payload`` is None for a revisit, which keeps the digest and length of what it refers to."""
    body = b"" if payload is None else payload
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:x-page:{'' if page is None else page}>",
        f"WARC-Date: {day}", f"WARC-Target-URI: {uri}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1).decode()}", f"X-Payload-Length: {size}",
        f"Content-Length: {len(http) + len(body)}",
    ]
    if refers is not None:
        lines[-1:-1] = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, by lower-case name, and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = {}
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(":")
        headers[name.lower()] = value.strip(" \t")
    block = rest[: int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def _page(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(digits) if digits else None


def members(source) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of each record of an archive, an open file that is read in small steps.

    An archive that ends inside a record is an error.
    """
    at, held = 0, b""
    start, parts, wanted = 0, [], None
    while held := held or source.read(READ_STEP):
        inflate = zlib.decompressobj(31)
        while held and not inflate.eof:
            parts.append(inflate.decompress(held))
            at += len(held) - len(inflate.unused_data)
            held = inflate.unused_data if inflate.eof else source.read(READ_STEP)
        if not inflate.eof:
            raise EOFError("the archive ends inside a record")
        if wanted is None:
            head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
            size = next(int(x[15:]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
            wanted = len(head) + 4 + size + 4
        if sum(map(len, parts)) >= wanted:
            yield start, at - start, b"".join(parts)
            start, parts, wanted = at, [], None
    if parts:
        raise EOFError("the archive ends inside a record")


# --- writing and reading -----------------------------------------------------


def clean_uri(url: str) -> Column:
    """URL as it may stand on a header line; a null URL is empty."""
    return F.trim(F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7f]+", "%20"))


def write_archives(
    pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
    date_column: str | None = None,
) -> None:
    """Write a record for each page.

    Of equal payloads of at least 1,000 bytes the one with the largest id is the response and the others revisit it;
    smaller payloads and pages without an id are responses.  A null payload is empty; repeated rows that share the
    largest id are all responses.  A payload of over 8 MiB is several gzip members of one record.  An empty table gives
    no records; other columns of ``pages`` are not written.
    """
    day = F.col(date_column).cast("string") if date_column else F.lit("2024-01-01T00:00:00Z")
    picked = pages.select(
        F.col(id_column).cast("long").alias("page"), clean_uri(url_column).alias("uri"), day.alias("day"),
        F.coalesce(html_column, F.lit("")).alias("html"),
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = batch.column("html").cast(pa.large_binary())
            rows = list(zip(batch.column("page").to_pylist(), batch.column("uri").to_pylist(), batch.column("day").to_pylist()))
            for at in range(0, len(rows), 200):
                sizes, digests, packed = [], [], []
                for i, (page, uri, when) in enumerate(rows[at : at + 200], at):
                    payload = html[i].as_buffer().to_pybytes()
                    sha1 = hashlib.sha1(payload).digest()
                    sizes.append(len(payload)), digests.append(sha1)
                    packed.append(gzip_members(record("response", page, uri, when, payload, len(payload), sha1, None)))
                own = batch.slice(at, 200)
                yield pa.RecordBatch.from_arrays(
                    [*own.columns[:3], pa.array(sizes, pa.int64()), pa.array(digests), pa.array(packed)],
                    names=["page", "uri", "day", "size", "sha1", "packed"],
                )

    packed = picked.mapInArrow(pack, "page long, uri string, day string, size long, sha1 binary, packed binary")
    scratch = Scratch(pages.sparkSession)
    packed = scratch.keep(packed)
    equal = (
        packed.where((F.col("size") >= REVISIT_BYTES) & F.col("page").isNotNull())
        .groupBy("sha1")
        .agg(F.max("page").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("sha1", "first")
    )
    # Only payloads that occur twice meet the table of first pages; the others are written where they are.
    linked = (
        packed.where(F.col("size") >= REVISIT_BYTES)
        .select("page", "sha1")
        .join(equal, "sha1")
        .where("page < first")
        .select("page", "sha1", "first")
        .distinct()
    )
    # Both tables grow with the pages: the same plan at every size.
    marked = packed.join(linked.hint("merge"), ["page", "sha1"], "left")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.select(["page", "uri", "day", "size", "sha1", "first"]).to_pylist():
                revisit = x["first"] is not None
                out.append(
                    gzip_members(record("revisit", x["page"], x["uri"], x["day"], None, x["size"], x["sha1"], x["first"]))
                    if revisit else None
                )
            whole = batch.column("packed")
            rows = [(a or whole[i].as_py())[:-1] for i, a in enumerate(out)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["record"])

    records = marked.mapInArrow(finish, "record binary").select(F.col("record").cast("string").alias("record"))
    records.write.option("lineSep", "\0").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    scratch.drop(packed)


def open_archive(path: str) -> pa.NativeFile:
    """An archive opened for reads at any place, by the name that Spark gives a file."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    system, name = fs.FileSystem.from_uri(("s3" if scheme == "s3a" else scheme) + ":" + quote(rest, safe="/@:"))
    return system.open_input_file(name)


def archives(spark: SparkSession, path: str) -> tuple[DataFrame, bool]:
    """Files of the archives, and whether tasks can open them; where they cannot, the rows hold the whole content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    first = files.select("path").first()
    opened = first is None or first[0].partition(":")[0] in OPENED
    return files.select("path") if opened else files.select("path", "content"), opened


def _reader(batch: pa.RecordBatch, i: int, opened: bool) -> pa.NativeFile:
    return open_archive(batch.column("path")[i].as_py()) if opened else pa.BufferReader(batch.column("content")[i].as_buffer())


def captures(spark: SparkSession, path: str) -> DataFrame:
    """``key, stamp, page, kind, path, offset, length`` of every record of the archives, which are read as streams.

    Defined cases: no archives give no rows; a record without a page has a null page; records with the same key, time and
    page all count; a record of any length is held alone; headers other than these are not looked at.
    """
    files, opened = archives(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column("path")[i].as_py()
                rows = []
                with _reader(batch, i, opened) as source:
                    for offset, length, raw in members(source):
                        h, _ = parse(raw)
                        rows.append({
                            "uri": h.get("warc-target-uri", ""), "stamp": h.get("warc-date", ""), "kind": h["warc-type"],
                            "page": _page(h.get("warc-record-id")), "path": name, "offset": offset, "length": length,
                        })
                schema = pa.schema([
                    ("uri", pa.string()), ("stamp", pa.string()), ("kind", pa.string()), ("page", pa.int64()),
                    ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                ])
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    found = files.mapInArrow(
        run, "uri string, stamp string, kind string, page long, path string, offset long, length long"
    )
    return found.select(url_key("uri").alias("key"), "stamp", "page", "kind", "path", "offset", "length")


def read_ranges(source: pa.NativeFile, ranges: list[tuple[int, int]]) -> Iterator[bytes]:
    """Records at sorted ``(offset, length)`` of an open archive; ranges that touch are read together up to 4 MiB."""
    at = 0
    while at < len(ranges):
        first, end, run = ranges[at][0], ranges[at][0], []
        while at < len(ranges) and (not run or (ranges[at][0] <= end and ranges[at][0] + ranges[at][1] - first <= READ_BYTES)):
            run.append(ranges[at])
            end, at = max(end, sum(ranges[at])), at + 1
        source.seek(first)
        held = memoryview(source.read(end - first))
        for offset, length in run:
            yield next(members(pa.BufferReader(held[offset - first : offset - first + length])))[2]


def read_records(spark: SparkSession, path: str, entries: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, uri, payload`` of ``entries(path, offset, length)``.

    Entries are dealt by ranges of path and offset; each task opens its archives and reads these ranges only.  No archive
    is shuffled.  Where tasks cannot open files of that kind (see ``OPENED``) the archives come whole, by Spark's reader.
    Digest and size of a response come from the bytes read, those of a revisit from its headers.

    Defined cases: no entries give no rows; an entry that is repeated is read once; entries with a null path, offset or
    length are ignored; an entry that is no record is an error; further columns of ``entries`` are ignored.
    """
    schema = pa.schema([
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("uri", pa.string()), ("payload", pa.binary()),
    ])
    types = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string, payload binary"
    wanted = entries.select("path", "offset", "length").dropna()

    def row(raw: bytes) -> dict:
        h, payload = parse(raw)
        revisit = h["warc-type"] == "revisit"
        return {
            "page_id": _page(h.get("warc-record-id")),
            "payload_bytes": int(h["x-payload-length"]) if revisit else len(payload),
            "payload_digest": base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
            if revisit else hashlib.sha1(payload).hexdigest(),
            "record_type": h["warc-type"], "refers_to": _page(h.get("warc-refers-to")),
            "uri": h.get("warc-target-uri", ""), "payload": None if revisit else payload,
        }

    def packed(records: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for raw in records:
            rows.append(row(raw))
            size += len(raw)
            if size >= READ_BYTES or len(rows) >= 500:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, group in groupby(zip(*[c.to_pylist() for c in batch.columns]), key=lambda x: x[0]):
                with open_archive(name) as source:
                    yield from packed(read_ranges(source, sorted({x[1:] for x in group})))

    def by_content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ranges = [(r["offset"], r["length"]) for r in batch.column("ranges")[i].as_py()]
                yield from packed(read_ranges(_reader(batch, i, False), ranges))

    files, opened = archives(spark, path)
    if opened:
        # A stated number: entries are small, but what they name is not, so few bytes must not become few tasks.
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return wanted.distinct().repartitionByRange(tasks, "path", "offset").sortWithinPartitions("path", "offset").mapInArrow(by_range, types)
    ranges = wanted.groupBy("path").agg(F.array_sort(F.collect_set(F.struct("offset", "length"))).alias("ranges"))
    return files.join(ranges.hint("merge"), "path").mapInArrow(by_content, types)


# --- index -------------------------------------------------------------------


def url_key(url: str) -> Column:
    """Reversed-host key: ``com,example,www)/path?query``; a URL without a host is its own key."""
    host = host_of(url)
    tail = F.regexp_extract(F.col(url), r"^[^:]+://[^/?#]*([^#]*)", 1)
    tail = F.when(F.startswith(tail, F.lit("/")), tail).otherwise(F.concat(F.lit("/"), tail))
    turned = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.coalesce(F.concat(turned, F.lit(")"), tail), F.col(url), F.lit(""))


def build_index(entries: DataFrame, scratch: Scratch) -> DataFrame:
    """Blocks ``part, block, first_key, last_key, data`` of at most 3,000 sorted entries each, deflated."""
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "stamp", "page", "path", "offset"]
    ranged = entries.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, []

        def block(rows: list[dict]) -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            table = pa.Table.from_pylist(rows, schema=schema)
            with pa.ipc.new_stream(sink, schema) as out:
                out.write_table(table)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([(part << 32) + number], pa.int64()),
                    pa.array([rows[0]["key"]]), pa.array([rows[-1]["key"]]),
                    pa.array([zlib.compress(sink.getvalue().to_pybytes(), 6)], pa.binary()),
                ],
                names=["part", "block", "first_key", "last_key", "data"],
            )

        schema = None
        for batch in batches:
            schema = schema or batch.schema
            held += batch.to_pylist()
            while len(held) >= BLOCK_ENTRIES:
                yield block(held[:BLOCK_ENTRIES])
                held, number = held[BLOCK_ENTRIES:], number + 1
        if held:
            yield block(held)

    return scratch.keep(ranged.mapInArrow(run, "part int, block long, first_key string, last_key string, data binary"))


def _between(keys: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end position of the sorted ranges ``first .. last`` that may hold each key."""
    return np.searchsorted(last, keys, side="left"), np.searchsorted(first, keys, side="right")


def _strings(column) -> np.ndarray:
    """Keys as bytes: their order is that of Spark's strings, which the sort used."""
    return np.array([x.encode() for x in column.to_pylist()], dtype=object)


def _spread(keys: np.ndarray, low: np.ndarray, high: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.maximum(high - low, 0)
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - sizes), sizes)
    return np.repeat(keys, sizes), numbers[at]


def lookup(index: DataFrame, keys: DataFrame) -> DataFrame:
    """Entries of the index whose key is in ``keys(key)``; keys that it lacks give no rows."""
    spark = index.sparkSession
    # One row for each range partition, a fixed number.
    tops = index.groupBy("part").agg(F.min("first_key").alias("first"), F.max("last_key").alias("last")).orderBy("part").toArrow()
    top = spark.sparkContext.broadcast(
        (tops["part"].to_numpy(), _strings(tops["first"].combine_chunks()), _strings(tops["last"].combine_chunks()))
        if len(tops) else (np.zeros(0, np.int32), np.zeros(0, object), np.zeros(0, object))
    )
    asked = keys.where("key is not null").select("key").distinct()

    def find_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, first, last = top.value
        for batch in batches:
            wanted = _strings(batch.column(0))
            k, n = _spread(wanted, *_between(wanted, first, last), parts)
            yield pa.RecordBatch.from_arrays([pa.array([x.decode() for x in k], pa.string()), pa.array(n, pa.int32())], names=["key", "part"])

    def find_block(wanted: pa.Table, directory: pa.Table) -> pa.Table:
        directory = directory.sort_by("block")
        keys = _strings(wanted["key"].combine_chunks()) if len(wanted) else np.zeros(0, object)
        if not len(keys) or not len(directory):
            return pa.table({"key": pa.array([], pa.string()), "block": pa.array([], pa.int64())})
        first, last = _strings(directory["first_key"]), _strings(directory["last_key"])
        k, n = _spread(keys, *_between(keys, first, last), directory["block"].to_numpy())
        return pa.table({"key": pa.array([x.decode() for x in k], pa.string()), "block": pa.array(n, pa.int64())})

    def open_block(wanted: pa.Table, blocks: pa.Table) -> pa.Table:
        held = set(wanted["key"].to_pylist())
        found = []
        for data in blocks["data"].to_pylist() if held else []:
            table = pa.ipc.open_stream(zlib.decompress(data)).read_all()
            found.append(table.filter(pa.array([k in held for k in table["key"].to_pylist()])))
        return pa.concat_tables(found).cast(schema) if found else schema.empty_table()

    schema = pa.schema([
        ("key", pa.string()), ("stamp", pa.string()), ("page", pa.int64()), ("kind", pa.string()), ("path", pa.string()),
        ("offset", pa.int64()), ("length", pa.int64()),
    ])
    parted = asked.mapInArrow(find_part, "key string, part int")
    directory = index.select("part", "block", "first_key", "last_key")
    blocks = parted.groupBy("part").cogroup(directory.groupBy("part")).applyInArrow(find_block, "key string, block long")
    return blocks.groupBy("block").cogroup(index.select("block", "data").groupBy("block")).applyInArrow(
        open_block, "key string, stamp string, page long, kind string, path string, offset long, length long"
    )
