"""WARC archives: writing pages with an index of their records, and reading chosen records back by byte ranges."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence
from datetime import datetime, timezone
from typing import NamedTuple
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeassay.llm.common import staged

#: Payloads from this size on are stored once; smaller ones cost less than a reference.
LEAST_BYTES = 100
#: An archive is closed once it holds so many bytes.
ARCHIVE_BYTES = 1 << 30
#: Records at most GAP bytes apart are read in one request, of up to SPAN bytes unless one record is longer.
GAP, SPAN = 64 << 10, 8 << 20
#: Bytes of archives that one task reads, and of payloads that it holds before it hands them on.
TASK_BYTES, HELD_BYTES = 32 << 20, 16 << 20

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile(rb"[\x00-\x20\x7f%]")
_END = b"\r\n\r\n"
_INDEX = ("page_id string, url string, file string, offset long, length long, payload_bytes long, payload_digest string, "
          "record_type string, refers_to string")
_READ = "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"


# ---- Records

class Record(NamedTuple):
    """A record as read: its named fields in lower case, and its block without the HTTP header."""

    fields: dict[str, str]
    http: dict[str, str]
    payload: bytes


def _quoted(value: str) -> str:
    """A header value without white space, control characters and per cent signs; `unquote` gives back what it was."""
    return _UNSAFE.sub(lambda m: b"%%%02X" % m[0][0], value.encode()).decode()


def _unquoted(value: str | None) -> str | None:
    return None if value is None else unquote_to_bytes(value).decode()


def _record_id(kind: str, page_id: str | None, digest: str) -> str:
    name = "\0".join((kind, "" if page_id is None else f"={page_id}", digest))
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(name.encode(), usedforsecurity=False).digest())}>"


def _fields(pairs: Iterable[tuple[str, str | None]]) -> bytes:
    return "".join(f"{name}: {value}\r\n" for name, value in pairs if value is not None).encode()


def record_bytes(page_id: str | None, url: str | None, payload: bytes, digest: str, original: str | None, date: str) -> bytes:
    """One record, not compressed: a response, or a revisit of the page `original`, which leaves the payload out."""
    kind = "response" if original is None else "revisit"
    block = b"HTTP/1.1 200 OK\r\n" + _fields([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]) + b"\r\n"
    block += payload if original is None else b""
    return b"WARC/1.1\r\n" + _fields([
        ("WARC-Type", kind), ("WARC-Record-ID", _record_id(kind, page_id, digest)), ("WARC-Date", date),
        ("WARC-Target-URI", _quoted(url) if url else "about:blank"), ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Profile", None if original is None else _PROFILE),
        ("WARC-Refers-To", None if original is None else _record_id("response", original, digest)),
        ("Page-ID", None if page_id is None else _quoted(page_id)), ("Refers-To-Page-ID", None if original is None else _quoted(original)),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]) + b"\r\n" + block + _END


def _parsed(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in lines.split(b"\r\n")[1:])
    return {name.strip().lower().decode(): value.strip().decode() for name, _, value in pairs if name}


def parse_record(data: bytes) -> Record:
    """A record from its bytes; one that does not end where its length says is an error."""
    head, found, rest = data.partition(_END)
    if not found or not head.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {data[:40]!r}")
    fields = _parsed(head)
    size = int(fields["content-length"])
    if rest[size:] != _END:
        raise ValueError(f"a record of {size} bytes ends after {len(rest)}")
    if not fields.get("content-type", "").startswith("application/http"):
        return Record(fields, {}, rest[:size])
    http, _, payload = rest[:size].partition(_END)
    return Record(fields, _parsed(http), payload)


def _squeezed(data: bytes, level: int) -> bytes:
    """`data` as a gzip member of its own, the same for the same bytes."""
    member = zlib.compressobj(level, zlib.DEFLATED, 31)
    return member.compress(data) + member.flush()


def _members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Place, length and content of each gzip member of `data`."""
    at = 0
    while at < len(data):
        member = zlib.decompressobj(31)
        content = member.decompress(data[at:] if at else data)
        if not member.eof:
            raise ValueError("a gzip member is cut off")
        length = len(data) - at - len(member.unused_data)
        yield at, length, content
        at += length


# ---- Files

def _located(path: str) -> tuple[fs.FileSystem, str]:
    """The store that a path or URI names, and the path within it, for tasks that open files by themselves."""
    path = re.sub(r"^file:/+", "file:///", path)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


class _Archive:
    """An archive being written, of a name that no other task or attempt uses."""

    def __init__(self, folder: str, date: str, level: int) -> None:
        self.file, self.offset, self._level = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, level
        store, path = _located(self.file)
        self._out = store.open_output_stream(path, compression=None)
        about = b"format: WARC File Format 1.1\r\n"
        self.add(b"WARC/1.1\r\n" + _fields([
            ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
            ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(about)))]) + b"\r\n" + about + _END)

    def add(self, record: bytes) -> tuple[int, int]:
        """Where the record begins, and its length."""
        data, at = _squeezed(record, self._level), self.offset
        self._out.write(data)
        self.offset += len(data)
        return at, len(data)

    def close(self) -> None:
        self._out.close()


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(c.split() for c in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*rows) if rows else [()] * len(names), types)], names=list(names))


def originals(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Per payload of at least `least_bytes` that several rows have: its digest and the smallest id among them, `first`.

    `pages` has `page_id`, `payload_digest` and `payload_bytes`; rows are summed up before the shuffle.
    """
    groups = pages.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest")
    return groups.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")


def write_archives(pages: DataFrame, folder: str, id_column: str = "page_id", url: str = "url", html: str = "html", *,
                   least_bytes: int = LEAST_BYTES, date: datetime | None = None, level: int = 6) -> DataFrame:
    """Write every page as a record of gzipped WARC files in `folder`; returns the index of the records, written first of all reads.

    The payload is the html in UTF-8; a null html is an empty payload. Of the rows with one payload of at least `least_bytes`
    bytes, that with the smallest id is a response and the others are revisits, which refer to it and hold no payload.
    Smaller payloads are responses each. A row that repeats the smallest id is a response as well; a row without id is a
    revisit of a row that has one; where no row of a payload has an id, all are responses. An empty table gives an empty index.
    Ids travel as text; a null or empty url is written as `about:blank`.

    The index has `page_id`, `url`, `file`, `offset`, `length`, `payload_bytes`, `payload_digest` (SHA-256), `record_type` and
    `refers_to`. Only digests are shuffled to find repeated payloads. Pages themselves are shuffled, by digest, only where the
    repeated digests are too many for Spark to broadcast by their measured size. Each task writes files of its own, under names
    no other attempt uses, and the index is committed with what the attempt that succeeded wrote, so a lost executor leaves at
    worst a file that no index names. `folder` must be a store that tasks can open: a shared file system, or one that pyarrow knows.
    """
    spark = pages.sparkSession
    stamp = (date or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    body = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_column}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), body.alias("body")).withColumns(
        {"payload_bytes": F.octet_length("body").cast("long"), "payload_digest": F.sha2("body", 256)})
    first = staged(originals(rows, least_bytes)).withColumnRenamed("payload_digest", "key")
    # Short payloads have no original; their own keys keep equal ones, such as empty pages, from meeting in one task.
    key = F.when(F.col("payload_bytes") >= least_bytes, F.col("payload_digest")).otherwise(F.xxhash64("page_id", "url").cast("string"))
    original = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first").cast("string"))
    marked = rows.withColumn("key", key).join(first, "key", "left").select(
        F.col("page_id").cast("string").alias("page_id"), "url", "body", "payload_digest", original.alias("original"))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in batches:
            index = []
            for page_id, address, payload, digest, original in zip(*(batch.column(i) for i in range(5))):
                page_id, address, payload, digest, original = (x.as_py() for x in (page_id, address, payload, digest, original))
                if archive is None:
                    archive = _Archive(folder, stamp, level)
                at, length = archive.add(record_bytes(page_id, address, payload, digest, original, stamp))
                index.append((page_id, address, archive.file, at, length, len(payload), digest, "response" if original is None else "revisit", original))
                if archive.offset >= ARCHIVE_BYTES:
                    archive.close()
                    archive = None
            yield _batch(index, _INDEX)
        if archive is not None:
            archive.close()

    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)
    return staged(marked.mapInArrow(write, _INDEX))


def index_archives(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """The index of archives that came without one, as `write_archives` gives it, from a pass over each file by one task.

    Records other than responses and revisits are left out; `payload_bytes` and ids are null where a record does not say.
    """

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                yield from _scanned(file)

    named = spark.createDataFrame([(f,) for f in files], "file string").repartition(max(1, len(files)))
    return staged(named.mapInArrow(scan, _INDEX))


def _scanned(file: str, step: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Index rows of one archive, which is read in steps of bounded size; a member is held whole."""
    store, path = _located(file)
    rows: list[tuple] = []
    with store.open_input_stream(path, compression=None) as stream:
        at, member, content, taken, data = 0, zlib.decompressobj(31), [], 0, stream.read(step)
        while data:
            content.append(member.decompress(data))
            taken += len(data) - len(member.unused_data)
            data = member.unused_data
            if member.eof:
                row = _index_row(b"".join(content), file, at, taken)
                rows += [row] if row else []
                at, member, content, taken = at + taken, zlib.decompressobj(31), [], 0
            if len(rows) >= 10_000:
                yield _batch(rows, _INDEX)
                rows = []
            data = data or stream.read(step)
        if taken:
            raise ValueError(f"{file} is cut off at {at + taken}")
    yield _batch(rows, _INDEX)


def _index_row(content: bytes, file: str, at: int, length: int) -> tuple | None:
    record = parse_record(content)
    kind = record.fields["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    page_id, url, _, refers_to, size, digest = _described(record)
    return (page_id, url, file, at, length, size, digest, kind, refers_to)


def _described(record: Record) -> tuple:
    """Page id, url, type, original, payload size and digest; of a response the last two are taken from the payload itself."""
    f = record.fields
    kind, digest = f["warc-type"], f.get("warc-payload-digest", "")
    url = _unquoted(f.get("warc-target-uri", "").strip("<>"))
    size = int(record.http["content-length"]) if "content-length" in record.http else None
    if kind == "response":
        measured = hashlib.sha256(record.payload).hexdigest()
        if digest.startswith("sha256:") and digest != f"sha256:{measured}":
            raise ValueError(f"the payload of {f.get('warc-record-id')} is damaged")
        size, digest = len(record.payload), measured
    return (_unquoted(f.get("page-id")), None if url in ("", "about:blank") else url, kind, _unquoted(f.get("refers-to-page-id")),
            size, digest.removeprefix("sha256:"))


# ---- Reading

def coalesced(places: Iterable[tuple[int, int]], gap: int = GAP, span: int = SPAN) -> Iterator[list[tuple[int, int]]]:
    """Sorted (offset, length) places in runs that one request reads: at most `gap` apart, `span` long together unless one alone is longer."""
    run: list[tuple[int, int]] = []
    for at, length in places:
        if run and (at - max(run[-1][0] + run[-1][1], 0) > gap or at + length - run[0][0] > span):
            yield run
            run = []
        run.append((at, length))
    if run:
        yield run


def read_records(index: DataFrame, *, payloads: bool = True, gap: int = GAP, span: int = SPAN) -> DataFrame:
    """The records that `index`, or any choice of its rows, points at.

    Returns `page_id`, `url`, `record_type`, `refers_to`, `payload_bytes`, `payload_digest` and `payload` (null for revisits, or for
    all with `payloads=False`), all as the archives have them: size and digest of a response come from its payload, which must
    match the digest it was written with. A row that occurs twice is returned twice.

    Places are dealt out by ranges of file and offset, so that a task reads a stretch of few archives in order. Neighbours are
    read in one request. A task holds one request and a bounded amount of payloads; a record is held whole.
    """
    places = index.select("file", "offset", "length")
    spark = index.sparkSession
    total = places.agg(F.sum("length")).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, source, rows, held = None, None, [], 0
        for file, places in _by_file(batches):
            if file != opened:
                if source is not None:
                    source.close()
                store, path = _located(file)
                opened, source = file, store.open_input_file(path)
            for run in coalesced(places, gap, span):
                start = run[0][0]
                data = source.read_at(max(a + n for a, n in run) - start, start)
                for at, length in run:
                    (_, used, content), *more = _members(data[at - start : at - start + length])
                    if more or used != length:
                        raise ValueError(f"{file} has no record of {length} bytes at {at}")
                    record = parse_record(content)
                    payload = record.payload if payloads and record.fields["warc-type"] == "response" else None
                    rows.append((*_described(record), payload))
                    held += len(payload or b"") + 200
                    if held >= HELD_BYTES:
                        yield _batch(rows, _READ)
                        rows, held = [], 0
        if source is not None:
            source.close()
        yield _batch(rows, _READ)

    return places.repartitionByRange(int(parts), "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(read, _READ)


def _by_file(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Stretches of places in one file; a file may come in several."""
    for batch in batches:
        files, offsets, lengths = (batch.column(i).to_pylist() for i in range(3))
        start = 0
        for end in range(1, len(files) + 1):
            if end == len(files) or files[end] != files[start]:
                yield files[start], list(zip(offsets[start:end], lengths[start:end]))
                start = end


def resolved(chosen: DataFrame, index: DataFrame) -> DataFrame:
    """Index rows with the place of the record that holds their payload: revisits get that of their response in `index`.

    Reading the result gives a payload for every row; `page_id` and `record_type` are then those of the record read.
    """
    place = ["file", "offset", "length"]
    responses = (index.where("record_type = 'response'").groupBy("payload_digest", F.col("page_id").alias("refers_to"))
                 .agg(F.min(F.struct(*place)).alias("place")))
    found = chosen.join(responses, ["payload_digest", "refers_to"], "left")
    columns = [F.coalesce(F.col(f"place.{c}"), F.col(c)).alias(c) if c in place else F.col(c) for c in chosen.columns]
    return found.select(columns)
