"""WARC archives as a PySpark Python data source (operator 4).

Records are made by expressions and written by the data source's own writer: each record is a gzip member
of its own, whose header has the member's length in an extra field (``sl``, as the standard's annex on compression
proposes).  Tasks write under hidden names, and the commit names their files, so attempts that are lost or repeated leave nothing behind.

Reading is a Python data source named ``warc``.  It plans partitions of whole
files packed to ``partition_bytes``; predicates on the record type and on header
columns are pushed down; a record's header block is parsed first (only the first block of a member is inflated), and an
unwanted record is sought over by its length without being inflated.  Archives without that field, or without compression, are
read on from record to record.  The option ``payload`` says what to do with wanted ones: ``none`` skips them too,
``digest`` hashes them, ``bytes`` returns them as well.  Paths without a scheme belong to Spark's default file system.

Defined cases: a null html is an empty payload; a null url gives no target header;
control characters of a url are percent-encoded; rows that repeat the smallest
page_id of a payload are all responses; a null page_id is above all others and
is written without a number; an empty table gives no archive and an empty result;
extra columns of the pages are ignored, whatever their names.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage,
)

MIN_DUPLICATE = 100
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = (
    "file string, offset long, record_type string, record_id string, target_uri string, date string, content_type string,"
    " content_length long, payload_digest string, refers_to string, http_head string, payload_bytes long, computed_digest string, payload binary"
)
#: Column and the header that it comes from.
HEADERS = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
    "content_type": "content-type", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to",
}


# ---- writing


def _page_urn(column) -> F.Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(column.cast("string"), F.lit("none")), F.lit(">"))


def as_records(pages: DataFrame, min_duplicate: int = MIN_DUPLICATE, date: str = DATE) -> DataFrame:
    """One string column ``value``: a record for each page, a revisit where an earlier page has the same payload."""
    html = F.coalesce(pages["html"].cast("string"), F.lit(""))
    base = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), html.alias("html"))
    base = base.select("*", F.sha2(F.encode("html", "UTF-8"), 256).alias("digest"), F.octet_length("html").cast("long").alias("bytes"))
    # digests alone are grouped, with a map-side combine; most payloads are the only ones of their kind and take no part in the join's small side
    first = base.filter(F.col("bytes") >= min_duplicate).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    first = first.filter("n > 1").select(F.col("digest").alias("_digest"), "first")
    both = base.join(first, F.col("digest") == F.col("_digest"), "left")
    again = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    url = F.col("url")
    for code in (0x20, 0x09, 0x0A, 0x0D):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    url = F.regexp_replace(url, r"[\x00-\x1F\x7F]", "%3F")
    eol = "\r\n"
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{eol}Content-Type: text/html; charset=utf-8{eol}Content-Length: "), F.col("bytes").cast("string"), F.lit(eol * 2))
    length = F.octet_length(head) + F.when(again, F.lit(0)).otherwise(F.col("bytes"))
    value = F.concat(
        F.lit(f"WARC/1.1{eol}WARC-Type: "), F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(f"{eol}WARC-Record-ID: "), _page_urn(F.col("page_id")), F.lit(f"{eol}WARC-Date: {date}"),
        F.coalesce(F.concat(F.lit(f"{eol}WARC-Target-URI: "), url), F.lit("")),
        F.lit(f"{eol}WARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(again, F.concat(F.lit(f"{eol}WARC-Profile: {PROFILE}{eol}WARC-Refers-To: "), _page_urn(F.col("first")))).otherwise(F.lit("")),
        F.lit(f"{eol}Content-Type: application/http; msgtype=response{eol}Content-Length: "), length.cast("string"), F.lit(eol * 2),
        head, F.when(again, F.lit("")).otherwise(F.col("html")),
    )
    return both.select(value.alias("value"))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme; without one it belongs to Spark's default file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def write(pages: DataFrame, path: str, min_duplicate: int = MIN_DUPLICATE, file_bytes: int = 64 << 20) -> None:
    """Write the pages as archives into a folder."""
    spark = pages.sparkSession
    spark.dataSource.register(WarcSource)
    as_records(pages, min_duplicate).write.format("warc").mode("append").option("file_bytes", str(file_bytes)).save(qualified(spark, path))


def member(record: bytes, level: int = 6) -> bytes:
    """A gzip member with its compressed and plain length in the extra field ``sl``."""
    z = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = z.compress(record) + z.flush()
    size = 24 + len(body) + 8
    if max(size, len(record)) >= 1 << 32:  # no room for the lengths: a member without the field
        return b"\x1f\x8b\x08\0\0\0\0\0\0\xff" + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size, len(record))
    return head + body + struct.pack("<II", zlib.crc32(record), len(record))


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class WarcWriter(DataSourceArrowWriter):
    """Files of a task: hidden names first, their own at the commit."""

    def __init__(self, options: dict):
        self.path, self.most = options["path"].rstrip("/"), int(options.get("file_bytes", 64 << 20))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files: list[tuple[str, str]] = []
        out, size = None, 0
        try:
            for batch in iterator:
                for value in batch.column("value"):
                    if out is None or size > self.most:
                        if out is not None:
                            out.close()
                        name = uuid.uuid4().hex
                        files.append((f"{self.path}/.{name}.warc.gz", f"{self.path}/{name}.warc.gz"))
                        out, size = _created(files[-1][0]), 0
                    data = member(value.as_buffer().to_pybytes() + b"\r\n\r\n")
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        for m in messages:
            for hidden, own in m.files if m else ():
                _moved(hidden, own)

    def abort(self, messages: list[Written | None]) -> None:
        for m in messages:
            for hidden, _ in m.files if m else ():
                _removed(hidden)


# ---- reading


@dataclass
class Files(InputPartition):
    paths: list[str]


def _store(path: str):
    """(file system, path) of pyarrow, or (None, local path)."""
    if path.startswith("file:"):
        return None, "/" + path[5:].lstrip("/")
    if "://" not in path:
        return None, path
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _listed(path: str) -> list[tuple[str, int]]:
    """Archives at or below a path, with their sizes; hidden and empty files are left out."""
    store, at = _store(path)
    if store is None:
        if os.path.isfile(at):
            return [(at, os.path.getsize(at))]
        found = [(os.path.join(d, f), os.path.getsize(os.path.join(d, f))) for d, _, files in os.walk(at) for f in files if f[0] not in "._"]
        return sorted(x for x in found if x[1])
    from pyarrow import fs

    scheme = path.split("://")[0]
    info = store.get_file_info(at)
    if info.type != fs.FileType.File:
        info = store.get_file_info(fs.FileSelector(at, allow_not_found=True, recursive=True))
    found = info if isinstance(info, list) else [info]
    return sorted((f"{scheme}://{x.path}", x.size) for x in found if x.type == fs.FileType.File and x.size and x.base_name[0] not in "._")


def _opened(path: str):
    store, at = _store(path)
    return open(at, "rb", buffering=1 << 16) if store is None else store.open_input_file(at)


def _created(path: str):
    store, at = _store(path)
    if store is not None:
        store.create_dir(os.path.dirname(at), recursive=True)
        return store.open_output_stream(at)
    os.makedirs(os.path.dirname(at), exist_ok=True)
    return open(at, "wb")


def _moved(source: str, target: str) -> None:
    store, at = _store(source)
    os.replace(at, _store(target)[1]) if store is None else store.move(at, _store(target)[1])


def _removed(path: str) -> None:
    store, at = _store(path)
    if store is not None:
        store.delete_file(at)
    elif os.path.exists(at):
        os.remove(at)


def headers_of(lines: list[bytes]) -> dict[str, str]:
    """Named fields by lower-case name; continuation lines are joined; the first of a name counts."""
    out: dict[str, str] = {}
    last = None
    for line in lines:
        if line[:1] in b" \t" and last:
            out[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, colon, value = line.partition(b":")
        last = name.strip().lower().decode("latin-1") if colon else None
        if last is not None and last not in out:
            out[last] = value.strip().decode("utf-8", "replace")
        elif last is not None:
            last = None
    return out


def records_of(stream, wanted, payload: str) -> Iterator[tuple]:
    """(offset, headers, HTTP head, payload bytes or None, its digest, its length) of the wanted records of an archive."""
    while True:
        at = stream.tell()
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        lines = []
        while (line := stream.readline()).strip():
            lines.append(line.rstrip(b"\r\n"))
        head = headers_of(lines)
        size = int(head["content-length"])
        begin = stream.tell()
        if not wanted(head):
            stream.seek(size, os.SEEK_CUR)
            continue
        http, data, digest, length = None, None, None, None
        if head.get("content-type", "").startswith("application/http"):
            http, left = [], size
            while left > 0 and (line := stream.readline(left)):
                left -= len(line)
                http.append(line)
                if not line.strip():
                    break
        left = begin + size - stream.tell()
        if http is not None and head.get("warc-type") == "revisit":
            length = int(headers_of(http[1:]).get("content-length", 0))
        else:
            length = left
            if payload != "none":
                data = stream.read(left)
                if len(data) != left:
                    raise ValueError(f"record at byte {at} is cut off")
                digest = hashlib.sha256(data).hexdigest()
        stream.seek(begin + size)
        yield at, head, None if http is None else b"".join(http).decode("latin-1"), data if payload == "bytes" else None, digest, length


def members_of(stream, wanted, payload: str, block: int = 1024) -> Iterator[tuple]:
    """The records of an archive whose members tell their length; from a member without that on, all is read through."""
    at = 0
    while True:
        stream.seek(at)
        first = stream.read(block)
        if not first:
            return
        if first[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at byte {at}")
        z = zlib.decompressobj(16 + zlib.MAX_WBITS)
        if not first[3] & 4 or first[12:14] != b"sl":
            stream.seek(at)
            yield from records_of(gzip.GzipFile(fileobj=stream), wanted, payload)
            return
        size = struct.unpack("<I", first[16:20])[0]
        data = z.decompress(first)
        end = data.find(b"\r\n\r\n")
        while end < 0 and not z.eof and (more := stream.read(block)):
            data += z.decompress(more)
            end = data.find(b"\r\n\r\n")
        lines = data[: max(end, 0)].split(b"\r\n")
        if end >= 0 and lines[0].startswith(b"WARC/") and not wanted(headers_of(lines[1:])):
            at += size
            continue
        parts = [data]
        while not z.eof and (more := stream.read(1 << 16)):
            parts.append(z.decompress(more))
        if not z.eof:
            raise ValueError(f"member at byte {at} is cut off")
        for _, *record in records_of(io.BytesIO(b"".join(parts)), wanted, payload):
            yield at, *record
        at += size


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options.get("path", "").split(",") if p]
        self.payload = options.get("payload", "digest")
        if self.payload not in ("none", "digest", "bytes"):
            raise ValueError("payload must be none, digest or bytes")
        self.most = int(options.get("partition_bytes", 64 << 20))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take what the header block alone can answer; Spark checks the rest."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name not in HEADERS:
                yield f
            elif isinstance(f, EqualTo):
                self.tests.append((HEADERS[name], "in", {f.value}))
            elif isinstance(f, In):
                self.tests.append((HEADERS[name], "in", set(f.value)))
            elif isinstance(f, StringStartsWith):
                self.tests.append((HEADERS[name], "starts", f.value))
            elif isinstance(f, IsNotNull):
                self.tests.append((HEADERS[name], "there", None))
            else:
                yield f

    def wanted(self, head: dict[str, str]) -> bool:
        for name, kind, value in self.tests:
            x = head.get(name)
            if x is None or kind == "in" and x not in value or kind == "starts" and not x.startswith(value):
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        files = [f for p in self.paths for f in _listed(p)]
        parts, own, size = [], [], 0
        for path, n in files:
            if own and size + n > self.most:
                parts.append(Files(own))
                own, size = [], 0
            own.append(path)
            size += n
        return [*parts, *([Files(own)] if own else [])] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        schema = _arrow_schema()
        rows, held = [], 0
        for path in partition.paths:
            with _opened(path) as stream:
                read = members_of if path.endswith(".gz") else records_of
                for at, head, http, data, digest, length in read(stream, self.wanted, self.payload):
                    rows.append((path, at, *[head.get(HEADERS[c]) for c in ("record_type", "record_id", "target_uri", "date", "content_type")],
                                 int(head["content-length"]), head.get("warc-payload-digest"), head.get("warc-refers-to"), http, length, digest, data))
                    held += 500 + len(data or b"")
                    if held > 4 << 20:
                        yield _batch(rows, schema)
                        rows, held = [], 0
        if rows:
            yield _batch(rows, schema)


def _arrow_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in SCHEMA.split(","))])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


class WarcSource(DataSource):
    """spark.read.format("warc").option("payload", "none" | "digest" | "bytes").load(path), df.write.format("warc").mode("append").save(path)"""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are appended to a folder, not overwritten")
        return WarcWriter(self.options)


def read(spark: SparkSession, path: str, payload: str = "digest") -> DataFrame:
    """The records of the archives at a path."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", payload).load(qualified(spark, path))


def page_digests(records: DataFrame) -> DataFrame:
    """Per page of the archives that ``write`` makes: size and digest of the full payload, type, and the page referred to."""
    number = lambda c: F.nullif(F.regexp_extract(F.coalesce(F.col(c), F.lit("")), r"^<urn:page:(\d+|-\d+)>$", 1), F.lit("")).cast("long")
    digest = F.coalesce("computed_digest", F.substring_index("payload_digest", ":", -1))
    return records.select(number("record_id").alias("page_id"), "payload_bytes", digest.alias("payload_digest"), "record_type", number("refers_to").alias("refers_to"))
