"""The ``techlog`` data source: directories of trace files, in batch and as a stream.

Batch: files are cut into byte ranges, so that one large file feeds many tasks, and small files and short ranges are packed into one; the reader
of a range takes the events that begin in it and reads on to the end of the last, and little beyond.  Predicates on ``file_hour`` (the
hour in a file's name) prune files before anything is opened; ``collection`` likewise.

Stream: the offset holds, for each file by identity (device and inode), the generation and the
committed byte.  A file that shrank or was replaced begins anew with the next generation.  An
event is closed by the next one, or by quiet: if the file wasn't written for ``idle_ms`` and ends
with a line end, its last event is complete.  That decision is made when the offset is, so that a batch
can be replayed.
"""

from __future__ import annotations

import json
import os
import re
import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
)

from ..operators.parse import parse_events
from . import grammar as G

SCHEMA = (
    "file_path string, filename string, collection string, file_hour string, start_off long, end_off long, body string"
)
BOM = b"\xef\xbb\xbf"
#: Ranges shorter than a task's bytes are packed into so many tasks, or more where those would exceed the task's bytes.
TASKS = 256


@dataclass(frozen=True)
class Options:
    """Checked options with their defaults and ranges."""

    path: str
    min_size: int = 100
    range_bytes: int = 16 << 20
    task_bytes: int = 16 << 20
    open_cost: int = 64 << 10
    idle_ms: int = 2000
    max_bytes_per_trigger: int = 256 << 20
    separator: str = "\\"

    RANGES = {"min_size": (0, 1 << 30), "range_bytes": (1, 1 << 40), "task_bytes": (1, 1 << 40), "open_cost": (0, 1 << 30), "idle_ms": (0, 3_600_000), "max_bytes_per_trigger": (1, 1 << 50)}

    @classmethod
    def of(cls, options: dict) -> Options:
        names = {"path": "path", "separator": "separator"} | {k.replace("_", ""): k for k in cls.RANGES} | {k: k for k in cls.RANGES}
        given = {}
        for k, v in options.items():
            name = names.get(k.lower())
            if name is None:
                raise ValueError(f"unknown option {k}")
            given[name] = v
        if not given.get("path"):
            raise ValueError("the option path is missing")
        for k, (low, high) in cls.RANGES.items():
            if k in given:
                given[k] = int(given[k])
                if not low <= given[k] <= high:
                    raise ValueError(f"{k} must be between {low} and {high}")
        return cls(**given)


@dataclass(frozen=True)
class Range:
    path: str
    start: int
    end: int
    closed: bool = False  # the last event ends at ``end``, nothing is read beyond


@dataclass(frozen=True)
class Pack(InputPartition):
    """Ranges that one task reads one after the other."""

    ranges: tuple[Range, ...]


def packed(ranges: list[Range], most: int, open_cost: int) -> list[Pack]:
    """Ranges in order, together while their bytes and what opening costs stay within ``most``."""
    out, own, size = [], [], 0
    for r in ranges:
        cost = r.end - r.start + open_cost
        if own and size + cost > most:
            out.append(Pack(tuple(own)))
            own, size = [], 0
        own.append(r)
        size += cost
    return [*out, Pack(tuple(own))]


@dataclass
class Walked:
    """Trace files (path, size), largest first; files too small, and folders or files that could not be read."""

    files: list[tuple[str, int]]
    small: int = 0
    errors: int = 0


def remote(path: str) -> bool:
    return "://" in path and not path.startswith("file:")


def _file_system(path: str):
    """A file system of pyarrow and the path in it (hdfs, s3, gs, ...); credentials come from the environment of the machine."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _short(path: str, separator: str) -> str:
    return G.relative_path(path.split("://", 1)[1] if remote(path) else path, separator)


def opened(path: str):
    """A seekable stream of a file's bytes."""
    if not remote(path):
        return open(path, "rb")
    system, inner = _file_system(path)
    return system.open_input_file(inner)


def census(paths: str, min_size: int) -> Walked:
    """What lies at or below comma-separated paths, which may be local or URIs."""
    out = Walked([])

    def seen(name: str, size: int) -> None:
        if size >= min_size:
            out.files.append((name, size))
        else:
            out.small += 1

    def failed(_: OSError) -> None:
        out.errors += 1

    for top in filter(None, paths.split(",")):
        if remote(top):
            from pyarrow import fs

            system, inner = _file_system(top)
            head = top[: len(top) - len(inner)] if top.endswith(inner) else top.split("://")[0] + "://"
            info = system.get_file_info(inner)
            below = [info] if info.is_file else system.get_file_info(fs.FileSelector(inner, recursive=True))
            for x in below:
                if x.is_file and (x is info or x.path.endswith(".log")):
                    seen(head + x.path, x.size)
            continue
        top = "/" + top[5:].lstrip("/") if top.startswith("file:") else top
        names = [top] if os.path.isfile(top) else [os.path.join(d, f) for d, _, files in os.walk(top, onerror=failed) for f in files if f.endswith(".log")]
        for name in names:
            try:
                seen(name, os.path.getsize(name))
            except OSError:
                out.errors += 1  # gone, or not to be read
    out.files.sort(key=lambda x: (-x[1], x[0]))
    return out


def walk(paths: str, min_size: int) -> tuple[list[tuple[str, int]], int]:
    """Trace files (path, size), largest first, and how many were too small."""
    found = census(paths, min_size)
    return found.files, found.small


def events_of(stream, start: int, end: int, closed: bool = False, block: int = 8 << 20, tail: int = 4 << 10) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, bytes) of the events that begin in [start, end) of a file; memory is a block and the largest event.

    A range shorter than a block is read with a tail for its last event; where that isn't enough, reads double.  Only whole lines are looked at, so a mask is never cut.  ``closed``: nothing beyond ``end`` belongs to the last event.
    """
    base = start - 1 if start > len(BOM) else 0  # the byte before tells whether a line begins at ``start``
    stream.seek(base)
    data, seen, pending, more = b"", 0, None, b"x"
    step = min(block, end - base + tail)
    while more:
        more = stream.read(min(step, end - base - len(data)) if closed else step)
        step = min(block, 2 * step)
        data += more
        if base == 0 and data.startswith(BOM):
            data, base = data[len(BOM) :], len(BOM)
        limit = data.rfind(b"\n") + 1 if more else len(data)
        for at in G.event_starts(data, seen, limit):
            s = base + at
            if s < start or s == pending:
                continue
            if pending is not None:
                yield pending, s, data[pending - base : at]
            if s >= end:
                return
            pending = s
        seen = max(seen, limit)
        if pending is None and base + seen >= end:
            return
        # an open event is kept, else the last line end, so that the next line is known to begin there
        keep = pending - base if pending is not None else max(0, seen - 1)
        data, base, seen = data[keep:], base + keep, seen - keep
    if pending is not None:
        yield pending, base + len(data), data


def _strings(bodies: list[bytes]) -> pa.Array:
    """Texts; bytes that are no UTF-8 are replaced."""
    try:
        return pa.array(bodies, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.decode("utf-8", "replace") for x in bodies])


def _cut(part: Range, step: int) -> Iterator[Range]:
    """The ranges of at most ``step`` bytes of a part of a file; a closed one stays whole."""
    if part.closed:
        yield part
    else:
        yield from (Range(part.path, a, min(a + step, part.end)) for a in range(part.start, part.end, step))


def _rows(pack: Pack, options: Options, gone: bool = False) -> Iterator[pa.RecordBatch]:
    """The events' texts with their places; they are parsed by native expressions (``load``).  ``gone``: files may be missing by now."""
    separator = options.separator
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        *texts, a, b, bodies = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([*(pa.array(x, pa.string()) for x in texts), pa.array(a, pa.int64()), pa.array(b, pa.int64()), _strings(bodies)], names)

    rows, held = [], 0
    for part in pack.ranges:
        name = re.split(r"[/\\]", part.path)[-1]
        short = _short(part.path, separator)
        fixed = (short, name, short.split(separator)[0], G.date_prefix(name)[:-1])
        try:
            stream = opened(part.path)
        except FileNotFoundError:
            if gone:
                continue
            raise
        with stream:
            for own in _cut(part, options.range_bytes):
                for row in events_of(stream, own.start, own.end, own.closed):
                    rows.append(fixed + row)
                    held += len(row[2])
                    if held > 4 << 20 or len(rows) >= 10_000:
                        yield batch(rows)
                        rows, held = [], 0
    if rows:
        yield batch(rows)


class TraceReader(DataSourceReader):
    def __init__(self, options: Options):
        self.options = options
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        kinds = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in ("file_hour", "collection") and type(f) in kinds:
                self.tests.append((name, kinds[type(f)], f.value))
            elif name in ("file_hour", "collection") and isinstance(f, In):
                self.tests.append((name, "in", set(f.value)))
            else:
                yield f

    def wanted(self, path: str) -> bool:
        short = _short(path, self.options.separator)
        have = {"file_hour": G.date_prefix(re.split(r"[/\\]", path)[-1])[:-1], "collection": short.split(self.options.separator)[0]}
        ops = {"=": lambda a, b: a == b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, "in": lambda a, b: a in b}
        return all(ops[op](have[name], value) for name, op, value in self.tests)

    def partitions(self) -> list[Pack]:
        files = [(p, n) for p, n in walk(self.options.path, self.options.min_size)[0] if self.wanted(p)]
        own, cost = self.options.range_bytes, self.options.open_cost
        # a task has one range or several of a file, which its reader cuts again
        most = max(own, min(self.options.task_bytes, sum(n + cost for _, n in files) // TASKS))
        step = most // own * own
        return packed([Range(p, a, min(a + step, n)) for p, n in files for a in range(0, n, step)], most, cost)

    def read(self, partition: Pack) -> Iterator[pa.RecordBatch]:
        return _rows(partition, self.options)


class TraceStream(DataSourceStreamReader):
    def __init__(self, options: Options):
        self.options = options
        self.last: dict = {}

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def latestOffset(self) -> dict:
        """Advances each file to where its events are closed; a trigger's bytes are shared out, smallest rest first, so no file waits for a large one."""
        state, left, open_files = dict(self.last), self.options.max_bytes_per_trigger, []
        for path, size in walk(self.options.path, self.options.min_size)[0]:
            info = os.stat(path)
            key = f"{info.st_dev}:{info.st_ino}"
            old = state.get(key, {"path": path, "gen": 0, "off": 0})
            if size < old["off"]:
                old = {"path": path, "gen": old["gen"] + 1, "off": 0}
            open_files.append((size - old["off"], path, key, old))
        open_files.sort(key=lambda x: x[:2])
        for k, (_, path, key, old) in enumerate(open_files):
            with open(path, "rb") as f:
                info = os.fstat(f.fileno())
                size = f.seek(0, os.SEEK_END)  # what the open handle sees
                if f"{info.st_dev}:{info.st_ino}" != key or size < old["off"]:
                    continue  # replaced meanwhile: the next trigger sees it
                quiet = (time.time() - info.st_mtime) * 1000 >= self.options.idle_ms
                share = max(1, left // (len(open_files) - k))
                off = _closed_until(f, old["off"], min(size, old["off"] + share), size, quiet)
                left = max(0, left - (off - old["off"]))
                state[key] = {"path": path, "gen": old["gen"], "off": off}
        self.last = state
        return {"files": json.dumps(state, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Pack]:
        before, after = json.loads(start["files"]), json.loads(end["files"])
        self.last = self.last or after
        out = []
        for key, now in after.items():
            old = before.get(key, {"gen": now["gen"], "off": 0})
            begin = old["off"] if old["gen"] == now["gen"] else 0
            if now["off"] > begin:
                out.append(Range(now["path"], begin, now["off"], True))
        return packed(out, max(self.options.range_bytes, self.options.task_bytes), self.options.open_cost) if out else []

    def read(self, partition: Pack) -> Iterator[pa.RecordBatch]:
        return _rows(partition, self.options, gone=True)  # rotated away since the offset was made

    def commit(self, end: dict) -> None:
        self.last = json.loads(end["files"])


def _closed_until(f, begin: int, end: int, size: int, quiet: bool, tail: int = 64 << 10) -> int:
    """The place up to which events are complete: the last event's start, or the end of a quiet file that ends a line.

    Only the tail is read, in blocks that double until an event begins in one.  An event larger than a trigger's
    bytes is read on until it is closed.
    """
    if quiet and end == size and end > begin:
        f.seek(end - 1)
        if f.read(1) == b"\n":
            return end
    while end > begin:
        step = tail
        while True:
            low = max(begin, end - step)
            base = max(begin, low - 1)  # the byte before tells whether a line begins at ``low``
            f.seek(base)
            later = [base + k for k in G.event_starts(f.read(end - base)) if base + k > begin and (k or base == begin)]
            if later:
                return later[-1]
            if low == begin:
                break
            step *= 2
        if end == size:
            break
        end = min(size, begin + 2 * (end - begin))
    return begin


class TraceSource(DataSource):
    """The events' texts; ``load`` and ``stream`` parse them."""

    @classmethod
    def name(cls) -> str:
        return "techlog"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TraceReader:
        return TraceReader(Options.of(dict(self.options)))

    def streamReader(self, schema) -> TraceStream:
        if any(map(remote, self.options.get("path", "").split(","))):
            raise ValueError("a stream follows files by device and inode, so only local paths")
        return TraceStream(Options.of(dict(self.options)))


def register(spark) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TraceSource)


def parsed(bodies: DataFrame, rejected: bool = False) -> DataFrame:
    """Raw events of the source's rows: header and properties are read in the JVM, and properties only of events that later filters keep.

    ``rejected``: texts without a header stay, marked by ``parse_error``; else they are left out.
    """
    step = parse_events(bodies)
    step = step if rejected else step.filter(~F.col("parse_error")).drop("parse_error")
    stamp = F.concat(F.when(F.col("file_hour") != "", F.concat("file_hour", F.lit(":"))).otherwise(F.lit("")), F.col("time"))
    return step.withColumn("time", stamp).withColumnRenamed("time", "timestamp")


def load(spark: SparkSession, path: str, rejected: bool = False, **options) -> DataFrame:
    """Raw events of trace files: file_path, filename, collection, file_hour, start_off, end_off, timestamp, duration, event, level, props."""
    register(spark)
    return parsed(spark.read.format("techlog").options(**{k: str(v) for k, v in options.items()}).load(path), rejected)


def stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """Raw events of growing files."""
    register(spark)
    return parsed(spark.readStream.format("techlog").options(**{k: str(v) for k, v in options.items()}).load(path))
