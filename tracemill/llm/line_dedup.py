"""Line deduplication over levelled sorted runs of line hashes (operator 10).

A run is a table of (line hash, documents, largest doc_id), bucketed and sorted by hash, so that
runs are merge-joined with each other without another shuffle or sort.  Documents arrive in batches.  Each batch is
summed up first, then merge-anti-joined with the runs: hashes that no run holds are fresh and become the batch's own run;
the others are seen and go to the (small) tables of repeats.  So a hash is in one run at most, hashes that come once take part in nothing
else, and only repeats, the runs' rows of repeated hashes and fresh rows that are common by themselves are added up.
When a level has FANOUT runs they are merged into one of the next level, so a batch meets a logarithmic number of runs.

A line's key is the line without ``[\x20\x09-\x0D]`` at its ends and with A-Z in
lower case.  Keys of ``min_chars`` code points or more that are found in
``min_docs`` documents or more lose all their lines except in the largest
doc_id holding them.

Defined cases: a null or empty text is one empty line; rows that repeat a doc_id
count as one document, and all rows of the largest doc_id keep their lines; a
null doc_id is a document below all others (its rows count as one document);
an empty table gives an empty result; extra columns are carried by
``drop_lines`` and ignored by ``line_counts``, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from . import shared
from .tokens import Texts, hash_spans, lines_of, lowered, signed, sliced, stripped, texts_of

MIN_CHARS, MIN_DOCS, BATCHES, FANOUT = 40, 5, 4, 3
_NULL_ID = -(1 << 63)


def _long_lines(t: Texts, min_chars: int):
    """Lines of the texts, which of them count, and two hashes of the keys of those."""
    lines = lines_of(t)
    low = lowered(t)
    key = stripped(low, lines)
    long = np.flatnonzero(key.end - key.start >= min_chars)  # bytes; then code points
    inner = (low.buf[: low.size] & 0xC0) == 0x80
    if inner.any():
        at = np.zeros(low.size + 1, np.int32)
        np.cumsum(inner, out=at[1:])
        s, e = key.start[long], key.end[long]
        long = long[e - s - (at[e] - at[s]) >= min_chars]
    s, e = key.start[long], key.end[long]
    return lines, long, signed(hash_spans(low, s, e, 1)), signed(hash_spans(low, s, e, 2))


KEYS = "doc_id long, tid long, h1 long, h2 long, lines array<int>"


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """KEYS: each key of each row of the input once, with the numbers of its lines; tid is xxhash64 of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch):
                lines, long, h1, h2 = _long_lines(texts_of(part.column("text")), min_chars)
                doc = lines.doc[long]
                order = np.lexsort((h2, h1, doc))
                d, a, b = doc[order], h1[order], h2[order]
                new = np.ones(len(d), bool)
                new[1:] = (d[1:] != d[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
                own = pa.array(d[new])
                number = (long - lines.first[doc])[order].astype(np.int32)
                off = np.append(np.flatnonzero(new), len(d)).astype(np.int32)
                cols = [part.column("doc_id").take(own), part.column("tid").take(own), pa.array(a[new]), pa.array(b[new]), pa.ListArray.from_arrays(pa.array(off), pa.array(number))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "tid", "h1", "h2", "lines"])

    return _narrow(docs).mapInArrow(run, KEYS)


def _narrow(docs: DataFrame) -> DataFrame:
    text = docs["text"].cast("string")
    return docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(_NULL_ID)).alias("doc_id"), text.alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("tid"))


class LineRuns:
    """Levelled sorted runs of line hashes: external tables in the shared folder."""

    COLUMNS = ("h1", "h2", "n_docs", "max_doc")

    def __init__(self, spark: SparkSession, path: str | None = None, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.path, self.fanout = spark, path or shared.new_path(spark, "line-runs"), fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.repeats: list[str] = []
        self.made = 0

    def _write(self, df: DataFrame) -> str:
        """A bucketed table, each bucket one sorted file."""
        name, self.made = f"line_run_{uuid.uuid4().hex}", self.made + 1
        rows = df.select(*self.COLUMNS).repartition(self.buckets, "h1", "h2")
        writer = rows.write.format("parquet").option("compression", "zstd").option("path", f"{self.path}/{name}")
        writer.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        shared.drop_path(self.spark, f"{self.path}/{name}")

    def clear(self) -> None:
        """Delete all tables."""
        for name in [*self.runs(), *self.repeats]:
            self._drop(name)
        self.levels, self.repeats = [[]], []

    def _summed(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("max_doc").alias("max_doc"))

    def _all(self, names: list[str]) -> DataFrame:
        """The rows of tables one after the other, read as plain files: a union of bucketed scans must not pass for bucketed."""
        schema = "h1 long, h2 long, n_docs long, max_doc long"
        paths = [f"{self.path}/{name}" for name in names]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def common(self, min_docs: int) -> DataFrame:
        """(h1, h2, n_docs, max_doc) of the hashes that ``min_docs`` documents or more have."""
        rows = self._all(self.runs()).filter(F.col("n_docs") >= min_docs)
        if self.repeats:
            self.repeats = [self._write(self._summed(self._all(old := self.repeats)))]
            for name in old:
                self._drop(name)
            rows = rows.unionByName(self._all(self.repeats))
            again = self.spark.table(self.repeats[0]).select("h1", "h2").hint("merge")
            for name in self.runs():  # rows that are common by themselves are there already
                rows = rows.unionByName(self.spark.table(name).filter(F.col("n_docs") < min_docs).join(again, ["h1", "h2"], "left_semi"))
        return self._summed(rows).filter(F.col("n_docs") >= min_docs)

    def add(self, keys: DataFrame) -> None:
        """Add a batch of (doc_id, h1, h2); all rows of a doc_id must be in one batch."""
        own = keys.groupBy("h1", "h2").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("max_doc"))
        if not self.runs():
            self.levels[0].append(self._write(own))
            return
        # tables of one sorted file a bucket are as sorted as their files
        ordering = "spark.sql.legacy.bucketedTableScan.outputOrdering"
        before = self.spark.conf.get(ordering, "false")
        self.spark.conf.set(ordering, "true")
        try:
            batch = self._write(own)
            fresh = self.spark.table(batch)
            for name in self.runs():
                fresh = fresh.join(self.spark.table(name).select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
            run = self._write(fresh)
            seen = self.spark.table(batch).join(self.spark.table(run).select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
            self.repeats.append(self._write(seen))
            self._drop(batch)
            self.levels[0].append(run)
            self._compact()
        finally:
            self.spark.conf.set(ordering, before)

    def _compact(self) -> None:
        """A full level becomes one run of the next; a hash is in one run only, so nothing is added up."""
        for i, level in enumerate(self.levels):
            if len(level) < self.fanout:
                continue
            whole = self._write(self._all(level))
            for old in level:
                self._drop(old)
            self.levels[i] = []
            if i + 1 == len(self.levels):
                self.levels.append([])
            self.levels[i + 1].append(whole)


def _dropped(docs: DataFrame, min_chars: int, min_docs: int, batches: int) -> DataFrame:
    """(doc_id, tid, drop): the numbers of the lines that a document must lose."""
    spark = docs.sparkSession
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    keys = shared.stored(line_keys(docs, min_chars).withColumn("batch", batch), "line-keys", "batch")
    runs = LineRuns(spark)
    for b in range(batches):
        runs.add(keys.filter(F.col("batch") == b).select("doc_id", "h1", "h2"))
    common = shared.stored(runs.common(min_docs).withColumnsRenamed({"h1": "_a", "h2": "_b"}), "line-common")
    runs.clear()
    lost = shared.spread_join(keys, common, ["h1", "h2"], ["_a", "_b"], "n_docs").filter("doc_id < max_doc")
    return lost.groupBy("doc_id", "tid").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("drop"))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes], np.ndarray, np.ndarray]]:
    """For each slice: its rows, the kept texts, the lines before, the lines dropped."""
    for batch in batches:
        for part in sliced(batch):
            t = texts_of(part.column("text"))
            lines = lines_of(t)
            drop = part.column("drop")
            lost = np.asarray(pc.fill_null(pc.list_value_length(drop), 0)).astype(np.int64)
            out = []
            for i in range(t.n):
                if lost[i]:
                    own = np.delete(np.arange(lines.first[i], lines.first[i + 1]), np.asarray(drop[i].values))
                    out.append(b"\n".join(t.buf[a:b].tobytes() for a, b in zip(lines.start[own].tolist(), lines.end[own].tolist(), strict=True)))
                else:
                    out.append(t.raw(i))
            yield part, out, np.diff(lines.first), lost


def _with_drops(docs: DataFrame, drops: DataFrame) -> DataFrame:
    """Each document (doc_id, tid, ...) with the lines that it loses (null: none); the small side is hashed, texts aren't sorted."""
    right = drops.withColumnsRenamed({"doc_id": "_d", "tid": "_t"}).hint("shuffle_hash")
    return docs.join(right, (F.col("doc_id") == F.col("_d")) & (F.col("tid") == F.col("_t")), "left").drop("_d", "_t")


def line_counts(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256, kept_chars) of each document."""
    slim = _narrow(docs)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, out, n, lost in _kept(rows):
            sha = [hashlib.sha256(x).hexdigest() for x in out]
            left = [len(x.decode()) for x in out]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), pa.array(lost.astype(np.int64)), pa.array(sha), pa.array(left, pa.int64())], ["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept_chars"])

    out = _with_drops(slim, _dropped(docs, min_chars, min_docs, batches)).mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string, kept_chars long")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(_NULL_ID)))


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """The documents with the kept lines as text; all other columns as they were (n_chars, if a column of that name is there, is counted anew)."""
    text = docs["text"].cast("string")
    key = F.coalesce(docs["doc_id"].cast("long"), F.lit(_NULL_ID)).alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("tid")
    rest = [c for c in docs.columns if c != "text"]
    wide = docs.select(F.struct(*[docs[c] for c in rest]).alias("rest"), text.alias("text"), *key)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, out, _, _ in _kept(rows):
            null = np.asarray(part.column("text").is_null())
            text = [None if z else x.decode() for x, z in zip(out, null, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("rest"), pa.array(text, pa.string())], ["rest", "text"])

    schema = StructType([StructField("rest", wide.schema["rest"].dataType), StructField("text", wide.schema["text"].dataType)])
    out = _with_drops(wide, _dropped(docs, min_chars, min_docs, batches)).drop("doc_id", "tid").mapInArrow(run, schema)
    size = F.length(F.coalesce("text", F.lit(""))).cast("long")
    pick = {"text": F.col("text"), "n_chars": size.alias("n_chars")}
    return out.select(*[pick.get(c, F.col("rest").getField(c).alias(c)) for c in docs.columns])
