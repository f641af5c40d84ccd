"""The folder that driver and executors share, bounded bitmaps, and typed helpers."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; only where that is unset and all runs on this machine (tests) a new local one."""
    sc = spark.sparkContext
    at = sc._jsc.sc().getCheckpointDir()
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf and at.isDefined():
        conf = at.get()
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("a cluster needs a folder that all machines share in spark.checkpoint.dir")
        conf = tempfile.mkdtemp(prefix="tracemill-")
        sc.setCheckpointDir(conf)
    return conf.rstrip("/")


#: Folders made by this process, in order.
_made: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    _made.append(f"{shared_dir(spark)}/tracemill/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def mark() -> int:
    """The state before some work, for ``release``."""
    return len(_made)


def release(spark: SparkSession, since: int, *keep: str) -> None:
    """Delete the folders made since a mark but for those given; call it when no result reads them any more."""
    for path in _made[since:]:
        if path not in keep:
            drop_path(spark, path)
    _made[since:] = keep


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage, and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def collected(spark: SparkSession) -> None:
    """Have the driver's JVM collect the plans, broadcasts and shuffles of results already stored, and give back the heap they took.

    Left to itself the heap of a driver grows to its limit before old plans and their compiled classes go.
    """
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Return to the system what this process has freed: the allocators of C and of Arrow keep most of it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function for ``mapInArrow``, after which a worker gives its memory back: it waits for its next task beside stages that run in the JVM alone."""

    def lean_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return lean_run


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder made by this subpackage, through Hadoop's file systems."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: A key is heavy if it has more than one in HEAVY of all rows, so there are fewer than HEAVY such keys, whatever the input; LIGHT rows are never many.
HEAVY, LIGHT = 1024, 500


def spread_join(left: DataFrame, right: DataFrame, left_on: list[str], right_on: list[str], n: str, how: str = "inner") -> DataFrame:
    """Join ``left`` with ``right``, which has one row a key and in ``n`` the rows that the key has in ``left``; names don't overlap.

    Heavy keys are broadcast (fewer than HEAVY rows of ``right``), so that their rows stay where they are; all other keys are
    shuffled, and none of them has more than one in HEAVY of the rows.  Both sides are read twice: give stored tables.  how: inner, left_semi or left_anti.
    """
    total, most = right.agg(F.sum(n), F.max(n)).head()
    limit = max(LIGHT, (total or 0) // HEAVY)
    heavy, light = right.filter(F.col(n) > limit), right.filter(F.col(n) <= limit)
    on = [F.col(a) == F.col(b) for a, b in zip(left_on, right_on, strict=True)]
    if (most or 0) <= limit:
        return left.join(right, on, how)
    rest = left.join(F.broadcast(heavy.select(*right_on)), on, "left_anti")
    rest = rest.join(light, on, how)
    return rest if how == "left_anti" else left.join(F.broadcast(heavy), on, how).unionByName(rest)


def unused(name: str, *frames: DataFrame) -> str:
    """The name, with underscores in front until no column of the frames has it."""
    have = {c.lower() for df in frames for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


#: Bits of a bitmap: its size is fixed (2 MiB at 24), whatever the input.
BITMAP_BITS = 24


def bitmap(df: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bitmap (2**bits bits, bytes of numpy) of the lowest bits of a long column.

    At most 2**bits / 32768 rows of 4 KiB reach the driver: a bound that
    does not depend on the data.  A set bit may be a false alarm, a clear bit
    never is; who uses it must settle alarms by a join.
    """
    low = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    rows = (
        df.select(low.alias("b"))
        .groupBy(F.bitmap_bucket_number("b").alias("k"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("m"))
        .collect()
    )
    out = np.zeros((1 << bits) // 8 + 4096, np.uint8)
    for k, m in rows:  # bucket 0 holds only the value 0 (bit 0), bucket k the values from (k - 1) * 32768 + 1
        full = np.unpackbits(np.frombuffer(bytes(m), np.uint8), bitorder="little")
        at = np.flatnonzero(full)
        values = at + (k - 1) * 32768 + 1 if k > 0 else -at
        np.bitwise_or.at(out, values >> 3, (1 << (values & 7)).astype(np.uint8))
    return out


def in_bitmap(bits_of: np.ndarray, h: np.ndarray, bits: int = BITMAP_BITS) -> np.ndarray:
    low = (h & np.uint64((1 << bits) - 1)).astype(np.int64)
    return (bits_of[low >> 3] >> (low & 7).astype(np.uint8)) & 1 == 1


def clear(spark: SparkSession) -> None:
    """Delete all intermediate tables of this subpackage; call it when no result that reads them is needed any more."""
    drop_path(spark, f"{shared_dir(spark)}/tracemill")
