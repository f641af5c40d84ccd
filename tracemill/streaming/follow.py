"""Following growing trace files into the wide table and its rollups.

Spark's offset and commit logs take the place of checkpoints and a write-ahead log; each
micro-batch writes into its own ``batch`` folder with overwrite, so a replayed batch replaces itself
and nothing is lost or doubled.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.parse import to_rich
from ..operators.rollups import ROLLUPS, Rollup, build, merge
from ..sources import hadoop, techlog
from .metrics import Metrics, by_collection


def stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """Raw events of growing files."""
    return techlog.stream(spark, path, **options)


def write_batch(raw: DataFrame, batch: int, target: str, rollups: tuple[Rollup, ...] = ROLLUPS, fingerprints: bool = True, metrics: Metrics | None = None) -> None:
    """A micro-batch: its rows by day, and its share of each rollup."""
    sized = raw.withColumn("_bytes", F.col("end_off") - F.col("start_off")) if metrics else raw
    rich = to_rich(sized, fingerprints=fingerprints, keep=("_bytes",) if metrics else ()).drop("sql_norm").persist()
    try:
        rows = rich.drop("_bytes").sortWithinPartitions("event", "ts", "process_name", "session_id")
        rows.write.mode("overwrite").partitionBy("event_date").parquet(f"{target}/events/batch={batch}")
        for r in rollups:
            build(rich, r).write.mode("overwrite").parquet(f"{target}/{r.name}/batch={batch}")
        if metrics:
            metrics.add(by_collection(rich, "_bytes", saturated="param_count >= 65535" if fingerprints else "false").collect())
    finally:
        rich.unpersist()


def follow(
    spark: SparkSession, path: str, target: str, checkpoint: str, available_now: bool = False, interval: str = "1 second",
    metrics: Metrics | None = None, fingerprints: bool = True, **options,
) -> StreamingQuery:
    """Start following; ``available_now`` drains what is there and ends.  ``metrics`` counts by collection."""
    writer = stream(spark, path, **options).writeStream.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.foreachBatch(lambda df, batch: write_batch(df, batch, target, fingerprints=fingerprints, metrics=metrics)).start()


def supervise(
    start: Callable[[], StreamingQuery], attempts: int | None = None, first: float = 1.0, most: float = 30.0,
    sleep: Callable[[float], None] = time.sleep, metrics: Metrics | None = None,
) -> StreamingQuery:
    """Runs a query until it ends by itself or is stopped, and starts it again if it fails: after ``first`` seconds, then twice as many up to ``most``.

    A query that wrote a batch before it failed begins with ``first`` anew.  Nothing is lost or doubled, since the offsets are in the
    checkpoint and a batch replaces itself.  ``attempts`` failures in a row without a batch (a drain takes 3) raise the last one.
    """
    failed = 0
    while True:
        query = None
        try:
            query = start()
            query.awaitTermination()
            return query
        except Exception:
            failed = 1 if query is not None and query.lastProgress is not None else failed + 1
            if metrics:
                metrics.failed += 1
            if attempts is not None and failed >= attempts:
                raise
            sleep(min(most, first * 2 ** (failed - 1)))


def live(names: list[str]) -> dict[str, tuple[int, int, int]]:
    """Folders to read of ``batch=n`` and ``batch=a-b-g`` (a run of batches a to b, written anew for the g-th time): those that no other one covers."""
    spans = {}
    for n in names:
        found = re.fullmatch(r"batch=(\d+)(?:-(\d+)-(\d+))?", n)
        if found:
            a, b, g = found.groups()
            spans[n] = (int(a), int(b), int(g)) if b else (int(a), int(a), -1)
    # widest first, of equal ones the latest; a folder inside one already taken is left out
    out: dict[str, tuple[int, int, int]] = {}
    for n, (a, b, g) in sorted(spans.items(), key=lambda x: (x[1][0] - x[1][1], -x[1][2])):
        if not any(c <= a and b <= d for c, d, _ in out.values()):
            out[n] = (a, b, g)
    return dict(sorted(out.items(), key=lambda x: x[1]))


def _read(spark: SparkSession, top: str, names: list[str] | dict) -> DataFrame:
    return spark.read.option("basePath", top).parquet(*[f"{top}/{n}" for n in names]).drop("batch")


def _parts(spark: SparkSession, target: str, name: str) -> DataFrame:
    return _read(spark, f"{target}/{name}", live(hadoop.names(spark, f"{target}/{name}")))


def _swept(spark: SparkSession, top: str) -> dict[str, tuple[int, int, int]]:
    """The live folders but the newest, which may be written again; covered ones, left from a stop, are deleted."""
    found = hadoop.names(spark, top)
    kept = live(found)
    for n in found:
        if n.startswith("batch=") and n not in kept:
            hadoop.delete(spark, f"{top}/{n}")
    return dict(list(kept.items())[:-1])


def _written(spark: SparkSession, rows: DataFrame, top: str, old: dict[str, tuple[int, int, int]], by: tuple[str, ...] = ()) -> str:
    """Rows of old folders as a run that covers them: built aside and renamed, then the old ones go.  A stop at any place loses and doubles nothing."""
    spans = list(old.values())
    run = f"batch={spans[0][0]}-{spans[-1][1]}-{max(g for _, _, g in spans) + 1}"
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(f"{top}/_{run}")
    hadoop.rename(spark, f"{top}/_{run}", f"{top}/{run}")
    for n in old:
        hadoop.delete(spark, f"{top}/{n}")
    return run


def compact(spark: SparkSession, target: str, name: str, most: int = 1000) -> str | None:
    """Puts the oldest ``most`` folders of ``events`` or of a rollup into one run; returns its name."""
    top = f"{target}/{name}"
    old = dict(list(_swept(spark, top).items())[:most])
    if len(old) < 2:
        return None
    rows = _read(spark, top, old)
    rollups = {r.name: r for r in ROLLUPS}
    if name in rollups:
        return _written(spark, merge(rows, rollups[name]), top, old)
    rows = rows.hint("rebalance", "event_date").sortWithinPartitions("event_date", "event", "ts", "process_name", "session_id")
    return _written(spark, rows, top, old, ("event_date",))


def retain(spark: SparkSession, target: str, today: str, days: int = 90, rollup_days: int = 400) -> list[str]:
    """Drops whole days of events older than ``days`` by event time, and rows of rollups older than ``rollup_days``; returns the days dropped.

    A rollup's folders with such rows are written anew, but for the newest, which a later call reaches.
    """
    limit, old = (str(date.fromisoformat(today) - timedelta(days=d)) for d in (days, rollup_days))
    gone = set()
    for n in hadoop.names(spark, f"{target}/events"):
        for day in hadoop.names(spark, f"{target}/events/{n}"):
            if day.startswith("event_date=") and day[11:] < limit and hadoop.delete(spark, f"{target}/events/{n}/{day}"):
                gone.add(day[11:])
    for r in ROLLUPS:
        top, time_column = f"{target}/{r.name}", next(iter(r.keys))
        for n, span in _swept(spark, top).items():
            rows = _read(spark, top, [n])
            kept = F.col(time_column) >= F.lit(old).cast("timestamp_ntz")
            if rows.filter(~kept).limit(1).count():
                _written(spark, rows.filter(kept), top, {n: span})
    return sorted(gone)


def events(spark: SparkSession, target: str) -> DataFrame:
    return _parts(spark, target, "events")


def rollup(spark: SparkSession, target: str, r: Rollup) -> DataFrame:
    """A rollup's partial rows of all batches, merged."""
    return merge(_parts(spark, target, r.name), r)


def windowed(raw: DataFrame, late: str = "10 minutes", width: str = "1 minute") -> DataFrame:
    """Counts by event-time window with a watermark, for streams that may drop late rows."""
    timed = raw.select(F.to_timestamp("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), "event", F.col("duration").cast("bigint").alias("duration_us"))
    return timed.withWatermark("ts", late).groupBy(F.window("ts", width), "event").agg(F.count("*").alias("cnt"), F.sum("duration_us").alias("dur_sum"))
