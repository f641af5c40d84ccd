"""Ingest metrics: observed in the plan, kept by a listener, shown as Prometheus text."""

from __future__ import annotations

import time
from datetime import timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

LATENCY_BOUNDS = (0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)


def observed(raw: DataFrame, name: str = "ingest") -> tuple[DataFrame, Observation]:
    """Counts events, their bytes, rejected headers (if parse_error is there) and the newest time while the rows pass."""
    o = Observation(name)
    errors = F.count_if(F.col("parse_error")) if "parse_error" in raw.columns else F.lit(0)
    size = F.sum(F.col("end_off") - F.col("start_off")) if "end_off" in raw.columns else F.lit(0)
    newest = F.max("timestamp" if "timestamp" in raw.columns else "time")
    figures = {"events": F.count(F.lit(1)), "parse_skips": F.coalesce(errors, F.lit(0)), "event_bytes": F.coalesce(size, F.lit(0)), "newest": newest}
    return raw.observe(o, *[x.alias(c) for c, x in figures.items()]), o


def stats(raw: DataFrame, files: int, small: int) -> dict:
    """The figures of a batch run; the rows are read once."""
    df, o = observed(raw)
    df.write.format("noop").mode("overwrite").save()
    return {"files": files, "small_file_skips": small} | o.get


def by_collection(rich: DataFrame, size: str = "0", time_column: str = "ts", saturated: str = "false") -> DataFrame:
    """A row a collection: events, bytes, the newest event's time, and texts with more parameters than are counted."""
    return rich.groupBy("collection").agg(
        F.count("*").alias("events"), F.sum(F.expr(size)).cast("bigint").alias("bytes"), F.max(time_column).alias("newest"), F.count_if(F.expr(saturated)).alias("saturated")
    )


class Metrics(StreamingQueryListener):
    """Counters of streaming queries, and of what they read by collection (``follow(metrics=...)`` adds each batch)."""

    def __init__(self) -> None:
        self.batches = self.rows = self.failed = self.saturated = 0
        self.seconds: list[float] = []
        self.collections: dict[str, dict] = {}

    def add(self, rows: list) -> None:
        """Rows of ``by_collection``; the newest time never goes back."""
        for r in rows:
            own = self.collections.setdefault(r["collection"], {"events": 0, "bytes": 0, "newest": None})
            own["events"] += r["events"]
            own["bytes"] += r["bytes"] or 0
            own["newest"] = max(filter(None, (own["newest"], r["newest"])), default=None)
            self.saturated += r["saturated"]

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.batches += 1
        self.rows += event.progress.numInputRows
        self.seconds.append(event.progress.durationMs.get("triggerExecution", 0) / 1000)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.failed += bool(event.exception)

    def text(self, newest: float | None = None, now: float | None = None) -> str:
        """Prometheus text; a lag is not below 0, and the sources' clock (local time, read as UTC) is mapped on ``now``."""
        now = time.time() if now is None else now
        lines = [
            f"tracemill_batches_total {self.batches}", f"tracemill_events_total {self.rows}", f"tracemill_failed_queries_total {self.failed}",
            f"tracemill_saturated_texts_total {self.saturated}",
        ]
        for le in LATENCY_BOUNDS:
            lines.append(f'tracemill_batch_seconds_bucket{{le="{le}"}} {sum(s <= le for s in self.seconds)}')
        lines += [
            f'tracemill_batch_seconds_bucket{{le="+Inf"}} {len(self.seconds)}', f"tracemill_batch_seconds_sum {sum(self.seconds):g}",
            f"tracemill_batch_seconds_count {len(self.seconds)}",
        ]
        if newest is not None:
            lines.append(f"tracemill_lag_seconds {max(0.0, now - newest):g}")
        for name, own in sorted(self.collections.items()):
            label = '{collection="' + name.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n") + '"}'
            lines += [f"tracemill_collection_events_total{label} {own['events']}", f"tracemill_collection_read_bytes_total{label} {own['bytes']}"]
            if own["newest"] is not None:
                lag = now - own["newest"].replace(tzinfo=timezone.utc).timestamp()
                lines.append(f"tracemill_collection_lag_seconds{label} {max(0.0, lag):g}")
        return "\n".join(lines) + "\n"


def alerts(lag_seconds: float, failed: int, up: bool) -> list[str]:
    """Names of the alerts that fire."""
    return [n for n, on in (("lag", lag_seconds > 300), ("failed", failed > 0), ("down", not up)) if on]
