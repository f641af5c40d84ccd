"""A batch run from trace files into a store, with its figures."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.parse import to_rich
from ..streaming.metrics import observed
from . import techlog
from .store import EventStore


def ingest(spark: SparkSession, path: str, store: EventStore | None = None, fingerprints: bool = True, **options) -> dict:
    """Loads all events into the store (none: they are only parsed) and returns files, bytes, events, skips and inserted rows.

    Files are read once.  A task that fails is tried again by Spark; if the run fails, nothing of it is in the store.
    """
    found = techlog.census(path, int(options.get("min_size", techlog.Options.min_size)))
    raw, seen = observed(techlog.load(spark, path, rejected=True, **options))
    good = raw.filter(~F.col("parse_error")).drop("parse_error")
    if not found.files:
        inserted, own = 0, {"events": 0, "parse_skips": 0, "event_bytes": 0, "newest": None}
    elif store is None:
        good.write.format("noop").mode("overwrite").save()
        inserted, own = 0, seen.get
    else:
        inserted, own = store.append(to_rich(good, fingerprints=fingerprints).drop("sql_norm")), seen.get
    return own | {
        "events": own["events"] - own["parse_skips"], "files": len(found.files), "bytes": sum(n for _, n in found.files),
        "small_file_skips": found.small, "failed_files": found.errors, "inserted_rows": inserted,
    }
