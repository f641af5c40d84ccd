"""A store of the wide table over Parquet: partitions by day, retention by event time, NDJSON in and out."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schema import ALWAYS_TEXT, RECORD
from . import grammar as G
from . import hadoop


@dataclass
class EventStore:
    """``partitions``: the day alone, or ("event_date", "event") for an archive that is read by event."""

    spark: SparkSession
    path: str
    partitions: tuple[str, ...] = ("event_date",)

    def ensure_schema(self, schema: StructType) -> None:
        """Notes the schema of a new store; that of an existing one must be the same."""
        known = self.schema()
        if known is None:
            hadoop.write_text(self.spark, f"{self.path}/_schema.json", schema.json())
        elif _types(known) != _types(schema):
            raise ValueError("the store has another schema: migrate it")

    def schema(self) -> StructType | None:
        text = hadoop.read_text(self.spark, f"{self.path}/_schema.json")
        return StructType.fromJson(json.loads(text)) if text else None

    def migrate(self, schema: StructType) -> list[str]:
        """Adds columns, which are null in older rows; returns their names.  Types can't change, and no column goes."""
        known = self.schema() or StructType([])
        old, new = _types(known), _types(schema)
        changed = sorted(c for c in old if c in new and old[c] != new[c])
        if changed:
            raise ValueError(f"columns of another type: {changed}")
        added = [f for f in schema.fields if f.name not in old]
        hadoop.write_text(self.spark, f"{self.path}/_schema.json", StructType([*known.fields, *added]).json())
        return [f.name for f in added]

    def append(self, rich: DataFrame, compression: str = "zstd") -> int:
        """Rows in the order of (event, ts, ...) inside each day's files, so that row groups can be skipped; returns their number.

        Adaptive execution splits large days over many tasks and files, and joins small ones.
        """
        known = self.schema()
        if known is not None:
            own, has = _types(known), _types(rich.schema)
            wrong = sorted(c for c in has if own.get(c) != has[c])
            if wrong:
                raise ValueError(f"columns that the store lacks or has of another type: {wrong}")
        seen = Observation("appended")
        rows = rich.observe(seen, F.count(F.lit(1)).alias("n")).hint("rebalance", *self.partitions)
        rows = rows.sortWithinPartitions(*dict.fromkeys((*self.partitions, "event", "ts", "process_name", "session_id")))
        rows.write.mode("append").partitionBy(*self.partitions).option("compression", compression).parquet(self.path)
        return seen.get["n"]

    def read(self, begin: str | None = None, end: str | None = None) -> DataFrame:
        """The rows of a time range; the day's predicate is derived, so other partitions aren't listed."""
        known = self.schema()
        df = (self.spark.read.schema(known) if known else self.spark.read).parquet(self.path)
        for bound, op in ((begin, ">="), (end, "<=")):
            if bound:
                df = df.filter(f"ts {op} timestamp_ntz'{bound}' AND event_date {op} date'{bound[:10]}'")
        return df

    def retain(self, days: int, today: str) -> list[str]:
        """Drop whole days older than ``days`` before ``today``; returns those dropped."""
        limit = str(date.fromisoformat(today) - timedelta(days=days))
        gone = [n for n in hadoop.names(self.spark, self.path) if n.startswith("event_date=") and n[11:] < limit]
        return [n[11:] for n in gone if hadoop.delete(self.spark, f"{self.path}/{n}")]

    def healthy(self) -> bool:
        return bool(self.read().limit(1).count())


def _types(schema: StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def write_ndjson(raw: DataFrame, path: str) -> None:
    """Records of raw events, a file's in order of their places; the folder isn't left for no events."""
    order = "start_off" if "start_off" in raw.columns else "position"

    @F.pandas_udf("string")
    def record(timestamp, duration, event, level, filename, file_path, props):
        import pandas as pd

        rows = zip(timestamp, duration, event, level, filename, file_path, props, strict=True)
        return pd.Series([G.to_ndjson(*r[:6], [(p["name"], p["value"], p["quoted"]) for p in r[6]], ALWAYS_TEXT) for r in rows])

    seen = Observation("ndjson")
    rows = raw.repartition("file_path").sortWithinPartitions("file_path", order).observe(seen, F.count(F.lit(1)).alias("n"))
    rows = rows.select(record("timestamp", "duration", "event", "level", "filename", "file_path", "props").alias("value"))
    rows.write.text(path)
    if not seen.get["n"]:
        hadoop.delete(raw.sparkSession, path)


def read_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """Raw events from records; names may repeat, so the records are decoded pair by pair."""
    schema = ", ".join(f"{c} string" for c in RECORD) + ", props array<struct<name:string,value:string,quoted:boolean>>"

    def run(batches):
        import pandas as pd

        for batch in batches:
            rows = []
            for line in batch["value"]:
                fixed, props = G.from_ndjson(line)
                rows.append((*[fixed[c] for c in RECORD], [{"name": n, "value": v, "quoted": q} for n, v, q in props]))
            yield pd.DataFrame(rows, columns=[*RECORD, "props"])

    return spark.read.text(path).filter("value <> ''").mapInPandas(run, schema)


def stats_json(figures: dict) -> str:
    return json.dumps(figures, ensure_ascii=False, sort_keys=True, default=str)
