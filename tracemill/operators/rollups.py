"""Mergeable rollups of the wide table: build, merge, and append in micro-batches.

Sums, counts and maxima merge by themselves; percentiles are KLL sketches; samples are
those of the latest event (time, path, text as tie-breaks), so merging is deterministic.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..schema import DATABASE, LOCKS


@dataclass(frozen=True)
class Rollup:
    """keys and measures are expressions over the wide table; a measure is (how it merges, expression)."""

    name: str
    keys: dict[str, str]
    measures: dict[str, tuple[str, str]]
    where: str = "true"
    samples: tuple[str, ...] = field(default=())


def _in(names: tuple[str, ...]) -> str:
    return "event IN (" + ", ".join(f"'{n}'" for n in names) + ")"


_MINUTE, _FIVE, _HOUR = ("cast(date_trunc('minute', ts) as timestamp_ntz)", "cast(window(ts, '5 minutes').start as timestamp_ntz)", "cast(date_trunc('hour', ts) as timestamp_ntz)")
_COUNTS = {"cnt": ("sum", "1"), "dur_sum": ("sum", "duration_us")}
_SPREAD = {"dur_max": ("max", "duration_us"), "dur_q": ("kll", "duration_us")}
_BUCKET = S.PARAM_BUCKET_SQL

AGG_MINUTE = Rollup("agg_minute", {"minute": _MINUTE, "event": "event", "process_name": "process_name", "computer_name": "computer_name"},
                    _COUNTS | _SPREAD | {"cpu_sum": ("sum", "cpu_time_us"), "mem_peak_max": ("max", "memory_peak"), "io_bytes": ("sum", "in_bytes + out_bytes")})
AGG_CONTEXT = Rollup("agg_context", {"period": _FIVE, "event": "event", "context_hash": "context_hash", "usr": "usr"},
                     _COUNTS | {"cpu_sum": ("sum", "cpu_time_us"), "mem_sum": ("sum", "memory"), "io_sum": ("sum", "in_bytes + out_bytes"), "context_line": ("last", "context_line")}, "context_hash <> 0")
AGG_QUERY = Rollup("agg_query", {"hour": _HOUR, "dbms": "dbms", "db_name": "db_name", "sql_hash": "sql_hash"},
                   _COUNTS | _SPREAD | {"rows_sum": ("sum", "rows_ret"), "sql_sample": ("last", "sql_text"), "context_sample": ("last", "context_line")}, f"{_in((*DATABASE, 'SDBL'))} AND sql_hash <> 0")
AGG_QUERY2 = Rollup("agg_query2", {"hour": _HOUR, "dbms": "dbms", "sql_norm_hash": "sql_norm_hash", "param_bucket": _BUCKET},
                    _COUNTS | _SPREAD | {"rows_sum": ("sum", "rows_ret"), "params_sum": ("sum", "param_count"), "params_cnt": ("sum", "1"), "db_name": ("last", "db_name"), "sql_sample": ("last", "sql_text"), "context_sample": ("last", "context_line")}, "sql_norm_hash <> 0")
AGG_LOCKS = Rollup("agg_locks", {"minute": _MINUTE, "event": "event", "usr": "usr", "lock_regions_short": "substring(lock_regions, 1, 128)"},
                   {"cnt": ("sum", "1"), "wait_us_sum": ("sum", "duration_us"), "wait_us_max": ("max", "duration_us")}, _in(LOCKS))
ROLLUPS = (AGG_MINUTE, AGG_CONTEXT, AGG_QUERY, AGG_QUERY2, AGG_LOCKS)


def _aggregate(how: str, value: Column, order: Column, merging: bool) -> Column:
    if how == "kll":
        return F.kll_merge_agg_bigint(value) if merging else F.kll_sketch_agg_bigint(value)
    if how == "last":
        return F.max_by(value, order)
    return F.sum(value.cast("bigint")) if how == "sum" else F.max(value)


def build(rich: DataFrame, r: Rollup) -> DataFrame:
    """Partial or whole rollup of some rows of the wide table; ``last_at`` orders samples when merged."""
    kept = rich.filter(r.where).select(
        *[F.expr(e).alias(k) for k, e in r.keys.items()], *[F.expr(e).alias(f"_{m}") for m, (_, e) in r.measures.items()],
        F.struct("ts", "src_path", F.expr("sql_text"), F.expr("context")).alias("_at"),
    )
    return _grouped(kept, r, "_at", "_", False)


def merge(parts: DataFrame, r: Rollup) -> DataFrame:
    """One row a key from rows of ``build``."""
    return _grouped(parts, r, "last_at", "", True)


def _grouped(rows: DataFrame, r: Rollup, order: str, prefix: str, merging: bool) -> DataFrame:
    measures = [_aggregate(how, F.col(prefix + m), F.col(order), merging).alias(m) for m, (how, _) in r.measures.items()]
    return rows.groupBy(*r.keys).agg(*measures, F.max(order).alias("last_at"))


def quantile(sketch: Column, q: float) -> Column:
    return F.kll_sketch_get_quantile_bigint(sketch, F.lit(q))
