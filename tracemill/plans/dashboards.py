"""Ready-made queries over the wide table and its rollups.

Every function takes DataFrames and a ``Scope`` (time range and filters) and returns a DataFrame.  Sorted
reports carry tie-breaks, so equal inputs give equal reports.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import rollups as R
from ..schema import DATABASE


@dataclass(frozen=True)
class Scope:
    """Time range (closed) and filters; a pattern must match whole, a list of None means all."""

    begin: str | None = None
    end: str | None = None
    process_name: str = ".*"
    usr: str = ".*"
    processes: tuple[str, ...] | None = None
    users: tuple[str, ...] | None = None
    databases: tuple[str, ...] | None = None

    def of(self, df: DataFrame, time: str, *columns: str) -> DataFrame:
        """Filters that reach the scan: the day of partitioned tables follows from the time."""
        for bound, op in ((self.begin, ">="), (self.end, "<=")):
            if bound:
                df = df.filter(f"{time} {op} timestamp_ntz'{bound}'")
                if "event_date" in df.columns:
                    df = df.filter(f"event_date {op} date'{bound[:10]}'")
        for c, pattern in (("process_name", self.process_name), ("usr", self.usr)):
            if c in columns and pattern != ".*":
                df = df.filter(F.col(c).rlike(f"\\A(?:{pattern})\\z"))
        for c, names in (("process_name", self.processes), ("usr", self.users), ("db_name", self.databases)):
            if c in columns and names is not None:
                df = df.filter(F.col(c).isin(*names))
        return df


ALL = Scope()
_sec = lambda c, k=1: F.round(c / 1e6, k)
_total = lambda c: F.sum(c).cast("bigint")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) != "").select(column).distinct().orderBy(column)


def active_users(rollup: DataFrame, most: int = 200) -> DataFrame:
    return rollup.filter("usr <> ''").groupBy("usr").agg(_total("cnt").alias("n")).orderBy(F.desc("n"), "usr").limit(most)


def response_by_minute(minutes: DataFrame, scope: Scope = ALL, event: str = "CALL") -> DataFrame:
    """Percentiles from merged sketches."""
    own = scope.of(minutes.filter(F.col("event") == event), "minute", "process_name")
    merged = own.groupBy("minute").agg(F.kll_merge_agg_bigint("dur_q").alias("q"), _total("cnt").alias("calls_per_min"))
    return merged.select(F.col("minute").alias("time"), *[_sec(R.quantile(F.col("q"), p), 3).alias(n) for n, p in (("p50_s", 0.5), ("p95_s", 0.95), ("p99_s", 0.99))], "calls_per_min").orderBy("time")


def response_by_minute_exact(rich: DataFrame, scope: Scope = ALL, event: str = "CALL") -> DataFrame:
    own = scope.of(rich.filter(F.col("event") == event), "ts", "process_name")
    p = F.percentile("duration_us", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
    out = own.groupBy(S.minute(F.col("ts")).alias("time")).agg(p.alias("p"), F.count("*").alias("calls_per_min"))
    return out.select("time", *[F.col("p")[i].alias(n) for i, n in enumerate(("p50_us", "p95_us", "p99_us"))], "calls_per_min").orderBy("time")


def top_methods(rich: DataFrame, scope: Scope = ALL, most: int = 20) -> DataFrame:
    own = scope.of(rich.filter("event = 'CALL'"), "ts", "process_name", "usr").groupBy("method_name", "iface_name")
    sums = own.agg(F.count("*").alias("calls"), _total("duration_us").alias("total_us"), F.max("duration_us").alias("max_us"), _total("cpu_time_us").alias("cpu_us"), _total(F.col("in_bytes") + F.col("out_bytes")).alias("io_bytes"))
    whole = F.expr("sum(total_us) OVER ()")
    out = sums.withColumn("pct", 100 * F.col("total_us") / whole).orderBy(F.desc("total_us"), "method_name", "iface_name").limit(most)
    return out.withColumn("method_name", S.or_label(F.col("method_name"))).withColumn("avg_us", F.col("total_us") / F.col("calls"))


def top_users(rich: DataFrame, scope: Scope = ALL, most: int = 20) -> DataFrame:
    own = scope.of(rich.filter("event = 'CALL'"), "ts", "process_name", "usr").groupBy("usr")
    out = own.agg(F.count("*").alias("calls"), _total("duration_us").alias("total_us"), _total("cpu_time_us").alias("cpu_us"), F.max("memory_peak").alias("mem_peak_max"))
    return out.orderBy(F.desc("total_us"), "usr").limit(most).withColumn("usr", S.or_label(F.col("usr")))


def duration_histogram(rich: DataFrame, scope: Scope = ALL) -> DataFrame:
    own = scope.of(rich.filter("event = 'CALL'"), "ts", "process_name", "usr")
    return own.groupBy(S.duration_bucket(F.col("duration_us")).alias("bucket")).agg(F.count("*").alias("calls")).orderBy("bucket")


def memory_by_minute(minutes: DataFrame, scope: Scope = ALL) -> DataFrame:
    own = scope.of(minutes.filter("event = 'CALL'"), "minute", "process_name")
    return own.groupBy(F.col("minute").alias("time"), "process_name").agg(F.max("mem_peak_max").alias("mem_peak")).orderBy("time", "process_name")


def worst(rich: DataFrame, event: str, by: str, columns: tuple[str, ...], most: int, scope: Scope = ALL, ties: tuple[str, ...] = ("src_path", "session_id", "connect_id")) -> DataFrame:
    """The rows of an event with the largest ``by``: a top-k, no full sort."""
    own = scope.of(rich.filter(F.col("event") == event), "ts", "process_name", "usr", "db_name")
    rest = [c for c in ("ts", *ties) if c != by]
    return own.orderBy(F.desc(by), *rest).limit(most).select(*columns)


def busy_by_minute(minutes: DataFrame, scope: Scope = ALL, event: str = "DBMSSQL") -> DataFrame:
    own = scope.of(minutes.filter(F.col("event") == event), "minute", "process_name")
    out = own.groupBy(F.col("minute").alias("time")).agg(_total("dur_sum").alias("busy_us"), F.kll_merge_agg_bigint("dur_q").alias("q"), _total("cnt").alias("queries_per_min"))
    return out.select("time", (F.col("busy_us") / 60e6).alias("busy_workers"), _sec(R.quantile(F.col("q"), 0.95), 2).alias("p95_s"), "queries_per_min").orderBy("time")


def _top_of_whole(own: DataFrame, keys: tuple[str, ...], sums: list[Column], total: str, most: int, kept: str = "true") -> DataFrame:
    """The ``most`` groups with the largest ``total`` among those ``kept``, with ``whole``, the total of all rows.

    The whole is a grouping set of the same aggregation, so rows are read once, and it comes first in the top-k, so no task sees
    more than that; sums must not be negative.
    """
    groups = own.groupingSets([list(keys), []], *keys).agg(F.grouping_id().alias("_whole"), *sums)
    top = groups.filter(f"_whole > 0 OR ({kept})").orderBy(F.desc("_whole"), F.desc(total), *keys).limit(most + 1)
    return top.withColumn("whole", F.expr(f"max(if(_whole > 0, {total}, NULL)) OVER ()")).filter("_whole = 0").drop("_whole")


def database_profile(rich: DataFrame, scope: Scope = ALL, most: int = 20) -> DataFrame:
    own = scope.of(rich.filter("event = 'DBMSSQL'"), "ts", "process_name", "usr", "db_name")
    top = _top_of_whole(own, ("db_name",), [F.count("*").alias("calls"), _total("duration_us").alias("total_us")], "total_us", most)
    return top.select("db_name", "calls", "total_us", (100 * F.col("total_us") / F.col("whole")).alias("pct")).orderBy(F.desc("total_us"), "db_name")


def code_lines(rich: DataFrame, scope: Scope = ALL, most: int = 20) -> DataFrame:
    own = scope.of(rich.filter("event = 'DBMSSQL'"), "ts", "process_name", "usr", "db_name")
    # a line of blanks is a line, an empty one is none
    own = own.select(F.when(F.col("context_line") != "", S.trim_blanks(F.col("context_line"))).alias("context_line"), "duration_us", "sql_hash")
    sums = [F.count("*").alias("calls"), _total("duration_us").alias("total_us"), F.count_distinct("sql_hash").alias("uniq_sql")]
    top = _top_of_whole(own, ("context_line",), sums, "total_us", most, "context_line IS NOT NULL")
    return top.select("context_line", "calls", "total_us", (100 * F.col("total_us") / F.col("whole")).alias("pct"), "uniq_sql").orderBy(F.desc("total_us"), "context_line")


def top_queries(queries: DataFrame, scope: Scope = ALL, most: int = 20) -> DataFrame:
    """Normalised queries by total time, with a sample of the latest event."""
    own = scope.of(queries, "hour", "db_name")
    sums = [
        _total("cnt").alias("calls"), _total("dur_sum").alias("total_us"), F.max("dur_max").alias("max_us"), _total("rows_sum").alias("rows_sum"), F.count_distinct("param_bucket").alias("buckets"),
        F.max_by(F.struct("sql_sample", "context_sample"), "last_at").alias("_sample"),
    ]
    out = _top_of_whole(own, ("sql_norm_hash",), sums, "total_us", most)
    out = out.select(
        "calls", "total_us", "max_us", "rows_sum", "buckets", F.substring("_sample.sql_sample", 1, 160).alias("sql"), S.trim_blanks(F.col("_sample.context_sample")).alias("context_line"),
        (100 * F.col("total_us") / F.col("whole")).alias("pct"), S.hash_hex(F.col("sql_norm_hash")).alias("norm_hash_hex"),
    )
    return out.orderBy(F.desc("total_us"), "norm_hash_hex")


def parameter_degradation(queries: DataFrame, scope: Scope = ALL, most: int = 8) -> DataFrame:
    """Queries seen with several parameter classes: by class, the heaviest query first."""
    own = scope.of(queries, "hour", "db_name")
    sums = own.groupBy("sql_norm_hash", "param_bucket").agg(
        F.substring(F.max_by("sql_sample", "last_at"), 1, 100).alias("sql"), _total("cnt").alias("calls"), _total("dur_sum").alias("total_us"))
    # a query has at most as many rows as there are classes
    by_query = sums.groupBy("sql_norm_hash").agg(
        _total("total_us").alias("s"), F.max("total_us").alias("heaviest"), F.collect_list(F.struct("sql", F.col("param_bucket").alias("params"), "calls", "total_us")).alias("classes"))
    top = by_query.filter(F.size("classes") > 1).orderBy(F.desc("s"), "sql_norm_hash").limit(most)
    rows = top.select("sql_norm_hash", "heaviest", F.inline("classes"))
    return rows.orderBy(F.desc("heaviest"), "sql_norm_hash", S.param_bucket_order(F.col("params"))).select("sql", "params", "calls", "total_us")


def per_minute(rich: DataFrame, events: tuple[str, ...], scope: Scope = ALL) -> DataFrame:
    own = scope.of(rich.filter(F.col("event").isin(*events)), "ts", "process_name", "usr")
    return own.groupBy(S.minute(F.col("ts")).alias("time"), "event").agg(F.count("*").alias("cnt")).orderBy("time", "event")


def error_lines(rich: DataFrame, scope: Scope = ALL, most: int = 10) -> DataFrame:
    own = scope.of(rich.filter("event = 'QERR' AND context_line <> ''"), "ts", "process_name", "usr")
    out = own.groupBy(S.trim_blanks(F.col("context_line")).alias("context_line")).agg(F.count("*").alias("errors"), F.count_distinct("usr").alias("uniq_users"))
    return out.orderBy(F.desc("errors"), "context_line").limit(most)


def top_errors(rich: DataFrame, scope: Scope = ALL, most: int = 20) -> DataFrame:
    """Errors with a sample query of their first moment: top-k, then a left join of that few."""
    own = scope.of(rich.filter("event = 'QERR'"), "ts", "usr").select(F.substring("descr", 1, 200).alias("error"), F.col("context_line").alias("context"), "ts", "sql_text")
    top = own.groupBy("error", "context").agg(F.count("*").alias("cnt"), F.min("ts").alias("sample_ts")).orderBy(F.desc("cnt"), "error", "context").limit(most)
    sample = own.join(F.broadcast(top.select("sample_ts").distinct()), F.col("ts") == F.col("sample_ts"), "left_semi")
    sample = sample.groupBy("error", "context").agg(F.min("sql_text").alias("q"))
    out = top.join(sample, ["error", "context"], "left")
    return out.select(S.or_label(F.col("error"), "(нет текста ошибки)").alias("error"), "cnt", F.coalesce(F.substring("q", 1, 150), F.lit("")).alias("query_sample"), F.col("context").alias("context_line")).orderBy(F.desc("cnt"), "error", "context_line")


def top_exceptions(rich: DataFrame, scope: Scope = ALL, most: int = 20) -> DataFrame:
    own = scope.of(rich.filter("event = 'EXCP'"), "ts", "usr").groupBy("exception").agg(F.count("*").alias("cnt"), F.substring(F.min("descr"), 1, 200).alias("descr_sample"))
    return own.orderBy(F.desc("cnt"), "exception").limit(most).withColumn("exception", S.or_label(F.col("exception"), "(не указано)"))


def lock_waits(locks: DataFrame, keys: tuple[str, ...], scope: Scope = ALL, nonempty: str | None = None, most: int | None = None) -> DataFrame:
    """Waits by any keys of the lock rollup."""
    own = scope.of(locks, "minute", "usr")
    own = own.filter(F.col(nonempty) != "") if nonempty else own
    out = own.groupBy(*keys).agg(_total("cnt").alias("waits"), _total("wait_us_sum").alias("total_wait_us"), F.max("wait_us_max").alias("max_wait_us"))
    return out.orderBy(F.desc("total_wait_us"), *keys).limit(most) if most else out.orderBy(*keys)


def lock_lines(rich: DataFrame, scope: Scope = ALL, most: int = 15) -> DataFrame:
    own = scope.of(rich.filter("event = 'TLOCK' AND context_line <> ''"), "ts", "usr").groupBy("context_line")
    out = own.agg(F.count("*").alias("waits"), _total("duration_us").alias("total_wait_us"))
    return out.withColumn("avg_wait_us", F.col("total_wait_us") / F.col("waits")).orderBy(F.desc("total_wait_us"), "context_line").limit(most)


def timeouts(rich: DataFrame, scope: Scope = ALL, most: int = 300) -> DataFrame:
    own = scope.of(rich.filter("event = 'TTIMEOUT'"), "ts", "usr").orderBy(F.desc("ts"), "src_path", "session_id", "connect_id").limit(most)
    ids = F.array_join(F.transform("lock_wait_conns", lambda x: x.cast("string")), ",")
    return own.select("ts", "usr", "session_id", "connect_id", "duration_us", "context_line", F.substring("lock_regions", 1, 120).alias("lock_regions"), ids.alias("culprit_connect_ids"))


def culprit_activity(rich: DataFrame, connect_id: int, at: str, before: str = "5 minutes", after: str = "1 minute") -> DataFrame:
    moment = f"timestamp_ntz'{at}'"
    own = rich.filter((F.col("connect_id") == connect_id) & F.expr(f"ts BETWEEN {moment} - INTERVAL {before} AND {moment} + INTERVAL {after}"))
    return own.orderBy("ts", "event", "session_id").select("ts", "event", "usr", "session_id", "duration_us", "context_line")


def blocked_by(rich: DataFrame, bucket_seconds: int = 60) -> DataFrame:
    """Who blocked whom: each victim's culprits' events within the wait.

    An equi-join on (connection, time bucket): a victim is put into each bucket that its wait touches, so a
    busy connection is spread over time and no interval join is left to a nested loop.
    """
    second = lambda c: F.unix_timestamp(c.cast("timestamp"))
    victims = rich.filter(F.col("event").isin("TLOCK", "TTIMEOUT") & (F.size("lock_wait_conns") > 0)).select(
        F.col("ts").alias("v_ts"), F.col("connect_id").alias("victim"), "duration_us", F.explode("lock_wait_conns").alias("culprit"))
    victims = victims.withColumn("v_from", F.col("v_ts") - F.expr("make_dt_interval(0, 0, 0, duration_us / 1000000.0)"))
    victims = victims.withColumn("b", F.explode(F.sequence(F.floor(second(F.col("v_from")) / bucket_seconds), F.floor(second(F.col("v_ts")) / bucket_seconds))))
    acts = rich.select("ts", F.col("event").alias("c_event"), F.col("connect_id").alias("c_id"), F.col("context_line").alias("c_line")).withColumn("c_b", F.floor(second(F.col("ts")) / bucket_seconds))
    both = victims.join(acts, (F.col("culprit") == F.col("c_id")) & (F.col("b") == F.col("c_b")) & (F.col("ts") >= F.col("v_from")) & (F.col("ts") <= F.col("v_ts")))
    return both.select("v_ts", "victim", "culprit", "ts", "c_event", "c_line")


def total_of(rollup: DataFrame, events: tuple[str, ...], column: str, name: str, scope: Scope = ALL) -> DataFrame:
    """A stat tile."""
    own = rollup.filter(F.col("event").isin(*events)) if events else rollup
    return scope.of(own, "minute", "process_name").agg(F.coalesce(_total(column), F.lit(0)).alias(name))


def cluster_load(minutes: DataFrame, scope: Scope = ALL) -> DataFrame:
    own = scope.of(minutes.filter(F.col("event").isin("CALL", *DATABASE)), "minute", "process_name")
    part = lambda test: F.sum(F.when(test, F.col("dur_sum")).otherwise(0)).cast("bigint")
    return own.groupBy(F.col("minute").alias("time")).agg(part(F.col("event") == "CALL").alias("busy_us"), part(F.col("event") != "CALL").alias("db_us")).orderBy("time")


def top_with_share(rich: DataFrame, key: str, label: Column, scope: Scope = ALL, most: int = 10) -> DataFrame:
    """Top contexts or users by server time, with their share of all."""
    own = scope.of(rich.filter("event = 'CALL'"), "ts", "process_name").groupBy(key).agg(label.alias("label"), _total("duration_us").alias("total_us"), F.count("*").alias("calls"))
    out = own.withColumn("pct", F.expr("100 * total_us / greatest(sum(total_us) OVER (), 1)"))
    return out.orderBy(F.desc("total_us"), "label").limit(most).select("label", "calls", "total_us", "pct")


def compared(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Two periods of a rollup side by side; what one lacks counts 0."""
    side = lambda df, n: df.groupBy(key).agg(_total("dur_sum").alias(n))
    both = side(before, "a").join(side(after, "b"), key, "full")
    a, b = F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))
    return both.select(key, a.alias("before_us"), b.alias("after_us"), (100 * (b - a) / F.greatest(a, F.lit(1))).alias("diff_pct"))
