"""The driver's queries for the trace engine, each with DuckDB SQL that computes the same from the facts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import parse as P
from ..operators import rollups as R
from . import carrier as C
from . import dashboards as D

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_WITH = f"WITH f AS ({C.FACTS})\n"


def _add(name: str, sql: str | None, run: Callable[[SparkSession, str], DataFrame]) -> None:
    QUERIES[name] = run
    if sql is not None:
        SQL[name] = _WITH + sql if " f" in sql else sql


def _rich(name: str, sql: str | None, run: Callable[[DataFrame], DataFrame], fingerprints: bool = False) -> None:
    _add(name, sql, lambda spark, d: run(C.rich(spark, d, fingerprints)))


def _rollup(name: str, sql: str | None, rollup: R.Rollup, run: Callable[[DataFrame], DataFrame]) -> None:
    _add(name, sql, lambda spark, d: run(R.build(C.rich(spark, d, "sql_norm_hash" in rollup.keys), rollup)))


def _events(name: str, sql: str, run: Callable[[DataFrame], DataFrame], table: str = "events") -> None:
    _add(name, sql, lambda spark, d: run(spark.read.parquet(f"{d}/{table}.parquet")))


I = "CAST(sum({}) AS BIGINT)".format  # noqa: E741
MIN, HOUR = "date_trunc('minute', ts)", "date_trunc('hour', ts)"
CALLS = "FROM f WHERE event = 'CALL'"
DB = "FROM f WHERE event = 'DBMSSQL'"

# ---- calls
_rich("Q-C1", "SELECT DISTINCT process_name FROM f", lambda r: D.distinct_values(r, "process_name"))
_rollup("Q-C2", "SELECT usr, count(*) AS n FROM f WHERE usr <> '' AND context <> '' GROUP BY usr ORDER BY n DESC, usr LIMIT 200", R.AGG_CONTEXT, D.active_users)
_rich("Q-C3", f"SELECT {MIN} AS time, quantile_cont(duration_us, 0.5) AS p50_us, quantile_cont(duration_us, 0.95) AS p95_us, quantile_cont(duration_us, 0.99) AS p99_us, count(*) AS calls_per_min {CALLS} GROUP BY 1", D.response_by_minute_exact)
_rich("Q-C4", f"""SELECT CASE WHEN method_name = '' THEN '(нет)' ELSE method_name END AS method_name, iface_name, count(*) AS calls, {I('duration_us')} AS total_us, max(duration_us) AS max_us, {I('cpu_time_us')} AS cpu_us,
  {I('in_bytes + out_bytes')} AS io_bytes, 100 * {I('duration_us')} / CAST(sum(sum(duration_us)) OVER () AS BIGINT) AS pct, {I('duration_us')} / count(*) AS avg_us {CALLS} GROUP BY f.method_name, iface_name ORDER BY total_us DESC, f.method_name, iface_name LIMIT 20""", D.top_methods)
_rich("Q-C5", f"SELECT CASE WHEN usr = '' THEN '(нет)' ELSE usr END AS usr, count(*) AS calls, {I('duration_us')} AS total_us, {I('cpu_time_us')} AS cpu_us, max(memory_peak) AS mem_peak_max {CALLS} GROUP BY f.usr ORDER BY total_us DESC, f.usr LIMIT 20", D.top_users)
_rich("Q-C6", f"""SELECT CASE WHEN duration_us < 100000 THEN '1. <0.1с' WHEN duration_us < 500000 THEN '2. 0.1–0.5с' WHEN duration_us < 1000000 THEN '3. 0.5–1с' WHEN duration_us < 3000000 THEN '4. 1–3с'
  WHEN duration_us < 10000000 THEN '5. 3–10с' WHEN duration_us < 60000000 THEN '6. 10–60с' ELSE '7. >60с' END AS bucket, count(*) AS calls {CALLS} GROUP BY 1""", D.duration_histogram)
_rollup("Q-C7", f"SELECT {MIN} AS time, process_name, max(memory_peak) AS mem_peak {CALLS} GROUP BY 1, 2", R.AGG_MINUTE, D.memory_by_minute)
_PATH = "concat('logs', chr(92), 'worker_', pid, chr(92), strftime(ts, '%y%m%d%H'), '.log')"
_rich("Q-C8", f"SELECT ts, usr, method_name, memory_peak, memory, duration_us {CALLS} ORDER BY memory_peak DESC, ts, {_PATH}, session_id, connect_id LIMIT 20", lambda r: D.worst(r, "CALL", "memory_peak", ("ts", "usr", "method_name", "memory_peak", "memory", "duration_us"), 20))
_rich("Q-C9", f"SELECT ts, usr, session_id, process_name, method_name, duration_us, cpu_time_us {CALLS} ORDER BY duration_us DESC, ts, {_PATH}, session_id, connect_id LIMIT 50", lambda r: D.worst(r, "CALL", "duration_us", ("ts", "usr", "session_id", "process_name", "method_name", "duration_us", "cpu_time_us"), 50))

# ---- database
_rich("Q-D0", f"SELECT DISTINCT db_name {DB}", lambda r: D.distinct_values(r, "db_name"))
_rich("Q-D2", f"SELECT db_name, count(*) AS calls, {I('duration_us')} AS total_us, 100 * {I('duration_us')} / (SELECT {I('duration_us')} {DB}) AS pct {DB} GROUP BY db_name ORDER BY total_us DESC, db_name LIMIT 20", D.database_profile)
_rich("Q-D3", f"""SELECT trim(context_line, ' ' || chr(9)) AS context_line, count(*) AS calls, {I('duration_us')} AS total_us, 100 * {I('duration_us')} / (SELECT {I('duration_us')} {DB}) AS pct, count(DISTINCT sql_text) AS uniq_sql
  {DB} AND context_line <> '' GROUP BY 1 ORDER BY total_us DESC, 1 LIMIT 20""", D.code_lines)
#: the latest event's value: ties in time go by path, text and context
LATEST = ("arg_max({}, {{'a': ts, 'b': " + _PATH + ", 'c': sql_text, 'd': context}})").format
_BUCKET = "CASE WHEN param_count = 3 OR param_count = 5 THEN '2-10' ELSE '11-100' END"
_rollup("Q-D4", f"""SELECT count(*) AS calls, {I('duration_us')} AS total_us, max(duration_us) AS max_us, {I('rows_ret')} AS rows_sum, count(DISTINCT {_BUCKET}) AS buckets, 100 * {I('duration_us')} / (SELECT {I('duration_us')} FROM f WHERE sql_norm <> '') AS pct,
  substr({LATEST('sql_text')}, 1, 160) AS sql, trim({LATEST('f.context_line')}, ' ' || chr(9)) AS context_line
  FROM f WHERE sql_norm <> '' GROUP BY sql_norm ORDER BY total_us DESC LIMIT 20""", R.AGG_QUERY2, lambda q: D.top_queries(q).drop("norm_hash_hex"))
_rollup("Q-D5", f"SELECT {_BUCKET} AS params, count(*) AS calls, {I('duration_us')} AS total_us FROM f WHERE sql_norm <> '' GROUP BY sql_norm, 1", R.AGG_QUERY2, lambda q: D.parameter_degradation(q).drop("sql"))
_rich("Q-D6", f"SELECT ts, usr, db_name, duration_us, rows_ret, sql_text, context_line {DB} ORDER BY duration_us DESC, ts, {_PATH}, session_id, connect_id LIMIT 50", lambda r: D.worst(r, "DBMSSQL", "duration_us", ("ts", "usr", "db_name", "duration_us", "rows_ret", "sql_text", "context_line"), 50))
_rich("Q-D7", f"SELECT {MIN} AS time, event, count(*) AS cnt FROM f WHERE event = 'QERR' GROUP BY 1, 2", lambda r: D.per_minute(r, ("QERR",)))
_rich("Q-D8", "SELECT trim(context_line, ' ' || chr(9)) AS context_line, count(*) AS errors, count(DISTINCT usr) AS uniq_users FROM f WHERE event = 'QERR' AND context_line <> '' GROUP BY 1 ORDER BY errors DESC, 1 LIMIT 10", D.error_lines)

# ---- errors
_rich("Q-E1", f"SELECT {MIN} AS time, event, count(*) AS cnt FROM f WHERE event IN ('QERR', 'EXCP') GROUP BY 1, 2", lambda r: D.per_minute(r, ("QERR", "EXCP")))
_rich("Q-E2", """, top AS (SELECT substr(descr, 1, 200) AS error, context_line AS context, count(*) AS cnt, min(ts) AS sample_ts FROM f WHERE event = 'QERR' GROUP BY 1, 2 ORDER BY cnt DESC, error, context LIMIT 20),
  e AS (SELECT substr(descr, 1, 200) AS error, context_line AS context, min(sql_text) AS q FROM f WHERE event = 'QERR' AND ts IN (SELECT sample_ts FROM top) GROUP BY 1, 2)
SELECT top.error, cnt, coalesce(substr(q, 1, 150), '') AS query_sample, top.context AS context_line FROM top LEFT JOIN e ON e.error = top.error AND e.context = top.context""", D.top_errors)
_rich("Q-E3", "SELECT CASE WHEN exception = '' THEN '(не указано)' ELSE exception END AS exception, count(*) AS cnt, substr(min(descr), 1, 200) AS descr_sample FROM f WHERE event = 'EXCP' GROUP BY f.exception ORDER BY cnt DESC, f.exception LIMIT 20", D.top_exceptions)
for _q, _e, _c in (("Q-E4", "QERR", ("ts", "usr", "descr", "context_line")), ("Q-E5", "EXCP", ("ts", "process_name", "exception", "descr"))):
    _rich(_q, f"SELECT {', '.join(_c)} FROM f WHERE event = '{_e}' ORDER BY ts DESC, {_PATH}, session_id, connect_id LIMIT 50", lambda r, e=_e, c=_c: D.worst(r, e, "ts", c, 50))

# ---- locks
LOCKED = "FROM f WHERE event IN ('TLOCK', 'TTIMEOUT', 'TDEADLOCK')"
_W = f"count(*) AS waits, {I('duration_us')} AS total_wait_us, max(duration_us) AS max_wait_us"
_rollup("Q-L1", f"SELECT {MIN} AS minute, event, {_W} {LOCKED} GROUP BY 1, 2", R.AGG_LOCKS, lambda x: D.lock_waits(x, ("minute", "event")))
_rollup("Q-L2", f"SELECT {MIN} AS minute, {_W} {LOCKED} GROUP BY 1", R.AGG_LOCKS, lambda x: D.lock_waits(x, ("minute",)))
_rollup("Q-L3", f"SELECT usr, {_W} {LOCKED} AND usr <> '' GROUP BY 1 ORDER BY total_wait_us DESC, usr LIMIT 15", R.AGG_LOCKS, lambda x: D.lock_waits(x, ("usr",), nonempty="usr", most=15))
_rollup("Q-L4", f"SELECT substr(lock_regions, 1, 128) AS lock_regions_short, {_W} {LOCKED} AND lock_regions <> '' GROUP BY 1 ORDER BY total_wait_us DESC, 1 LIMIT 15", R.AGG_LOCKS, lambda x: D.lock_waits(x, ("lock_regions_short",), nonempty="lock_regions_short", most=15))
_rich("Q-L5", f"SELECT context_line, count(*) AS waits, {I('duration_us')} AS total_wait_us, {I('duration_us')} / count(*) AS avg_wait_us FROM f WHERE event = 'TLOCK' AND context_line <> '' GROUP BY 1 ORDER BY total_wait_us DESC, 1 LIMIT 15", D.lock_lines)
_rich("Q-L6", f"SELECT ts, usr, session_id, connect_id, duration_us, context_line, substr(lock_regions, 1, 120) AS lock_regions, wait_connections AS culprit_connect_ids FROM f WHERE event = 'TTIMEOUT' ORDER BY ts DESC, {_PATH}, session_id, connect_id LIMIT 300", D.timeouts)
_rich("Q-L7", f"SELECT ts, usr, session_id, context_line, deadlock_graph FROM f WHERE event = 'TDEADLOCK' ORDER BY ts DESC, {_PATH}, session_id, connect_id LIMIT 100", lambda r: D.worst(r, "TDEADLOCK", "ts", ("ts", "usr", "session_id", "context_line", "deadlock_graph"), 100))
_rich("Q-L8", "SELECT ts, event, usr, session_id, duration_us, context_line FROM f WHERE connect_id = 7 AND ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' - INTERVAL 1 DAY AND TIMESTAMP '2024-01-05 00:00:00' + INTERVAL 1 DAY", lambda r: D.culprit_activity(r, 7, "2024-01-05 00:00:00", "1 day", "1 day"))
_rich("JOIN-4", """, v AS (SELECT ts AS v_ts, connect_id AS victim, ts - to_microseconds(duration_us) AS v_from, CAST(unnest(string_split(wait_connections, ',')) AS BIGINT) AS culprit FROM f WHERE event IN ('TLOCK', 'TTIMEOUT'))
SELECT v_ts, victim, culprit, f.ts, f.event AS c_event, f.context_line AS c_line FROM v JOIN f ON f.connect_id = culprit AND f.ts BETWEEN v_from AND v_ts""", D.blocked_by)

# ---- overview
for _q, _e, _x in (("Q-O1", ("CALL",), "call_us"), ("Q-O2", ("DBMSSQL", "DBPOSTGRS", "DBORACLE", "DB2"), "db_us")):
    _rollup(_q, f"SELECT coalesce({I('duration_us')}, 0) AS {_x} FROM f WHERE event IN {_e if len(_e) > 1 else str(_e).replace(',', '')}", R.AGG_MINUTE, lambda m, e=_e, x=_x: D.total_of(m, e, "dur_sum", x))
_rollup("Q-O3", f"SELECT {I('duration_us')} AS wait_us {LOCKED}", R.AGG_LOCKS, lambda x: D.total_of(x, (), "wait_us_sum", "wait_us"))
for _q, _e, _r in (("Q-O4", "TTIMEOUT", R.AGG_LOCKS), ("Q-O5", "TDEADLOCK", R.AGG_LOCKS), ("Q-O6", "QERR", R.AGG_MINUTE)):
    _rollup(_q, f"SELECT count(*) AS n FROM f WHERE event = '{_e}'", _r, lambda x, e=_e: D.total_of(x, (e,), "cnt", "n"))
_rollup("Q-O7", f"SELECT {MIN} AS time, coalesce(CAST(sum(duration_us) FILTER (event = 'CALL') AS BIGINT), 0) AS busy_us, coalesce(CAST(sum(duration_us) FILTER (event <> 'CALL') AS BIGINT), 0) AS db_us FROM f WHERE event IN ('CALL', 'DBMSSQL') GROUP BY 1", R.AGG_MINUTE, D.cluster_load)
_rich("Q-O8", SQL["Q-C3"].removeprefix(_WITH), D.response_by_minute_exact)
_rich("Q-O9", f"SELECT context_line AS label, count(*) AS calls, {I('duration_us')} AS total_us, 100 * {I('duration_us')} / CAST(sum(sum(duration_us)) OVER () AS BIGINT) AS pct {CALLS} AND context <> '' GROUP BY context, context_line ORDER BY total_us DESC, label LIMIT 10", lambda r: D.top_with_share(r.filter("context_hash <> 0"), "context_hash", F.max_by("context_line", F.struct("ts", "src_path"))))
_rich("Q-O10", f"SELECT usr AS label, count(*) AS calls, {I('duration_us')} AS total_us, 100 * {I('duration_us')} / CAST(sum(sum(duration_us)) OVER () AS BIGINT) AS pct {CALLS} AND usr <> '' GROUP BY usr ORDER BY total_us DESC, label LIMIT 10", lambda r: D.top_with_share(r.filter("usr <> ''"), "usr", F.max("usr")))

# ---- recipes
_rich("Q-R1", f"SELECT ts, event, duration_us FROM f WHERE context = (SELECT max(context) FROM f) ORDER BY duration_us DESC, ts, {_PATH}, session_id LIMIT 50",
      lambda r: r.join(F.broadcast(r.agg(S.text_hash(F.max("context")).alias("h"))), F.col("context_hash") == F.col("h"), "left_semi").orderBy(F.desc("duration_us"), "ts", "src_path", "session_id").limit(50).select("ts", "event", "duration_us"))
_rich("Q-R2", "SELECT ts, event, duration_us, context_line FROM f WHERE session_id = 5 AND ts BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-20'", lambda r: D.Scope("2024-01-02 00:00:00", "2024-01-20 00:00:00").of(r, "ts").filter("session_id = 5").orderBy("ts").select("ts", "event", "duration_us", "context_line"))
_add("Q-R3", f""", a AS (SELECT usr, {I('duration_us')} AS x FROM f WHERE ts < TIMESTAMP '2024-01-04' AND context <> '' GROUP BY usr), b AS (SELECT usr, {I('duration_us')} AS x FROM f WHERE ts >= TIMESTAMP '2024-01-04' AND ts < TIMESTAMP '2024-01-07' AND context <> '' GROUP BY usr)
SELECT usr, coalesce(a.x, 0) AS before_us, coalesce(b.x, 0) AS after_us, 100 * (coalesce(b.x, 0) - coalesce(a.x, 0)) / greatest(coalesce(a.x, 0), 1) AS diff_pct FROM a FULL JOIN b USING (usr)""",
     lambda s, d: (lambda c: D.compared(c.filter("period < timestamp_ntz'2024-01-04 00:00:00'"), c.filter("period >= timestamp_ntz'2024-01-04 00:00:00' AND period < timestamp_ntz'2024-01-07 00:00:00'"), "usr"))(R.build(C.rich(s, d), R.AGG_CONTEXT)))
_rich("Q-R4", "SELECT tail AS interface, count(*) AS n FROM f GROUP BY 1", lambda r: r.groupBy(S.map_get(F.col("props"), "Tail").alias("interface")).agg(F.count("*").alias("n")))
_rich("Q-R5", "SELECT event, count(*) AS n FROM f GROUP BY 1", lambda r: r.groupBy("event").agg(F.count("*").alias("n")))
_rich("Q-N1", "SELECT sql_norm, count(*) AS n, min(sql_text) AS sample FROM f WHERE sql_norm <> '' GROUP BY 1", lambda r: r.filter("sql_norm_hash <> 0").groupBy("sql_norm").agg(F.count("*").alias("n"), F.min("sql_text").alias("sample")), True)
_rich("Q-N2", "SELECT event_type AS value, count(*) AS n FROM f WHERE sql_norm <> '' GROUP BY 1", lambda r: r.filter("sql_norm_hash <> 0").groupBy(S.nth(F.col("sql_params"), 2).alias("value")).agg(F.count("*").alias("n")), True)
_rich("Q-N3", "SELECT ts, sql_text FROM f WHERE sql_norm <> '' AND event_type = 'click'", lambda r: r.filter(F.array_contains("sql_params", "click")).select("ts", "sql_text"), True)
_rich("Q-S1", f"SELECT {MIN} AS time, event, count(*) AS cnt FROM f GROUP BY 1, 2", lambda r: r.groupBy(S.minute(F.col("ts")).alias("time"), "event").agg(F.count("*").alias("cnt")))
_rich("Q-S2", f"SELECT context_line, {I('cpu_time_us')} AS metric FROM f WHERE context <> '' GROUP BY 1 ORDER BY metric DESC, 1 LIMIT 20", lambda r: r.filter("context_hash <> 0").groupBy("context_line").agg(F.sum("cpu_time_us").alias("metric")).orderBy(F.desc("metric"), "context_line").limit(20))
_rich("Q-S3", "SELECT ts, duration_us, sql_text FROM f WHERE event = 'DBMSSQL' AND duration_us > 3000000", lambda r: r.filter("event = 'DBMSSQL' AND duration_us > 3000000").select("ts", "duration_us", "sql_text"))
_rich("Q-T1", "SELECT count(*) AS n, count(DISTINCT event_id) AS ids FROM f", lambda r: r.agg(F.count("*").alias("n"), F.count_distinct(S.map_get(F.col("props"), "EventId")).alias("ids")))
_rich("Q-T2", "SELECT quantile_cont(duration_us, 0.95) AS p95 FROM f", lambda r: r.agg(F.percentile("duration_us", F.lit(0.95)).alias("p95")))

# ---- sources, parser, projection
_rich("SRC-7", "SELECT event_id, ts, duration_us, event, usr, session_id FROM f", lambda r: r.select(S.map_get(F.col("props"), "EventId").cast("bigint").alias("event_id"), "ts", "duration_us", "event", "usr", "session_id"))
_rich("PRJ-1", "SELECT event_id, context, sql_text, descr, exception, lock_regions, deadlock_graph, memory, memory_peak, rows_ret, cpu_time_us, in_bytes, out_bytes, iface_name, db_name, dbms, computer_name, connect_id FROM f",
      lambda r: r.select(S.map_get(F.col("props"), "EventId").cast("bigint").alias("event_id"), "context", "sql_text", "descr", "exception", "lock_regions", "deadlock_graph", "memory", "memory_peak", "rows_ret", "cpu_time_us", "in_bytes", "out_bytes", "iface_name", "db_name", "dbms", "computer_name", "connect_id"))
_rich("PRJ-2", "SELECT k, count(*) AS n FROM f, (VALUES ('Tail'), ('EventId')) AS t(k) GROUP BY k", lambda r: r.select(F.explode(F.map_keys("props")).alias("k")).groupBy("k").agg(F.count("*").alias("n")))
_add("PRJ-3", "SELECT 'second' AS tail, count(*) AS n FROM f", lambda s, d: P.to_bench(C.raw(s, d)).groupBy(F.col("props")["Tail"].alias("tail")).agg(F.count("*").alias("n")))
_add("PRS-1", "SELECT event, '1' AS level, count(*) AS n, CAST(sum(duration_us) AS BIGINT) AS total FROM f GROUP BY 1", lambda s, d: C.raw(s, d).groupBy("event", "level").agg(F.count("*").alias("n"), F.sum(F.col("duration").cast("bigint")).alias("total")))
_add("PRS-3", "SELECT doc_id, coalesce(text, '') AS text FROM documents", lambda s, d: _quoted(s, d, "'"))
_add("PRS-4", SQL["PRS-3"], lambda s, d: _quoted(s, d, '"'))


def _quoted(spark: SparkSession, d: str, q: str) -> DataFrame:
    """Whole document texts as quoted values, read back."""
    docs = spark.read.parquet(f"{d}/documents.parquet")
    text = F.concat(F.lit(f"A=1,Descr={q}"), F.replace(F.coalesce("text", F.lit("")), F.lit(q), F.lit(q * 2)), F.lit(f"{q},Z=2"))
    value = F.get(F.filter(P.properties(text), lambda p: p["name"] == "Descr"), F.lit(0))["value"]
    return docs.select("doc_id", value.alias("text"))


_TOKENS = "unnest([CAST(l_quantity AS VARCHAR), concat('0', l_orderkey), concat('8.3.', l_partkey, '.1'), concat('-', l_partkey), concat(l_partkey, 'e5'), concat(l_partkey, ' ')])"
_events("PRS-6", f"SELECT regexp_full_match(t, '-?(0|[1-9][0-9]*)(\\.[0-9]+)?([eE][+-]?[0-9]+)?') AS is_number, count(*) AS n FROM (SELECT {_TOKENS} AS t FROM lineitem) GROUP BY 1",
        lambda x: x.select(F.explode(F.array(F.col("l_quantity").cast("string"), F.expr("concat('0', l_orderkey)"), F.expr("concat('8.3.', l_partkey, '.1')"), F.expr("concat('-', l_partkey)"), F.expr("concat(l_partkey, 'e5')"), F.expr("concat(l_partkey, ' ')"))).alias("t")).groupBy(S.is_number(F.col("t")).alias("is_number")).agg(F.count("*").alias("n")), "lineitem")

# ---- scalar functions
_FORMS = ("concat('+', o_orderkey)", "concat(o_orderkey, ' ')", "concat(o_orderkey, '.5')", "concat('000', o_orderkey)", "concat(o_orderkey, '000000000')", "concat('-', o_orderkey)", "''")
_SUM = "CAST(sum(CAST(CASE WHEN regexp_full_match(t, '{}') THEN CASE WHEN TRY_CAST(ltrim(t, '+') AS HUGEINT) BETWEEN {} AND {} THEN TRY_CAST(ltrim(t, '+') AS HUGEINT) ELSE 0 END ELSE 0 END AS HUGEINT)) AS VARCHAR)"
_events("FN-1", f"SELECT {_SUM.format('[+]?[0-9]+', 0, (1 << 32) - 1)} AS u32, {_SUM.format('[+]?[0-9]+', 0, 255)} AS u8, {_SUM.format('[+]?[0-9]+', 0, (1 << 63) - 1)} AS u64 FROM (SELECT unnest([{', '.join(_FORMS)}]) AS t FROM orders)",
        lambda x: x.select(F.explode(F.array(*map(F.expr, _FORMS))).alias("t")).agg(*[F.sum(f(F.col("t")).cast("decimal(20,0)")).cast("string").alias(c) for c, f in (("u32", S.u32), ("u8", S.u8), ("u64", S.u64))]), "orders")
_events("FN-2", f"SELECT {_SUM.format('[+-]?[0-9]+', -(1 << 63) + 1, (1 << 63) - 1)} AS i64 FROM (SELECT unnest([{', '.join(_FORMS)}]) AS t FROM orders)", lambda x: x.select(F.explode(F.array(*map(F.expr, _FORMS))).alias("t")).agg(F.sum(S.i64(F.col("t")).cast("decimal(20,0)")).cast("string").alias("i64")), "orders")
_events("FN-4", "SELECT l_orderkey, l_linenumber, concat(l_linenumber, ',', l_suppkey, ',0') AS ids FROM lineitem", lambda x: x.select("l_orderkey", "l_linenumber", F.array_join(F.transform(S.wait_connections(F.expr("concat(l_linenumber, ', ', l_suppkey, ',')")), lambda v: v.cast("string")), ",").alias("ids")), "lineitem")
_events("FN-5", "SELECT doc_id, coalesce(list_filter(string_split(replace(text, chr(13), ''), chr(10)), lambda x: x <> '')[-1], '') AS line FROM documents", lambda x: x.select("doc_id", S.last_nonempty_line(F.coalesce("text", F.lit(""))).alias("line")), "documents")
_events("FN-6", "SELECT page_id, string_split(replace(url, chr(92), '/'), '/')[1] AS head FROM pages", lambda x: x.select("page_id", S.path_segment(F.col("url")).alias("head")), "pages")
_events("FN-11", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN ts ELSE TIMESTAMP '1970-01-01' END AS t FROM events", lambda x: x.select("event_id", S.strict_event_time(F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).otherwise(F.lit("2025-02-30T00:00:00.000000"))).alias("t")))
_events("FN-10", "SELECT event_id, TIMESTAMP '2026-01-01 00:00:00' + to_days(CAST(event_id % 28 AS INT)) AS t FROM events", lambda x: x.select("event_id", S.rolling_event_time(F.concat(F.lit("2025-13-"), F.lpad((F.col("event_id") % 28 + 1).cast("string"), 2, "0"), F.lit("T00:00:00.000000"))).alias("t")))
_events("FN-14", "SELECT date_trunc('minute', ts) AS m, time_bucket(INTERVAL 5 MINUTE, ts) AS f, date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY ALL", lambda x: x.groupBy(S.minute(F.col("ts")).alias("m"), S.five_minutes(F.col("ts")).alias("f"), S.hour(F.col("ts")).alias("h")).agg(F.count("*").alias("n")))
_events("FN-20", "SELECT event_type, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.95) AS p95 FROM events GROUP BY 1", lambda x: x.groupBy("event_type").agg(F.percentile("value", F.lit(0.5)).alias("p50"), F.percentile("value", F.lit(0.95)).alias("p95")))
_rich("CTX-2", "SELECT event_id, context_line FROM f", lambda r: r.select(S.map_get(F.col("props"), "EventId").cast("bigint").alias("event_id"), "context_line"))
_rich("NRM-1", "SELECT event_id, sql_norm, param_count FROM f", lambda r: r.select(S.map_get(F.col("props"), "EventId").cast("bigint").alias("event_id"), "sql_norm", "param_count"), True)
_rich("PRJ-7", f"SELECT CASE WHEN param_count = 0 THEN '0' ELSE {_BUCKET} END AS bucket, count(*) AS n FROM f GROUP BY 1", lambda r: r.groupBy(S.param_bucket(F.col("param_count")).alias("bucket")).agg(F.count("*").alias("n")), True)

# ---- rollups
_M = f"count(*) AS cnt, {I('duration_us')} AS dur_sum"
_rollup("AGG-3", f"SELECT {MIN} AS minute, event, process_name, computer_name, {_M}, max(duration_us) AS dur_max, {I('cpu_time_us')} AS cpu_sum, max(memory_peak) AS mem_peak_max, {I('in_bytes + out_bytes')} AS io_bytes FROM f GROUP BY ALL", R.AGG_MINUTE, lambda x: x.drop("dur_q", "last_at"))
_rollup("AGG-4", f"SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS period, event, usr, context_line, {_M}, {I('memory')} AS mem_sum FROM f WHERE context <> '' GROUP BY ALL", R.AGG_CONTEXT, lambda x: x.groupBy("period", "event", "usr", "context_line").agg(*[F.sum(c).alias(c) for c in ("cnt", "dur_sum", "mem_sum")]))
_rollup("AGG-5", f"SELECT {HOUR} AS hour, db_name, {_M}, max(duration_us) AS dur_max, {I('rows_ret')} AS rows_sum, min(sql_text) AS sql_sample, {LATEST('context_line')} AS context_sample FROM f WHERE event = 'DBMSSQL' GROUP BY hour, db_name, sql_text",
        R.AGG_QUERY, lambda x: x.select("hour", "db_name", "cnt", "dur_sum", "dur_max", "rows_sum", "sql_sample", "context_sample"))
_rollup("AGG-6", f"SELECT {HOUR} AS hour, dbms, {_BUCKET} AS param_bucket, {_M}, {I('param_count')} AS params_sum, {LATEST('f.db_name')} AS db_name, {LATEST('sql_text')} AS sql_sample, {LATEST('context_line')} AS context_sample FROM f WHERE sql_norm <> '' GROUP BY hour, dbms, sql_norm, 3",
        R.AGG_QUERY2, lambda x: x.select("hour", "dbms", "param_bucket", "cnt", "dur_sum", "params_sum", "db_name", "sql_sample", "context_sample"))
_rollup("AGG-7", f"SELECT {MIN} AS minute, event, usr, substr(lock_regions, 1, 128) AS lock_regions_short, count(*) AS cnt, {I('duration_us')} AS wait_us_sum, max(duration_us) AS wait_us_max {LOCKED} GROUP BY ALL", R.AGG_LOCKS, lambda x: x.drop("last_at"))
_add("STR-13", SQL["AGG-3"].removeprefix(_WITH), lambda s, d: (lambda r: R.merge(R.build(r.filter("connect_id % 2 = 0"), R.AGG_MINUTE).unionByName(R.build(r.filter("connect_id % 2 = 1"), R.AGG_MINUTE)), R.AGG_MINUTE).drop("dur_q", "last_at"))(C.rich(s, d)))
_events("STR-16", """WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM g)
SELECT user_id, min(ts) AS begin, count(*) AS n FROM s GROUP BY user_id, s""", lambda x: x.groupBy("user_id", F.session_window("ts", "30 minutes")).agg(F.min("ts").alias("begin"), F.count("*").alias("n")).drop("session_window"))
for _name in ("Q-E2", "JOIN-4", "Q-R3"):
    SQL[_name] = _WITH.rstrip("\n") + (SQL[_name].removeprefix(_WITH))
SQL["Q-O8"] = SQL["Q-C3"]
