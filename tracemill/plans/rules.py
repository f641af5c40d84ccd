"""Queries that put single rules of the source, the parser, the fingerprint and the context line to work on whole tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import inventory as I
from ..operators import parse as P
from ..operators import rollups as R
from ..operators.contexts import first_contexts
from ..operators.fingerprint import fingerprint
from ..sources import store, techlog
from ..streaming.metrics import by_collection
from . import carrier as C
from . import dashboards as D

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_FACTS = f"WITH f AS ({C.FACTS})\n"


def _query(name: str, table: str, sql: str):
    """Registers a function of a table's DataFrame with its SQL."""

    def add(run: Callable[[DataFrame], DataFrame]):
        SQL[name] = sql
        QUERIES[name] = lambda spark, d: run(spark.read.parquet(f"{d}/{table}.parquet"))
        return run

    return add


def _files(name: str, sql: str):
    """Registers a function of a folder of trace files with its SQL over the facts."""

    def add(run: Callable[[SparkSession, str], DataFrame]):
        SQL[name] = _FACTS + sql
        QUERIES[name] = lambda spark, d: run(spark, written(spark, d))
        return run

    return add


def written(spark: SparkSession, sf_dir: str) -> str:
    """The trace files of the events in a new folder that all machines share; each task writes its own files."""
    top = (spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="tracemill-")).removeprefix("file://")
    top = f"{top}/traces-{uuid.uuid4().hex}"

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["file_path"], batch["content"], strict=True):
                own = os.path.join(top, *path.split("\\"))
                os.makedirs(os.path.dirname(own), exist_ok=True)
                with open(own, "w", encoding="utf-8", newline="") as f:
                    f.write(content)
            yield pd.DataFrame({"n": [len(batch)]})

    C.texts(spark, sf_dir).mapInPandas(write, "n long").agg(F.sum("n")).collect()
    return top


# ---- files

_BY_EVENT = "SELECT event, count(*) AS n, CAST(sum(duration_us) AS BIGINT) AS total FROM f GROUP BY 1"


def _by_event(raw: DataFrame) -> DataFrame:
    return raw.groupBy("event").agg(F.count("*").alias("n"), F.sum(F.col("duration").cast("bigint")).alias("total"))


@_files("SRC-5", _BY_EVENT)
def byte_order_mark(spark, path):
    return _by_event(techlog.load(spark, path))


@_files("SRC-8", _BY_EVENT)
def small_ranges(spark, path):
    return _by_event(techlog.load(spark, path, range_bytes=4096))


@_files("SRC-1", "SELECT count(DISTINCT strftime(ts, '%y%m%d%H') || pid) AS files FROM f")
def walked(spark, path):
    return techlog.load(spark, path, min_size=0).agg(F.count_distinct("file_path").alias("files"))


@_files("SRC-3", "SELECT strftime(ts, '%Y-%m-%dT%H') AS file_hour, count(*) AS n FROM f GROUP BY 1")
def hours(spark, path):
    return techlog.load(spark, path).groupBy("file_hour").agg(F.count("*").alias("n"))


@_files("SRC-9", "SELECT event_id, context, sql_text FROM f")
def whole_events(spark, path):
    rich = P.to_rich(techlog.load(spark, path, range_bytes=65536), fingerprints=False)
    return rich.select(S.map_get(F.col("props"), "EventId").cast("bigint").alias("event_id"), "context", "sql_text")


@_files("SRC-12", "SELECT event, count(*) AS n FROM f WHERE strftime(ts, '%Y-%m-%dT%H') = '2024-01-05T03' GROUP BY 1")
def pruned(spark, path):
    return techlog.load(spark, path).filter("file_hour = '2024-01-05T03'").groupBy("event").agg(F.count("*").alias("n"))


# ---- parser


def _properties(text) -> F.Column:
    """name=value of all properties, quoted ones in angles."""
    one = lambda p: F.concat(p["name"], F.lit("="), F.when(p["quoted"], F.concat(F.lit("<"), p["value"], F.lit(">"))).otherwise(p["value"]))
    return F.array_join(F.transform(P.properties(text), one), "|")


@_query("PRS-2", "part", "SELECT p_partkey, concat('A=', p_partkey, '|A=|B c=<', p_name, '>|D=7') AS props FROM part")
def names_and_values(x):
    return x.select("p_partkey", _properties(F.concat(F.lit("A="), "p_partkey", F.lit(",A=,B c='"), "p_name", F.lit("',D=7,rest"))).alias("props"))


@_query("PRS-5", "part", "SELECT p_partkey, concat('A=1|B=<', p_name, ',C=2>') AS props FROM part")
def unclosed_quotes(x):
    quote = F.when(F.col("p_partkey") % 2 == 0, "'").otherwise('"')
    return x.select("p_partkey", _properties(F.concat(F.lit("A=1,B="), quote, "p_name", F.lit(",C=2"))).alias("props"))


@_query("PRS-7", "part", "SELECT p_partkey, 'a:true|Guid:false|UUID:false|SearchString:false|b:false' AS numbers FROM part")
def always_text(x):
    text = F.concat(F.lit("a="), "p_partkey", F.lit(",Guid=5,UUID=5,SearchString=5,b='5'"))
    step = x.select("p_partkey", P.properties(text).alias("p"))
    return step.select("p_partkey", F.array_join(F.transform("p", lambda p: F.concat(p["name"], F.lit(":"), P.is_json_number(p).cast("string"))), "|").alias("numbers"))


@_query("PRS-8", "orders", "SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS bare, '0' AS zero FROM orders")
def canonical_durations(x):
    return x.select("o_orderkey", S.canonical_duration(F.concat(F.lit("000"), "o_orderkey")).alias("bare"), S.canonical_duration(F.lit("000")).alias("zero"))


@_query("PRS-12", "events", "SELECT event_id % 7 = 0 AS parse_error, count(*) AS n FROM events GROUP BY 1")
def rejected_headers(x):
    body = F.concat(F.lit("00:00.000000-5,CALL"), F.when(F.col("event_id") % 7 == 0, "").otherwise(",1,A=2"))
    return P.parse_events(x.select(body.alias("body"))).groupBy("parse_error").agg(F.count("*").alias("n"))


# ---- projection, filters, scalars


@_query("PRJ-4", "events", "SELECT CASE WHEN user_id % 5 = 0 THEN '(нет)' ELSE event_type END AS label, count(*) AS n FROM events GROUP BY 1")
def labels(x):
    return x.groupBy(S.or_label(F.when(F.col("user_id") % 5 == 0, "").otherwise(F.col("event_type"))).alias("label")).agg(F.count("*").alias("n"))


_SECONDS = ("1. <0.1с", "2. 0.1–0.5с", "3. 0.5–1с", "4. 1–3с", "5. 3–10с", "6. 10–60с")
_US = "CAST(floor(abs(value) * 100000) AS BIGINT)"
_CLASSES = " ".join(f"WHEN {_US} < {n} THEN '{label}'" for n, label in zip((100_000, 500_000, 1_000_000, 3_000_000, 10_000_000, 60_000_000), _SECONDS, strict=True))


@_query("PRJ-6", "events", f"SELECT CASE {_CLASSES} ELSE '7. >60с' END AS bucket, count(*) AS n FROM events GROUP BY 1")
def duration_classes(x):
    return x.groupBy(S.duration_bucket(F.floor(F.abs("value") * 100000)).alias("bucket")).agg(F.count("*").alias("n"))


@_query("FLT-2", "events", "SELECT count(*) AS n FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-03 06:00:00' AND TIMESTAMP '2024-01-09 12:30:00'")
def time_range(x):
    return D.Scope("2024-01-03 06:00:00", "2024-01-09 12:30:00").of(x, "ts").agg(F.count("*").alias("n"))


@_query("FLT-4", "events", "SELECT usr, count(*) AS n FROM (SELECT concat('u', user_id % 9) AS usr FROM events) WHERE usr IN ('u1', 'u4') GROUP BY 1 UNION ALL SELECT 'all', count(*) FROM events")
def users_or_all(x):
    named = x.select("ts", F.concat(F.lit("u"), F.col("user_id") % 9).alias("usr"))
    some = D.Scope(users=("u1", "u4")).of(named, "ts", "usr").groupBy("usr").agg(F.count("*").alias("n"))
    return some.unionByName(D.ALL.of(named, "ts", "usr").agg(F.lit("all").alias("usr"), F.count("*").alias("n")))


@_query("FLT-6", "events", f"SELECT event_type, count(*) AS n FROM events WHERE {_US} > 3000000 GROUP BY 1")
def threshold(x):
    return x.filter(F.floor(F.abs("value") * 100000) > 3_000_000).groupBy("event_type").agg(F.count("*").alias("n"))


_BIG = "concat(o_orderkey, '00000000000000000000')"


@_query("FN-13", "orders", f"""SELECT CAST(sum(CAST(least(coalesce(TRY_CAST({_BIG} AS HUGEINT), 18446744073709551615), 18446744073709551615) AS HUGEINT)) AS VARCHAR) AS big,
  CAST(sum(o_orderkey) AS VARCHAR) AS plain, '0' AS other FROM orders""")
def saturating(x):
    total = lambda text: F.sum(S.saturating_duration(text)).cast("string")
    return x.agg(total(F.expr(_BIG)).alias("big"), total(F.expr("concat('00', o_orderkey)")).alias("plain"), total(F.expr("concat('+', o_orderkey)")).alias("other"))


@_query("FN-12", "events", "SELECT event_id, TIMESTAMP '1970-01-01' AS t FROM events")
def other_forms(x):
    return x.select("event_id", S.strict_event_time(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("t"))


@_query("FN-15", "part", "SELECT p_partkey, substr(p_name, 2, 3) AS inner_part, left(p_name, 4) AS head FROM part")
def pieces_of_texts(x):
    return x.select("p_partkey", F.substring("p_name", 2, 3).alias("inner_part"), F.left("p_name", F.lit(4)).alias("head"))


# ---- fingerprints: (text, norm, params joined by |) as SQL over orders; k is the key

_K = "CAST(o_orderkey AS VARCHAR)"
_NORMS = {
    "NRM-2": (f"concat('x = ', {_K}, ' AND y = -', {_K}, '.5 - .', {_K}, 'e3')", "'x = ? AND y = ? - ?'", f"concat({_K}, '|-', {_K}, '.5|.', {_K}, 'e3')"),
    "NRM-3": (f"concat('f(0x', {_K}, 'aF)')", "'f(?)'", f"concat('0x', {_K}, 'aF')"),
    "NRM-4": (f"concat('FROM #tt', {_K}, ' JOIN ##g', {_K}, 'x')", "'FROM #tt JOIN ##g'", "''"),
    "NRM-5": (f"concat('a = @P', {_K}, ' OR b = @name', {_K})", f"concat('a = @P OR b = @name', {_K})", "''"),
    "NRM-6": (f"concat('a = ? AND b = ?', chr(10), 'p_0: ', {_K}, chr(10), chr(10), 'p_1: ', chr(39), 'q', chr(10), 'r', chr(39), chr(10))",
              "'a = ? AND b = ?'", f"concat({_K}, '|q', chr(10), 'r')"),
    "NRM-7": (f"concat('a = ? AND b = ? AND c = ?', chr(10), 'p_0: ', {_K}, chr(10))", "'a = ? AND b = ? AND c = ?'", f"concat({_K}, '|?|?')"),
    "NRM-8": (f"concat('IN (1, ', {_K}, ') VALUES (', {_K}, ', 2), (3, 4) g(5, 6)')", "'IN (?) VALUES (?) g(?, ?)'", f"concat('1|', {_K}, '|', {_K}, '|2|3|4|5|6')"),
    "NRM-9": (f"concat('  a', chr(9), chr(10), ' = ', {_K}, '   ')", "'a = ?'", _K),
    "NRM-10": (f"concat('Select [Odd]]', {_K}, '] FROM Поле', {_K}, ' ;')", f"concat('Select [Odd]]', {_K}, '] FROM Поле', {_K}, ' ;')", "''"),
}


def _norm(text: str) -> Callable[[DataFrame], DataFrame]:
    def run(x: DataFrame) -> DataFrame:
        step = x.select("o_orderkey", fingerprint(F.expr(text.replace("AS VARCHAR", "AS STRING"))).alias("f"))
        return step.select("o_orderkey", F.col("f.norm").alias("norm"), F.array_join("f.params", "|").alias("params"))

    return run


for _name, (_text, _want, _params) in _NORMS.items():
    _query(_name, "orders", f"SELECT o_orderkey, {_want} AS norm, {_params} AS params FROM orders")(_norm(_text))

# ---- the significant context line

_STACK = "concat('Report.R', user_id, ' : 3 : Run();', chr(10), chr(9), 'Common.M : 8 : ', CASE WHEN event_id % 2 = 0 THEN 'E.Output (x)' ELSE 'E.Other(x)' END)"
_LAST = "concat(chr(9), 'Common.M : 8 : ', CASE WHEN event_id % 2 = 0 THEN 'E.Output (x)' ELSE 'E.Other(x)' END)"


@_query("CTX-3", "events", f"SELECT event_id, CASE WHEN event_id % 2 = 0 THEN concat('Report.R', user_id, ' : 3 : Run();') ELSE {_LAST} END AS line FROM events")
def culprits(x):
    return x.select("event_id", S.context_line(F.expr(_STACK)).alias("line"))


@_query("CTX-4", "events", f"SELECT event_id, {_LAST} AS line FROM events")
def without_smartness(x):
    return x.select("event_id", S.context_line(F.expr(_STACK), smart=False).alias("line"))


@_query("CTX-1", "documents", "SELECT doc_id, coalesce(list_filter(string_split(replace(text, chr(13), ''), chr(10)), lambda x: x <> '')[-1], '') AS line FROM documents")
def last_lines(x):
    return x.select("doc_id", S.context_line(F.coalesce("text", F.lit("")), smart=False).alias("line"))


# ---- sketches: each reported quantile must stand at a rank within the sketches' error

#: Rank error that is allowed (share of the rows); sketches of the default size stay within half of it with probability 0.99.
RANK_ERROR = 0.03


def _in_rank(report: DataFrame, rows: DataFrame, key: str, quantiles: dict[str, float], unit: float = 1.0, half: float = 0.0) -> DataFrame:
    """The report with each quantile replaced by whether the rows (key, v) put it at its rank; ``half`` is half a unit of its last digit."""
    said = {c: F.col(c) * unit for c in quantiles}
    places = [F.count("*").alias("_n")]
    for c, x in said.items():
        places += [F.count_if(F.col("v") < x - half).alias(f"_below_{c}"), F.count_if(F.col("v") <= x + half).alias(f"_to_{c}")]
    found = rows.join(report.select(key, *quantiles), key).groupBy(key).agg(*places)
    good = lambda c, q: (F.col(f"_below_{c}") <= (q + RANK_ERROR) * F.col("_n") + 1) & (F.col(f"_to_{c}") >= (q - RANK_ERROR) * F.col("_n") - 1)
    return report.drop(*quantiles).join(found, key).select(*[c for c in report.columns if c not in quantiles], *[good(c, q).alias(c) for c, q in quantiles.items()])


def _minutes(rich: DataFrame, event: str) -> DataFrame:
    return rich.filter(F.col("event") == event).select(S.minute(F.col("ts")).alias("time"), F.col("duration_us").alias("v"))


def _sketched(name: str, sql: str, event: str, quantiles: dict[str, float], report: Callable[[DataFrame], DataFrame], half: float) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        rich = C.rich(spark, d)
        return _in_rank(report(R.build(rich, R.AGG_MINUTE)), _minutes(rich, event), "time", quantiles, 1e6, half)

    QUERIES[name], SQL[name] = run, _FACTS + sql


_sketched(
    "Q-C3_sketch", "SELECT date_trunc('minute', ts) AS time, count(*) AS calls_per_min, true AS p50_s, true AS p95_s, true AS p99_s FROM f WHERE event = 'CALL' GROUP BY 1",
    "CALL", {"p50_s": 0.5, "p95_s": 0.95, "p99_s": 0.99}, D.response_by_minute, 500.0,
)
_sketched(
    "Q-D1", "SELECT date_trunc('minute', ts) AS time, CAST(sum(duration_us) AS BIGINT) / 60e6 AS busy_workers, count(*) AS queries_per_min, true AS p95_s FROM f WHERE event = 'DBMSSQL' GROUP BY 1",
    "DBMSSQL", {"p95_s": 0.95}, D.busy_by_minute, 5000.0,
)


@_query("FN-20_sketch", "events", "SELECT event_type, true AS p50, true AS p95, true AS p99 FROM events GROUP BY 1")
def merged_sketches(x):
    """Sketches of a hundred parts, merged."""
    rows = x.select("event_type", F.floor(F.col("value") * 1000).cast("bigint").alias("v"), (F.col("event_id") % 100).alias("part"))
    parts = rows.groupBy("event_type", "part").agg(F.kll_sketch_agg_bigint("v").alias("q"))
    merged = parts.groupBy("event_type").agg(F.kll_merge_agg_bigint("q").alias("q"))
    quantiles = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    report = merged.select("event_type", *[R.quantile(F.col("q"), q).alias(c) for c, q in quantiles.items()])
    return _in_rank(report, rows.drop("part"), "event_type", quantiles)


# ---- contexts by the parity of quotes, inventory, records, figures by collection

SQL["AGG-1"] = _FACTS + "SELECT context, count(*) AS n FROM (SELECT replace(context, chr(13), '') AS context FROM f WHERE context <> '') GROUP BY 1"
QUERIES["AGG-1"] = lambda spark, d: first_contexts(P.split_events(C.texts(spark, d))).groupBy("context").agg(F.count("*").alias("n"))

_SOME = "concat('00:00.000000-', event_id % 50, ',', event_type, ',1', CASE WHEN event_id % 3 = 0 THEN concat(',A=', event_id, ',A=x') ELSE '' END, ',B=', CASE WHEN event_id % 2 = 0 THEN 'x' ELSE '7' END, ',Guid=5')"


@_query("AGG-10", "events", """WITH n AS (SELECT event_type AS event, count(*) AS n FROM events GROUP BY 1),
  p AS (SELECT event_type AS event, unnest(CASE WHEN event_id % 3 = 0 THEN ['A', 'B', 'Guid'] ELSE ['B', 'Guid'] END) AS name FROM events)
SELECT event, name, count(*) AS present, 100 * count(*) / max(n.n) AS pct, CASE name WHEN 'A' THEN 'number' ELSE 'string' END AS type FROM p JOIN n USING (event) GROUP BY 1, 2""")
def property_inventory(x):
    return I.of_properties(P.parse_events(x.select(F.expr(_SOME).alias("body"))))


@_query("AGG-10_events", "events", "SELECT event_type AS event, count(*) AS n, avg(event_id % 50) AS avg_us, CAST(max(event_id % 50) AS DECIMAL(20, 0)) AS max_us FROM events GROUP BY 1")
def event_inventory(x):
    return I.of_events(P.parse_events(x.select(F.expr(_SOME).alias("body"))))


@_files("SRC-10", "SELECT event_id, event, duration_us, context, sql_text, descr, memory, session_id FROM f")
def records(spark, path):
    """Events written as records and read back."""
    store.write_ndjson(techlog.load(spark, path), f"{path}-records")
    rich = P.to_rich(store.read_ndjson(spark, f"{path}-records"), fingerprints=False)
    return rich.select(S.map_get(F.col("props"), "EventId").cast("bigint").alias("event_id"), "event", "duration_us", "context", "sql_text", "descr", "memory", "session_id")


@_query("STR-14", "events", """SELECT event_type AS collection, count(*) AS events, CAST(sum(event_id % 100) AS BIGINT) AS bytes, max(ts) AS newest, count(*) FILTER (event_id % 7 = 0) AS saturated
FROM events GROUP BY 1""")
def figures_by_collection(x):
    return by_collection(x.withColumnRenamed("event_type", "collection"), "event_id % 100", saturated="event_id % 7 = 0")
