"""Trace texts rendered from the ``events`` table, so that the whole path from text to report can be run on it.

``FACTS`` is SQL that Spark and DuckDB both read; the texts are rendered from it and parsed back,
while a check can compute the same reports from the facts directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.parse import read_texts, to_rich

_NUMBERS = ", ".join(map(str, range(1, 21)))
FACTS = f"""
SELECT event_id, ts,
  CASE event_id % 8 WHEN 3 THEN 'DBMSSQL' WHEN 4 THEN 'DBMSSQL' WHEN 5 THEN CASE WHEN event_id % 16 < 8 THEN 'QERR' ELSE 'EXCP' END WHEN 6 THEN 'TLOCK'
    WHEN 7 THEN CASE WHEN event_id % 16 < 8 THEN 'TTIMEOUT' ELSE 'TDEADLOCK' END ELSE 'CALL' END AS event,
  CAST(floor(abs(value) * 1000) AS BIGINT) * (1 + event_id % 13) AS duration_us,
  CASE WHEN event_id % 11 = 0 THEN '' ELSE concat('u', user_id % 40) END AS usr,
  concat('worker', event_id % 3) AS process_name, concat('srv', event_id % 2) AS computer_name,
  CASE WHEN event_id % 9 = 0 THEN '' ELSE event_type END AS method_name, concat('I', event_id % 4) AS iface_name,
  CAST(floor(abs(value) * 1000) AS BIGINT) % 100000 AS cpu_time_us, event_id % 5000 - 2500 AS memory, event_id % 70000 AS memory_peak,
  event_id % 1000 AS in_bytes, event_id % 777 AS out_bytes, event_id % 90 AS session_id, event_id % 50 AS connect_id,
  CASE WHEN event_id % 10 = 0 THEN '' WHEN event_id % 10 = 1
    THEN concat('Report.R', user_id % 3, ' : 7 : Build();', chr(10), chr(9), 'Common.Engine : 2 : Proc.Output (x);')
    ELSE concat('Document.D', user_id % 7, ' : 5 : Go();', chr(13), chr(10), chr(9), 'Common.M', event_id % 5, ' : 10 : Call();') END AS context,
  CASE WHEN event_id % 10 = 0 THEN '' WHEN event_id % 10 = 1 THEN concat('Report.R', user_id % 3, ' : 7 : Build();')
    ELSE concat(chr(9), 'Common.M', event_id % 5, ' : 10 : Call();') END AS context_line,
  CASE WHEN event_id % 8 IN (3, 4, 5) AND event_id % 16 <> 13 THEN concat('SELECT a FROM t', event_id % 5, ' WHERE x = ', event_id, ' AND s = ', chr(39), event_type, chr(39),
    ' AND y IN (', CASE event_id % 3 WHEN 0 THEN '1' WHEN 1 THEN '1, 2, 3' ELSE '{_NUMBERS}' END, ')') ELSE '' END AS sql_text,
  CASE WHEN event_id % 8 IN (3, 4, 5) AND event_id % 16 <> 13 THEN concat('SELECT a FROM t', event_id % 5, ' WHERE x = ? AND s = ? AND y IN (?)') ELSE '' END AS sql_norm,
  CASE WHEN event_id % 8 IN (3, 4, 5) AND event_id % 16 <> 13 THEN CASE event_id % 3 WHEN 0 THEN 3 WHEN 1 THEN 5 ELSE 22 END ELSE 0 END AS param_count,
  CASE WHEN event_id % 8 = 5 THEN concat('error ', event_id % 6, ', ', chr(34), 'quoted', chr(34)) ELSE '' END AS descr,
  CASE WHEN event_id % 16 = 13 AND event_id % 3 > 0 THEN concat('Exc', event_id % 3) ELSE '' END AS exception,
  CASE WHEN event_id % 8 >= 6 THEN concat('Region', event_id % 4, ',x') ELSE '' END AS lock_regions,
  CASE WHEN event_id % 8 >= 6 THEN concat(event_id % 50, ',', (event_id + 7) % 50) ELSE '' END AS wait_connections,
  CASE WHEN event_id % 16 = 15 THEN concat('g', event_id % 3) ELSE '' END AS deadlock_graph,
  CASE WHEN event_id % 8 IN (3, 4) THEN 'DBMSSQL' ELSE '' END AS dbms, CASE WHEN event_id % 8 IN (3, 4) THEN concat('db', event_id % 3) ELSE '' END AS db_name,
  event_id % 100 AS rows_ret, concat('P', event_id % 4) AS tail, event_type, event_id % 4 AS pid
FROM events
"""


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return spark.sql(FACTS.replace("FROM events", "FROM {events}"), events=events)


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_path, content): a trace file for each hour and process, lines in order, with a mark of byte order in front."""
    f = facts(spark, sf_dir)
    single = lambda c: F.concat(F.lit("'"), F.replace(F.col(c), F.lit("'"), F.lit("''")), F.lit("'"))
    double = lambda c: F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))
    plain = {"p:processName": "process_name", "t:computerName": "computer_name", "t:connectID": "connect_id", "SessionID": "session_id", "Usr": "usr", "DBMS": "dbms", "DataBase": "db_name",
             "Rows": "rows_ret", "CpuTime": "cpu_time_us", "Memory": "memory", "MemoryPeak": "memory_peak", "InBytes": "in_bytes", "OutBytes": "out_bytes", "IName": "iface_name", "MName": "method_name",
             "Exception": "exception", "DeadlockConnectionIntersections": "deadlock_graph", "Tail": "tail", "EventId": "event_id"}
    parts = [F.date_format("ts", "mm:ss.SSSSSS"), F.lit("-"), F.col("duration_us").cast("string"), F.lit(","), F.col("event"), F.lit(",1")]
    for name, c in plain.items():
        parts += [F.lit(f",{name}="), F.col(c).cast("string")]
    for name, value in (("Context", single("context")), ("Sql", single("sql_text")), ("Descr", double("descr")), ("Regions", single("lock_regions")), ("WaitConnections", single("wait_connections")), ("Tail", F.lit("second"))):
        parts += [F.lit(f",{name}="), value]
    path = F.concat(F.lit("logs\\worker_"), F.col("pid").cast("string"), F.lit("\\"), F.date_format("ts", "yyMMddHH"), F.lit(".log"))
    line = f.select(path.alias("file_path"), F.struct("event_id", F.concat(*parts).alias("line")).alias("x"))
    # a numbered repartition isn't joined into one task for its few bytes: what is parsed from them takes time
    line = line.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file_path")
    rows = line.groupBy("file_path").agg(F.sort_array(F.collect_list("x")).alias("x"))
    return rows.select("file_path", F.concat(F.lit("﻿junk before the first event\n"), F.array_join(F.transform("x", lambda v: v["line"]), "\r\n"), F.lit("\r\n")).alias("content"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_texts(texts(spark, sf_dir))


def rich(spark: SparkSession, sf_dir: str, fingerprints: bool = False) -> DataFrame:
    """The wide table, parsed back from the texts."""
    return to_rich(raw(spark, sf_dir), fingerprints=fingerprints)
