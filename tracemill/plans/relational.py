"""Relational shapes of the reports on the star-schema tables, where scans, pushdown and joins can be seen by themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..streaming.metrics import LATENCY_BOUNDS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str):
    def register(run: Callable[[Callable[[str], DataFrame]], DataFrame]):
        QUERIES[name] = lambda spark, d: run(lambda t: spark.read.parquet(f"{d}/{t}.parquet"))
        SQL[name] = sql
        return run

    return register


@_query("FLT-1", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_shipdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1995-06-30' AND l_quantity > 45")
def filters(t):
    """Equality, range and threshold: all reach the Parquet scan."""
    x = t("lineitem").filter(F.col("l_returnflag").isin("A", "R") & F.expr("l_shipdate BETWEEN timestamp_ntz'1995-01-01 00:00:00' AND timestamp_ntz'1995-06-30 00:00:00'") & (F.col("l_quantity") > 45))
    return x.select("l_orderkey", "l_linenumber", "l_quantity")


@_query("FLT-3", "SELECT c_custkey, c_mktsegment FROM customer WHERE regexp_full_match(c_mktsegment, '(AUTO|BUILD).*') AND c_name <> ''")
def anchored_pattern(t):
    return t("customer").filter(F.col("c_mktsegment").rlike(r"\A(?:(AUTO|BUILD).*)\z") & (F.col("c_name") != "")).select("c_custkey", "c_mktsegment")


@_query("FLT-7", "SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING list_contains(list(l_suppkey), 7)")
def has_value(t):
    return t("lineitem").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("s")).filter(F.array_contains("s", 7)).select("l_orderkey")


@_query("FLT-8", "SELECT event_id, coalesce(props->>'$.k', '') AS k, coalesce(props->>'$.none', '') AS missing FROM events")
def map_lookup(t):
    m = F.from_json("props", "map<string,string>")
    return t("events").select("event_id", S.map_get(m, "k").alias("k"), S.map_get(m, "none").alias("missing"))


@_query("FLT-9", "SELECT count(*) AS n FROM part WHERE starts_with(p_type, 'S')")
def prefix(t):
    return t("part").filter(F.col("p_type").startswith("S")).agg(F.count("*").alias("n"))


@_query("FLT-10", "SELECT l_partkey, count(DISTINCT l_returnflag) AS kinds FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) > 1")
def having(t):
    return t("lineitem").groupBy("l_partkey").agg(F.count_distinct("l_returnflag").alias("kinds")).filter("kinds > 1")


@_query("JOIN-1", """WITH top AS (SELECT o_orderpriority, o_orderstatus, count(*) AS cnt, min(o_orderkey) AS sample FROM orders GROUP BY 1, 2 ORDER BY cnt DESC, 1, 2 LIMIT 10)
SELECT top.o_orderpriority, top.o_orderstatus, cnt, o.o_custkey FROM top LEFT JOIN orders o ON o.o_orderpriority = top.o_orderpriority AND o.o_orderstatus = top.o_orderstatus AND o.o_orderkey = top.sample""")
def left_join(t):
    o = t("orders")
    keys = ["o_orderpriority", "o_orderstatus"]
    top = o.groupBy(*keys).agg(F.count("*").alias("cnt"), F.min("o_orderkey").alias("o_orderkey")).orderBy(F.desc("cnt"), *keys).limit(10)
    return top.join(o.select(*keys, "o_orderkey", "o_custkey"), [*keys, "o_orderkey"], "left").select(*keys, "cnt", "o_custkey")


@_query("JOIN-2", """WITH a AS (SELECT user_id, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-08' GROUP BY 1), b AS (SELECT user_id, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15' GROUP BY 1)
SELECT user_id, coalesce(a.n, 0) AS before_n, coalesce(b.n, 0) AS after_n FROM a FULL JOIN b USING (user_id)""")
def full_join(t):
    n = lambda where, name: t("events").filter(where).groupBy("user_id").agg(F.count("*").alias(name))
    both = n("ts < timestamp_ntz'2024-01-08 00:00:00'", "a").join(n("ts >= timestamp_ntz'2024-01-08 00:00:00' AND ts < timestamp_ntz'2024-01-15 00:00:00'", "b"), "user_id", "full")
    return both.select("user_id", F.coalesce("a", F.lit(0)).alias("before_n"), F.coalesce("b", F.lit(0)).alias("after_n"))


@_query("JOIN-3", "SELECT l_partkey, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q FROM lineitem WHERE l_partkey IN (SELECT l_partkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 20) GROUP BY 1")
def semi_join(t):
    x = t("lineitem")
    top = x.groupBy("l_partkey").agg(F.count("*").alias("c")).orderBy(F.desc("c"), "l_partkey").limit(20).select("l_partkey")
    return x.join(F.broadcast(top), "l_partkey", "left_semi").groupBy("l_partkey").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("q"))


@_query("JOIN-5", "SELECT o_orderpriority, count(*) AS n, 100.0 * count(*) / (SELECT count(*) FROM orders) AS pct FROM orders GROUP BY 1")
def scalar_subquery(t):
    o = t("orders")
    return o.groupBy("o_orderpriority").agg(F.count("*").alias("n")).join(F.broadcast(o.agg(F.count("*").alias("all")))).select("o_orderpriority", "n", (100.0 * F.col("n") / F.col("all")).alias("pct"))


@_query("JOIN-anti", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def anti_join(t):
    return t("customer").join(t("orders").filter("o_orderstatus = 'F'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@_query("WIN-1", "SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS whole FROM lineitem GROUP BY 1, 2")
def share_of_total(t):
    return t("lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n")).withColumn("whole", F.expr("sum(n) OVER ()"))


@_query("WIN-2", "WITH a AS (SELECT p_brand, p_size % 5 AS b, count(*) AS n FROM part GROUP BY 1, 2) SELECT p_brand, CAST(b AS INT) AS b, n, max(n) OVER (PARTITION BY p_brand) AS heaviest FROM a")
def window_over_aggregate(t):
    a = t("part").groupBy("p_brand", (F.col("p_size") % 5).alias("b")).agg(F.count("*").alias("n"))
    return a.withColumn("heaviest", F.expr("max(n) OVER (PARTITION BY p_brand)"))


@_query("SRT-1", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def top_k(t):
    return t("orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50).select("o_orderkey", "o_totalprice")


@_query("SRT-2", "SELECT b, n, CASE b WHEN '0' THEN 0 WHEN '1' THEN 1 WHEN '2-10' THEN 2 WHEN '11-100' THEN 3 ELSE 9 END AS place FROM (SELECT CASE WHEN p_size <= 1 THEN '1' WHEN p_size <= 10 THEN '2-10' ELSE '11-100' END AS b, count(*) AS n FROM part GROUP BY 1)")
def ordinal_sort(t):
    x = t("part").groupBy(S.param_bucket(F.col("p_size")).alias("b")).agg(F.count("*").alias("n"))
    return x.withColumn("place", S.param_bucket_order(F.col("b"))).orderBy("place")


@_query("SRC-13", "SELECT source, lang, count(*) AS n, min(n_chars) AS low, max(n_chars) AS high FROM documents GROUP BY 1, 2")
def inventory(t):
    return t("documents").groupBy("source", "lang").agg(F.count("*").alias("n"), F.min("n_chars").alias("low"), F.max("n_chars").alias("high"))


@_query("AGG-9", "SELECT DISTINCT p_brand FROM part")
def distinct(t):
    return t("part").select("p_brand").distinct()


@_query("AGG-11", "SELECT " + ", ".join(f"count(*) FILTER (value <= {b * 10}) AS le_{i}" for i, b in enumerate(LATENCY_BOUNDS)) + ", max(ts) AS newest FROM events")
def cumulative_histogram(t):
    return t("events").agg(*[F.count_if(F.col("value") <= b * 10).alias(f"le_{i}") for i, b in enumerate(LATENCY_BOUNDS)], F.max("ts").alias("newest"))


@_query("FN-7", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE o_orderpriority END AS v FROM orders")
def first_nonempty(t):
    return t("orders").select("o_orderkey", S.first_nonempty(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).otherwise(""), F.col("o_orderpriority")).alias("v"))


@_query("FN-3", "SELECT p_partkey, trim(concat('  ', p_name, chr(9), ' '), ' ') AS spaces, trim(concat(' ', chr(9), p_name, ' '), ' ' || chr(9)) AS blanks FROM part")
def trims(t):
    return t("part").select("p_partkey", S.trim_spaces(F.concat(F.lit("  "), "p_name", F.lit("\t "))).alias("spaces"), S.trim_blanks(F.concat(F.lit(" \t"), "p_name", F.lit(" "))).alias("blanks"))


@_query("SRC-4", "SELECT n_nationkey, concat('data', chr(92), n_name, chr(92), '25010203.log') AS path, '2025-01-02T03:' AS hour FROM nation")
def paths(t):
    p = F.concat(F.lit("/var/./data/"), "n_name", F.lit("/25010203.log"))
    return t("nation").select("n_nationkey", S.relative_path(p).alias("path"), S.date_prefix(F.lit("25010203.log")).alias("hour"))
