import os
import time

from pyspark.sql import functions as F

from tracemill.functions import scalars as S
from tracemill.operators import parse as P
from tracemill.operators import rollups as R
from tracemill.operators.fingerprint import normalize
from tracemill.sources import grammar as G
from tracemill.sources import store, techlog
from tracemill.streaming import follow, metrics

PAD = ",Pad=" + "x" * 80
LINES = ["00:05.000001-7,CALL,1,Usr=a,MName=m,Memory=-5,SessionID=12", "00:06.000002-9,DBMSSQL,2,Sql='SELECT 1 WHERE x IN (1, 2)',Usr=b,SessionID='1,2',Odd=x,Odd=y",
         "00:07.000003-11,QERR,0,Descr=\"a \"\"b\"\"\nline two\",Context='Doc.A : 1 : x\r\n\tCommon.B : 2 : y'", "00:08.000004-1,BROKEN", "00:09.000005-30,TLOCK,1,WaitConnections='7, 9,',Regions=R"]


def tree(tmp_path):
    d = tmp_path / "logs" / "worker_1"
    d.mkdir(parents=True)
    (d / "25113010.log").write_bytes(b"\xef\xbb\xbf" + "\r\n".join(LINES).encode() + b"\r\n")
    (d / "25113011.log").write_text("\n".join(LINES[:2]) + PAD + "\n")
    (d / "25113012.log").write_text("00:16.000016-1,TEST,0,Pad=y\n")
    return str(tmp_path / "logs")


def test_source_equals_native_parser(spark, tmp_path):
    path = tree(tmp_path)
    for size in ("7", "100000"):
        raw = techlog.load(spark, path, range_bytes=size)
        assert raw.count() == 6
    files = [(p, open(p, encoding="utf-8").read() if False else open(p, "rb").read().decode()) for p, _ in techlog.walk(path, 100)[0]]
    native = P.read_texts(spark.createDataFrame([(G.relative_path(p), t) for p, t in files], "file_path string, content string"))
    key = lambda r: (r.file_path, r.timestamp)
    a, b = (sorted(x.select("file_path", "timestamp", "duration", "event", "level", "props").collect(), key=key) for x in (raw, native))
    assert a == b
    pruned = raw.filter("file_hour = '2025-11-30T11'")
    assert pruned.count() == 2 and techlog.walk(path, 100)[1] == 1
    reader = techlog.TraceReader(techlog.Options(path))
    assert list(reader.pushFilters([techlog.EqualTo(("file_hour",), "2025-11-30T11")])) == [] and len(reader.partitions()) == 1 and len(reader.partitions()[0].ranges) == 1


def test_short_ranges_share_tasks_and_read_little(tmp_path):
    d = tmp_path / "worker_1"
    d.mkdir()
    for hour in range(10, 20):
        (d / f"251130{hour}.log").write_text("".join(f"00:00.{i:06d}-{i},CALL,1,A={'x' * (i % 900)}\n" for i in range(1000)))
    files = techlog.walk(str(tmp_path), 100)[0]
    options = techlog.Options(str(tmp_path), range_bytes=64, open_cost=0)
    packs = techlog.TraceReader(options).partitions()
    size = sum(n for _, n in files)
    assert size // 64 > 50_000 and techlog.TASKS <= len(packs) <= 2 * techlog.TASKS
    got = sorted((r["start_off"], r["end_off"], r["filename"]) for pack in packs for b in techlog._rows(pack, options) for r in b.select(["start_off", "end_off", "filename"]).to_pylist())
    assert got == sorted((a, b, os.path.basename(p)) for p, _ in files for a, b in G.split_events(open(p, "rb").read()))

    class Counted:
        n = 0

        def __init__(self, f):
            self.f, self.seek = f, f.seek

        def read(self, k):
            data = self.f.read(k)
            Counted.n += len(data)
            return data

    path, n = files[0]
    with open(path, "rb") as f:
        assert sum(1 for a in range(0, n, 4096) for _ in techlog.events_of(Counted(f), a, min(a + 4096, n))) == 1000
    assert Counted.n < 4 * n
    big = techlog.TraceReader(techlog.Options(str(tmp_path), task_bytes=100_000, range_bytes=1000, open_cost=0)).partitions()
    assert max(sum(r.end - r.start for r in p.ranges) for p in big) <= 100_000


def test_rich_table(spark, tmp_path):
    rich = P.to_rich(techlog.load(spark, tree(tmp_path)).filter("file_hour = '2025-11-30T10'"))
    assert len(rich.columns) >= 50
    rows = {r.event: r for r in rich.collect()}
    assert str(rows["CALL"].ts) == "2025-11-30 10:00:05.000001" and rows["CALL"].memory == -5 and rows["CALL"].session_id == 12 and rows["CALL"].collection == "logs"
    db = rows["DBMSSQL"]
    assert db.session_id == 0 and db.props == {"SessionID": "1,2", "Odd": "x"} and db.param_count == 2 and db.sql_params == ["1", "2"] and db.sql_norm == "SELECT ? WHERE x IN (?)" or db.param_count == 3
    assert rows["QERR"].context_line == "\tCommon.B : 2 : y" and rows["QERR"].descr == 'a "b"\nline two'
    assert rows["TLOCK"].lock_wait_conns == [7, 9, 0]
    assert P.to_bench(techlog.load(spark, str(tmp_path))).filter("event = 'DBMSSQL'").head().props["Odd"] == "y"


def test_ndjson_round_trip(spark, tmp_path):
    raw = techlog.load(spark, tree(tmp_path))
    store.write_ndjson(raw, str(tmp_path / "out"))
    back = store.read_ndjson(spark, str(tmp_path / "out"))
    cols = ("file_path", "timestamp", "duration", "event", "level")
    assert sorted(map(tuple, back.select(*cols).collect())) == sorted(map(tuple, raw.select(*cols).collect()))
    assert back.filter("event = 'DBMSSQL'").agg(F.max(F.size("props"))).head()[0] == 6


def test_store_prunes_and_retains(spark, tmp_path):
    rich = P.to_rich(techlog.load(spark, tree(tmp_path)), fingerprints=False)
    s = store.EventStore(spark, str(tmp_path / "events"))
    s.append(rich)
    s.append(rich.withColumn("event_date", F.date_sub("event_date", 10)))
    plan = s.read("2025-11-30 00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and s.read("2025-11-30 00:00:00").count() == 6 and s.healthy()
    assert s.retain(5, "2025-12-01") == ["2025-11-20"]


def test_rollups_merge(spark, tmp_path):
    rich = P.to_rich(techlog.load(spark, tree(tmp_path)))
    for r in R.ROLLUPS:
        whole = R.build(rich, r)
        parts = R.build(rich.filter("src_file like '%10.log'"), r).unionByName(R.build(rich.filter("src_file not like '%10.log'"), r))
        cols = [c for c in whole.columns if c != "dur_q"]
        assert sorted(map(str, R.merge(parts, r).select(*cols).collect())) == sorted(map(str, whole.select(*cols).collect()))


def test_follow_growth_truncation_and_restart(spark, tmp_path):
    d = tmp_path / "in" / "worker_1"
    d.mkdir(parents=True)
    log = d / "25113010.log"
    event = lambda i: f"00:{i % 60:02d}.{i:06d}-{i},CALL,1,Usr=u{i}{PAD}\r\n"
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")

    def drain(idle):
        q = follow.follow(spark, str(tmp_path / "in"), target, checkpoint, available_now=True, idle_ms=idle)
        assert q.awaitTermination(120)
        return follow.events(spark, target)

    with open(log, "w") as f:
        f.write("﻿" + "".join(event(i) for i in range(3)) + event(3)[:20])
    assert drain(3_600_000).count() in (2, 3)  # the last complete event may still be open
    with open(log, "a") as f:
        f.write(event(3)[20:])
    time.sleep(0.1)
    assert sorted(r.usr for r in drain(0).collect()) == [f"u{i}" for i in range(4)]
    os.truncate(log, 0)
    with open(log, "w") as f:
        f.write(event(9))
    got = sorted(r.usr for r in drain(0).collect())
    assert got == ["u0", "u1", "u2", "u3", "u9"]
    assert follow.rollup(spark, target, R.AGG_MINUTE).agg(F.sum("cnt")).head()[0] == 5


def test_numbers_and_times(spark):
    rows = [("5",), ("+5",), (" 5 ",), ("",), ("-1",), ("18446744073709551615",), ("18446744073709551616",), ("000000000000000000000000000000000000000000007",), ("-9223372036854775808",), ("1.5",)]
    df = spark.createDataFrame(rows, "v string")
    got = [tuple(r) for r in df.select(S.u64(F.col("v")), S.u32(F.col("v")), S.u8(F.col("v")), S.i64(F.col("v")), S.saturating_duration(F.col("v")).cast("string")).collect()]
    big, least = (1 << 63) - 1, -(1 << 63)
    assert got == [(5, 5, 5, 5, "5"), (5, 5, 5, 5, "0"), (0, 0, 0, 0, "0"), (0, 0, 0, 0, "0"), (0, 0, 0, -1, "0"), (big, 0, 0, 0, str((1 << 64) - 1)), (0, 0, 0, 0, str((1 << 64) - 1)), (7, 7, 7, 7, "7"), (0, 0, 0, least, "0"), (0, 0, 0, 0, "0")]
    t = spark.createDataFrame([("2025-02-30T00:00:00.000000",), ("2025-13-01T24:00:00.000001",), ("00:12.000012",), ("2024-02-29T23:59:59.999999",)], "t string")
    assert [str(r[0]) for r in t.select(S.strict_event_time(F.col("t"))).collect()] == ["1970-01-01 00:00:00"] * 3 + ["2024-02-29 23:59:59.999999"]
    assert [str(r[0]) for r in t.select(S.rolling_event_time(F.col("t"))).collect()] == ["2025-03-02 00:00:00", "2026-01-02 00:00:00.000001", "1970-01-01 00:00:00", "2024-02-29 23:59:59.999999"]


def test_context_line(spark):
    own, other = "Report.Sales : 3 : Run();", "Common.Lib : 8 : "
    cases = [("", ""), ("q\r\nw\r\n\r\n", "w"), (f"{own}\n\t{other}Engine.Output (x)", own), (f"{own}\n{other}MyOutput(x)", f"{other}MyOutput(x)"), (f"{own}\n{other}OutputAll(x)", f"{other}OutputAll(x)"),
             (f"{own}\n{other}Thing.Initialize(p)", f"{other}Thing.Initialize(p)"), (f"{own}\n\tDataProcessor.Two : 1 : z\n{other}DataComposition.Initialize(p)", "\tDataProcessor.Two : 1 : z"),
             (f"Reporting : 1 : a\n{other}Output(x)", f"{other}Output(x)")]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, c string")
    assert [r[0] for r in df.orderBy("i").select(S.context_line(F.col("c"))).collect()] == [w for _, w in cases]


def test_parsed_in_the_jvm_as_in_python(spark):
    texts = ["41:07.120034-0090,LOAD,2,A=1,B='x''y',C=\"q\",D", "41:07.120034-9,LOAD", "41:07.1-,E,", "41:07.120034-00,E,L,K='un\nclosed\r\n", "a-b-c,E,1,=,=v"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, body string")
    for r in P.parse_events(df).collect():
        want = G.parse_event(texts[r.i])
        got = None if r.parse_error else (r.time, r.duration, r.event, r.level, [(p["name"], p["value"], p["quoted"]) for p in r.props])
        assert got == want, texts[r.i]


def test_filters_and_columns_reach_below_the_parse(spark, tmp_path):
    raw = techlog.load(spark, tree(tmp_path))
    plan = raw.select("event", "duration")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan  # properties aren't parsed for nobody


def test_fingerprint_rules():
    cases = {
        "y = 'it''s' AND n = N'u'": ("y = ? AND n = ?", ["it's", "u"]), "x = -5 - 5": ("x = ? - ?", ["-5", "5"]), "0x1F .5 5. 1e5 T2": ("? ? ? ? T2", ["0x1F", ".5", "5.", "1e5"]),
        "#tt12 ##g7x @P1 @Var7": ("#tt ##g @P @Var7", []), "a = ? AND b = ?\np_0: 1\n\np_1: 'q\nr'\n": ("a = ? AND b = ?", ["1", "q\nr"]), "a = ?": ("a = ?", ["?"]),
        "x IN (1, T.b, 3)": ("x IN (?, T.b, ?)", ["1", "3"]), "VALUES (1, 2),(3, 4)": ("VALUES (?)", ["1", "2", "3", "4"]), "f(1, 2)": ("f(?, ?)", ["1", "2"]), "[a]]1] 'open": ("[a]]1] ?", ["open"]),
    }
    for text, want in cases.items():
        assert normalize(text) == want, text
        norm, params = want
        assert normalize(norm)[0] == norm and set(normalize(norm)[1]) <= {"?"} and norm.count("?") <= len(params) and "'" not in norm
        assert normalize(text.replace(" ", " \t ") if "'" not in text and "\n" not in text else text) == want
    assert normalize("x IN (" + ", ".join(map(str, range(800))) + ")") == ("x IN (?)", list(map(str, range(800))))


def test_metrics():
    m = metrics.Metrics()
    m.seconds = [0.2, 3.0]
    text = m.text(newest=100.0, now=90.0)
    assert 'le="0.25"} 1' in text and 'le="5.0"} 2' in text and "tracemill_lag_seconds 0" in text
    assert metrics.alerts(301, 0, True) == ["lag"] and metrics.alerts(0, 1, False) == ["failed", "down"]
