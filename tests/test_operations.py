"""Running the engine: ingest, store, settings, compaction, retention, restarts, figures, reports."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tracemill.config import Settings
from tracemill.operators import contexts, inventory
from tracemill.operators import parse as P
from tracemill.operators import rollups as R
from tracemill.sources import hadoop, techlog
from tracemill.sources.ingest import ingest
from tracemill.sources.store import EventStore
from tracemill.streaming import follow, metrics

PAD = ",Pad=" + "z" * 90


def logs(tmp_path, days=("251130",), n=3, event="CALL"):
    top = tmp_path / "traces"
    for day in days:
        d = top / "worker_1"
        d.mkdir(parents=True, exist_ok=True)
        (d / f"{day}10.log").write_text("".join(f"00:0{i}.00000{i}-{i + 5},{event},1,Usr=u{i},Context='A : {i}'{PAD}\n" for i in range(n)))
    return str(top)


def test_contexts_are_cut_by_the_parity_of_quotes(spark, tmp_path):
    texts = {
        ",Context='plain'": "plain", ",Sql='a ,Context=',Context='second'": "second", ",Context='it''s ''''x'": "it's ''x", ",Context='a\r\nb',Context='later'": "a\nb",
        ",Context='open": None, ",Context=''": None, ",Context=bare,Context='quoted'": "quoted", ",Sql='x,Context=''no''',Z=1": None, ",Context='''": None, "": None,
    }
    df = spark.createDataFrame([(i, "E" + t) for i, t in enumerate(texts)], "i int, body string")
    got = {r.i: r.context for r in contexts.first_contexts(df).collect()}
    assert [got.get(i) for i in range(len(texts))] == list(texts.values())
    twice = contexts.unique_contexts(df.unionByName(df.filter("i = 1")))
    assert [tuple(r) for r in twice.limit(2).collect()] == [("second", 2), ("a\nb", 1)]
    path = str(tmp_path / "report.txt")
    assert contexts.write_report(twice, path) == 5
    lines = open(path, encoding="utf-8").read().split("\n")
    assert lines[1] == "=" * 80 and lines[3] == "1. (встречается 2 раз)" and lines[4] == "second" and lines[5] == "-" * 80
    assert contexts.first_contexts(df.limit(0)).count() == 0


def test_inventory(spark):
    bodies = ["00:00.000001-10,A,1,X=1,X=y,Y=a", "00:00.000001-30,A,1,X='2'", "00:00.000001-0,B,1"]
    raw = P.parse_events(spark.createDataFrame([(b,) for b in bodies], "body string"))
    got = {(r.event, r.name): (r.present, r.pct, r.type) for r in inventory.of_properties(raw).collect()}
    assert got == {("A", "X"): (2, 100.0, "string"), ("A", "Y"): (1, 50.0, "string")}
    assert {r.event: (r.n, r.avg_us, int(r.max_us)) for r in inventory.of_events(raw).collect()} == {"A": (2, 20.0, 30), "B": (1, 0.0, 0)}


def test_mean_durations_are_not_rounded(spark):
    rows = [("A", "1"), ("A", "1"), ("A", "2"), ("A", None), ("B", None), ("C", "18446744073709551615"), ("C", "18446744073709551615")]
    got = {r.event: (r.n, r.avg_us) for r in inventory.of_events(spark.createDataFrame(rows, "event string, duration string")).collect()}
    assert got == {"A": (4, 4 / 3), "B": (1, None), "C": (2, float(2**64 - 1))}


def test_ingest_figures_schema_and_archive_by_event(spark, tmp_path):
    top = logs(tmp_path)
    with open(f"{top}/worker_1/25113011.log", "w") as f:
        f.write("00:01.000001-5,EXCP,0,A=1" + PAD + "\n00:02.000001-5,BROKEN\n")
    open(f"{top}/worker_1/25113012.log", "w").close()
    os.symlink("nowhere", f"{top}/worker_1/25113013.log")
    s = EventStore(spark, str(tmp_path / "store"), ("event_date", "event"))
    rich = P.to_rich(techlog.load(spark, top)).drop("sql_norm")
    s.ensure_schema(rich.schema)
    s.ensure_schema(rich.schema)
    figures = ingest(spark, top, s)
    assert {k: figures[k] for k in ("events", "parse_skips", "files", "small_file_skips", "failed_files", "inserted_rows")} == {
        "events": 4, "parse_skips": 1, "files": 2, "small_file_skips": 1, "failed_files": 1, "inserted_rows": 4}
    assert figures["bytes"] == sum(n for _, n in techlog.walk(top, 100)[0]) and figures["event_bytes"] == figures["bytes"]
    assert hadoop.names(spark, f"{s.path}/event_date=2025-11-30") == ["event=CALL", "event=EXCP"]
    with pytest.raises(ValueError):
        s.append(rich.withColumn("extra", F.lit(1)))
    assert s.migrate(rich.withColumn("extra", F.lit(1)).schema) == ["extra"] and s.read().filter("extra IS NULL").count() == 4
    assert s.append(rich.withColumn("extra", F.lit(1))) == 4 and s.read().agg(F.sum("extra")).head()[0] == 4 and s.healthy()
    for wrong in (s.migrate, s.ensure_schema):
        with pytest.raises(ValueError):
            wrong(rich.withColumn("level", F.lit(1)).schema)
    empty = ingest(spark, str(tmp_path / "none"), s)
    assert empty["events"] == empty["inserted_rows"] == empty["files"] == 0
    assert ingest(spark, top)["events"] == 4  # parse only


def test_files_of_other_file_systems(spark, tmp_path, monkeypatch):
    top = logs(tmp_path)
    want = sorted(map(tuple, techlog.load(spark, top).select("timestamp", "collection").collect()))
    monkeypatch.setattr(techlog, "remote", lambda p: "://" in p)  # the same way, to a file system that is there
    own = techlog.census(f"file://{top}", 100)
    assert own.files == [(f"file://{p}", n) for p, n in techlog.walk(top, 100)[0]]
    reader = techlog.TraceReader(techlog.Options(f"file://{top}"))
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert len(rows) == len(want) == 3 and {r["filename"] for r in rows} == {"25113010.log"}
    assert techlog.census(f"file://{top}/worker_1/25113010.log", 100).files == own.files
    with pytest.raises(ValueError):
        techlog.TraceSource({"path": "s3://b/x"}).streamReader(None)


def test_runs_cover_what_they_were_made_of():
    assert list(follow.live(["batch=0", "batch=1", "batch=2", "batch=0-1-0", "_batch=0-2-0", "other"])) == ["batch=0-1-0", "batch=2"]
    assert list(follow.live(["batch=0-1-0", "batch=0-1-1", "batch=1", "batch=0-4-0", "batch=11", "batch=9"])) == ["batch=0-4-0", "batch=9", "batch=11"]
    assert list(follow.live(["batch=3-3-0", "batch=3"])) == ["batch=3-3-0"]


def test_compaction_retention_and_a_stop_between(spark, tmp_path):
    target = str(tmp_path / "out")
    days = ["240105", "240106", "251130", "251201"]
    for i, day in enumerate(days):
        follow.write_batch(techlog.load(spark, logs(tmp_path / day, (day,), n=2 + i)), i, target)
    key = lambda df: sorted(map(str, df.collect()))
    total = lambda: follow.rollup(spark, target, R.AGG_MINUTE).agg(F.sum("cnt"), F.max("dur_max")).head()
    rows, sums = key(follow.events(spark, target).drop("props", "sql_params", "lock_wait_conns")), tuple(total())
    assert sums == (14, 9)
    for name in ("events", "agg_minute"):
        kept = {n: f"{target}/{name}/{n}" for n in ("batch=0", "batch=1")}
        for n, path in kept.items():
            os.system(f"cp -r {path} {tmp_path}/saved-{name}-{n}")
        assert follow.compact(spark, target, name) == "batch=0-2-0"
        for n, path in kept.items():
            os.system(f"cp -r {tmp_path}/saved-{name}-{n} {path}")  # as if stopped before they went
        assert [n for n in hadoop.names(spark, f"{target}/{name}") if n[0] != "_"] == ["batch=0", "batch=0-2-0", "batch=1", "batch=3"]
    assert key(follow.events(spark, target).drop("props", "sql_params", "lock_wait_conns")) == rows and tuple(total()) == sums
    assert follow.compact(spark, target, "events") is None  # only one run besides the newest batch
    assert follow.retain(spark, target, "2025-12-02", days=30, rollup_days=400) == ["2024-01-05", "2024-01-06"]
    assert follow.events(spark, target).count() == 9 and tuple(total()) == (9, 9)
    assert "batch=0-2-1" in hadoop.names(spark, f"{target}/agg_minute")
    assert follow.retain(spark, target, "2025-12-02", days=30, rollup_days=400) == [] and tuple(total()) == (9, 9)


def test_restarts():
    class Query:
        def __init__(self, error, progress=None):
            self.error, self.lastProgress = error, progress

        def awaitTermination(self):
            if self.error:
                raise RuntimeError(self.error)

    slept, m = [], metrics.Metrics()
    runs = iter([Query("a"), Query("b"), Query("c"), Query("d", {"batch": 1}), Query("e"), Query(None)])
    follow.supervise(lambda: next(runs), sleep=slept.append, metrics=m)
    assert slept == [1, 2, 4, 1, 2] and m.failed == 5
    slept.clear()
    with pytest.raises(RuntimeError):
        follow.supervise(lambda: Query("x"), attempts=3, sleep=slept.append)
    assert slept == [1, 2]
    slept.clear()
    with pytest.raises(RuntimeError):
        follow.supervise(lambda: Query("x"), attempts=8, sleep=slept.append)
    assert slept == [1, 2, 4, 8, 16, 30, 30]


def test_figures_by_collection(spark, tmp_path):
    m = metrics.Metrics()
    follow.write_batch(techlog.load(spark, logs(tmp_path)), 0, str(tmp_path / "out"), metrics=m)
    size = techlog.walk(logs(tmp_path), 100)[0][0][1]
    assert m.collections == {"traces": {"events": 3, "bytes": size, "newest": datetime(2025, 11, 30, 10, 0, 2, 2)}}
    m.add([{"collection": "traces", "events": 1, "bytes": None, "newest": None, "saturated": 2}])
    text = m.text(now=1764496803.0)  # 2025-11-30 10:00:03
    assert 'collection_events_total{collection="traces"} 4' in text and "tracemill_saturated_texts_total 2" in text
    assert 'collection_lag_seconds{collection="traces"} 0.999998' in text
    assert 'collection_lag_seconds{collection="traces"} 0\n' in m.text(now=0.0)
    assert "_bytes" not in follow.events(spark, str(tmp_path / "out")).columns


def test_settings(tmp_path):
    path = tmp_path / "agent.toml"
    path.write_text('inputs = ["/a", "/b"]\ntarget = "/t"\nstate_dir = "/s"\nidle_close_ms = 10\nsql_norm = false\n')
    s = Settings.read(str(path), poll_ms=7, target=None)
    assert (s.poll_ms, s.target, s.retain_rollup_days) == (7, "/t", 400)
    assert s.follow_arguments() | {"max_bytes_per_trigger": 0} == {
        "path": "/a,/b", "target": "/t", "checkpoint": "/s", "interval": "7 milliseconds", "fingerprints": False, "idle_ms": 10, "max_bytes_per_trigger": 0}
    good = {"inputs": ["/a"], "target": "/t", "state_dir": "/s"}
    for wrong in ({"pol_ms": 1}, {"poll_ms": 0}, {"poll_ms": "5"}, {"poll_ms": True}, {"sql_norm": 1}, {"inputs": "/a"}, {"inputs": []}, {"target": ""}):
        with pytest.raises(ValueError):
            Settings.of(good | wrong)
