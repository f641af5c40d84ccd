import hashlib
from collections import defaultdict

from tracemill.llm import line_dedup

from .common import SCHEMA, awkward, frame, prose, rows, seeded

STRIP = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(STRIP))


def brute(docs, min_chars=40, min_docs=5):
    held = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            held[key(line)].add(i)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= min_chars and len(held[key(x)]) >= min_docs and i < max(held[key(x)]))]
        text = "\n".join(kept)
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256(text.encode()).hexdigest(), text))
    return sorted(out)


def sample():
    rng = seeded(3)
    shared = ["Ümlaut Line That IS long enough to be a key of its own", "x" * 40, "y" * 39, "  " + "z" * 60 + "\t"]
    texts = awkward()
    for i in range(60):
        lines = [prose(rng, rng.randrange(0, 12)) for _ in range(rng.randrange(0, 6))] + rng.sample(shared, rng.randrange(0, 4))
        rng.shuffle(lines)
        if i % 7 == 0:
            lines.append(shared[0].upper().replace("Ü", "Ü"))
        texts.append("\n".join(lines + lines[:1] * (i % 3)))
    return texts


def test_matches_brute_force(spark):
    texts = sample()
    docs = list(enumerate(texts))
    got = sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.line_counts(frame(spark, texts)).collect())
    want = brute(docs)
    assert got == [w[:4] for w in want]
    assert sum(w[2] for w in want) > 20


def test_texts_keep_columns(spark):
    texts = sample()
    df = frame(spark, texts).withColumnsRenamed({"lang": "h1", "source": "drop"})
    out = line_dedup.drop_lines(df, batches=2)
    assert out.columns == df.columns
    got = rows(out)
    for i, _, _, _, text in brute(list(enumerate(texts))):
        assert (got[i]["text"] or "") == text and got[i]["n_chars"] == len(text) and got[i]["h1"] == "en"
        assert (got[i]["text"] is None) == (texts[i] is None)


def test_repeated_rows_and_null_ids(spark):
    line = "the same long line of text in all of these documents"
    data = [(1, line, "", "", 0)] * 6 + [(None, line, "", "", 0)]
    got = line_dedup.line_counts(spark.createDataFrame(data, SCHEMA)).collect()
    assert sum(r.n_dropped for r in got) == 0  # two documents only
    data += [(i, line, "", "", 0) for i in range(2, 6)] + [(5, line, "", "", 0)]
    got = line_dedup.line_counts(spark.createDataFrame(data, SCHEMA)).collect()
    assert {r.doc_id for r in got if not r.n_dropped} == {5}
    assert sum(r.n_dropped for r in got) == 10


def test_empty_and_incremental_runs(spark):
    assert line_dedup.line_counts(frame(spark, [])).count() == 0
    runs = line_dedup.LineRuns(spark, fanout=2)
    for b in range(5):
        runs.add(spark.createDataFrame([(b, 1, 1), (b, 2, b)], "doc_id long, h1 long, h2 long"))
    assert max(map(len, runs.levels)) < 2
    assert runs._all(runs.repeats).count() == 4
    got = {(r.h1, r.h2): (r.n_docs, r.max_doc) for r in runs.common(1).collect()}
    assert got == {(1, 1): (5, 4)} | {(2, b): (1, b) for b in range(5)}
    # the anti-join lets each hash into one run only; what it turns away is counted from the repeats
    assert runs._all(runs.runs()).count() == 6 and runs._all(runs.repeats).count() == 1
    assert [(r.h1, r.n_docs) for r in runs.common(2).collect()] == [(1, 5)]


def test_runs_meet_without_a_shuffle(spark, capsys):
    runs = line_dedup.LineRuns(spark)
    for b in range(2):
        runs.add(spark.createDataFrame([(b, k, k) for k in range(50 * b, 50 * b + 80)], "doc_id long, h1 long, h2 long"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one, two = (spark.table(x) for x in runs.runs())
        one.join(two.hint("merge"), ["h1", "h2"], "left_anti").explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in capsys.readouterr().out
    assert {r.n_docs for r in runs.common(2).collect()} == {2} and runs.common(2).count() == 30


def test_heavy_keys_are_split_and_nothing_is_lost(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tracemill.llm import shared

    monkeypatch.setattr(shared, "LIGHT", 5)
    monkeypatch.setattr(shared, "HEAVY", 4)
    left = spark.createDataFrame([(0 if i < 300 else i % 40, i) for i in range(600)], "k int, v int")
    right = left.groupBy(F.col("k").alias("_k")).agg(F.count("*").alias("n"), F.max("v").alias("top")).filter("_k % 3 = 0")
    want = sorted(r.v for r in left.collect() if r.k % 3 == 0)
    for how in ("inner", "left_semi"):
        got = shared.spread_join(left, right, ["k"], ["_k"], "n", how)
        assert sorted(r.v for r in got.collect()) == want and "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
    got = shared.spread_join(left, right, ["k"], ["_k"], "n", "left_anti")
    assert sorted(r.v for r in got.collect()) == sorted(set(range(600)) - set(want))


def test_long_runs_of_blanks_and_a_hot_line(spark):
    line = " " * 40 + "the line that a third of all documents holds, in any case" + "\t" * 70
    texts = [line if i % 3 == 0 else f"{i} own text\n" + " " * 50 for i in range(90)] + [("word " * 9 + "\n") * 60_000 + line]
    got = sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.line_counts(frame(spark, texts)).collect())
    assert got == [w[:4] for w in brute(list(enumerate(texts)))]
