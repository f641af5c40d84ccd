import hashlib

import numpy as np
import pyarrow as pa

from tracemill.llm import substring
from tracemill.llm.fm_index import FMIndex

from .common import SCHEMA, awkward, frame, prose, rows, seeded, words


def test_fm_index_counts():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 4, 500)
    text[-1] = 0
    index = FMIndex(text, np.arange(len(text)))
    for length in (1, 2, 5, 8):
        patterns = rng.integers(1, 4, (60, length))
        found, low, high = index.match([patterns[:, k] for k in range(length)])
        for p, f, a, b in zip(patterns, found, low, high, strict=True):
            tail = p[length - f :]
            at = [i for i in range(len(text) - len(tail) + 1) if (text[i : i + len(tail)] == tail).all()]
            assert f == 0 or (sorted(index.labels[a:b]) == at and index.least(np.array([a]), np.array([b]))[0] == at[0])
            longer = p[length - f - 1 :]
            assert f == length or not any((text[i : i + f + 1] == longer).all() for i in range(len(text) - f))


def brute(docs, size=50):
    first = {}
    for i, t in docs:
        w = words(t)
        for k in range(len(w) - size + 1):
            g = tuple(w[k : k + size])
            first[g] = min(first.get(g, i), i)
    out = []
    for i, t in docs:
        w = words(t)
        gone = {k + j for k in range(len(w) - size + 1) if first[tuple(w[k : k + size])] < i for j in range(size)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def sample():
    rng = seeded(2)
    passages = [prose(rng, n) for n in (49, 50, 51, 80, 300)]
    texts = awkward() + [prose(rng, 400), "a b " * 60, "a b " * 40]
    for i in range(50):
        parts = [prose(rng, rng.randrange(0, 60)) for _ in range(3)]
        for _ in range(rng.randrange(0, 3)):
            parts.insert(rng.randrange(len(parts)), rng.choice(passages))
        texts.append(rng.choice([" ", "\n", "\t "]).join(parts))
        if i % 5 == 0:
            texts += [texts[-1]] * 2
        if i % 6 == 0:
            w = words(texts[-1])
            if w:
                w[len(w) // 2] = "edited"
            texts.append(" ".join(w))
    return texts


def test_matches_brute_force(spark):
    texts = sample()
    want = brute(list(enumerate(texts)))
    assert sum(w[2] > 0 for w in want) > 25
    for shard in (substring.SHARD, 3):
        got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring.window_digests(frame(spark, texts), shard).collect())
        assert got == want


def test_odd_rows(spark):
    assert substring.window_digests(frame(spark, [])).count() == 0
    text = prose(seeded(4), 90)
    data = [(None, text, "", "", 0), (3, text, "", "", 0), (3, text, "", "", 0), (3, text + " more", "", "", 0)]
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in substring.window_dedup(spark.createDataFrame(data, SCHEMA)).collect())
    assert got == [(-1, 90, 90), (3, 90, 0), (3, 90, 0), (3, 91, 0)]
    assert rows(substring.window_dedup(frame(spark, ["A\x0b b\n c"])))[0]["kept_text"] == "A b c"


def test_what_goes_between_shards_grows_with_shards_not_with_contexts(spark, monkeypatch):
    rng = seeded(6)
    passage = prose(rng, 80)
    texts = [prose(rng, 60) + " " + passage + " " + prose(rng, 60) for _ in range(120)]
    texts += [" ".join(words(t)[30:170]) for t in texts[:20]] + texts[20:30]
    made = {}
    stored = substring.shared.stored

    def counted(df, name, *by):
        out = stored(df, name, *by)
        made[name] = out.count()
        return out

    monkeypatch.setattr(substring.shared, "stored", counted)
    shard = 20
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring.window_digests(frame(spark, texts), shard).collect())
    assert got == brute(list(enumerate(texts)))
    # windows of the passage are in all shards of its anchors, the others at most in two
    windows, contexts = 31, made["contexts-parts"]
    assert contexts > 5 * shard
    assert 0 < made["contexts-between"] < windows * contexts / 4


def test_contexts_of_hot_anchors_are_not_made_into_windows(spark, monkeypatch):
    rng = seeded(7)
    passage, copied = prose(rng, 80), words(prose(rng, 150))
    texts = [prose(rng, rng.randrange(0, 60)) + " " + passage + " " + prose(rng, rng.randrange(0, 60)) for _ in range(60)]
    for _ in range(100):  # near copies, at their edges too
        w = list(copied)
        for _ in range(3):
            w[rng.randrange(len(w))] = prose(rng, 1)
        texts.append(" ".join(w[rng.randrange(0, 30) : len(w) - rng.randrange(0, 30)]))
    rng.shuffle(texts)
    made = {}
    stored = substring.shared.stored

    def counted(df, name, *by):
        out = stored(df, name, *by)
        made.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(substring.shared, "stored", counted)
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring.window_digests(frame(spark, texts), 10).collect())
    assert got == brute(list(enumerate(texts)))
    (contexts,) = made["contexts-parts"]
    assert contexts > 200 and len(made["halves"]) > 2
    assert max(n for name, each in made.items() if name.startswith(("contexts-", "halves")) for n in each) < 4 * contexts


def test_keys_are_never_cut(spark):
    rows = spark.createDataFrame([(k, i) for k in range(40) for i in range(1 + 7 * (k % 5))], "k long, c long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        def sizes(t):
            k = t.column("k").to_pylist()
            yield pa.RecordBatch.from_pylist([{"k": x, "n": k.count(x), "rows": len(k), "keys": len(set(k))} for x in sorted(set(k))])

        got = substring._by_shard(rows, 20, sizes, "k long, n long, rows long, keys long").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.k, r.n) for r in got) == [(k, 1 + 7 * (k % 5)) for k in range(40)]
    assert any(r.keys > 1 for r in got)
