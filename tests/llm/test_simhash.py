import numpy as np
import pyarrow as pa
import xxhash

from tracemill.llm import simhash
from tracemill.llm.tokens import texts_of

from .common import SCHEMA, awkward, frame, prose, rows, seeded, words


def fingerprint(text, n=3):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    s = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute(items, radius=3):
    root = {i: i for i, _ in items}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in items:
        for j, b in items:
            if i < j and (a ^ b).bit_count() <= radius:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i, _ in items}


def texts():
    rng = seeded(11)
    base = [prose(rng, n) for n in (3, 8, 40, 150, 400)]
    out = awkward() + base + [b.upper() for b in base] + base[:2]
    for b in base[3:]:
        w = b.split(" ")
        for _ in range(12):
            v = list(w)
            v[rng.randrange(len(v))] = "changed"
            out.append(" ".join(v))
    return out + [prose(rng, 30) for _ in range(30)] + ["one two", "Two three", "a " * 700, "z" * 100 + " b c"]


def test_xxh64():
    data = [bytes(range(256))[:n] * k for n in range(0, 70) for k in (1, 3)]
    t = texts_of(pa.array([d.decode("latin-1") for d in data]))
    want = [xxhash.xxh64_intdigest(d.decode("latin-1").encode(), 42) for d in data]
    assert simhash.xxh64(t.buf, t.off[:-1], np.diff(t.off)).tolist() == want


def test_classes_match_brute_force(spark):
    data = texts()
    want_fp = {i: fingerprint(t) for i, t in enumerate(data)}
    want = brute(list(want_fp.items()))
    got = rows(simhash.classes(frame(spark, data)))
    assert {i: r["fp"] & (1 << 64) - 1 for i, r in got.items()} == want_fp
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert len(set(want.values())) < len(want) - 15


def test_hot_buckets_are_refined(spark):
    rng = seeded(5)
    base = rng.getrandbits(64)
    fps = {base ^ sum(1 << b for b in set(rng.sample(range(64), 4)) if rng.random() < 0.4) for _ in range(120)}
    fps |= {rng.getrandbits(64) for _ in range(30)}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = brute([(x, x & (1 << 64) - 1) for x in sorted(signed)])
    for bucket in (30, simhash.BUCKET):
        tree = {r.node: r.root for r in simhash.components(simhash.links(df, bucket=bucket)).collect()}
        assert {x: tree.get(x, x) for x in signed} == want


def test_keep_one(spark):
    data = texts()
    df = frame(spark, data).withColumnsRenamed({"lang": "fp", "source": "component_id"})
    out = simhash.keep_one(df)
    want = brute([(i, fingerprint(t)) for i, t in enumerate(data)])
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == set(want.values())


def test_odd_rows(spark):
    assert simhash.classes(frame(spark, [])).count() == 0
    data = [(None, "same text here", "", "", 0), (4, "same text here", "", "", 0), (4, "same text here", "", "", 0), (9, "Same text HERE", "", "", 0)]
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash.classes(spark.createDataFrame(data, SCHEMA)).collect())
    assert got == [(-1, 4), (4, 4), (4, 4), (9, 4)]


def test_few_links_are_settled_by_one_task(spark, monkeypatch):
    rng = seeded(9)
    pairs = [(rng.randrange(-600, 600), rng.randrange(-600, 600)) for _ in range(700)] + [(-2000 - i, -2001 - i) for i in range(150)] + [(-(1 << 63), (1 << 63) - 1)]
    df = spark.createDataFrame(pairs, "a long, b long")
    top = {x: x for p in pairs for x in p}
    for _ in top:
        was = dict(top)
        for a, b in pairs:
            top[a] = top[b] = min(top[a], top[b])
        if top == was:
            break
    want = {x: y for x, y in top.items() if x != y}
    made = []
    stored = simhash.shared.stored
    monkeypatch.setattr(simhash.shared, "stored", lambda df, name, *by: made.append(name) or stored(df, name, *by))
    assert {r.node: r.root for r in simhash.components(df).collect()} == want
    assert made == ["star", "rooted"]
    made.clear()
    for few in (0, 800):  # by rounds alone, and rounds first
        assert {r.node: r.root for r in simhash.components(df, few=few).collect()} == want
    assert made.count("star") > 4
    assert simhash.components(df.limit(0)).count() == 0
