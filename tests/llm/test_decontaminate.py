import numpy as np

from tracemill.llm import decontaminate as d

from .common import SCHEMA, awkward, frame, rows, seeded, words

EDGE = """!"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"""


def tokens(t):
    return [x for w in words(t) if (x := "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w).strip(EDGE))]


def prose(rng, n):
    return " ".join(f"w{rng.randrange(400)}{rng.choice(['', '.', ','])}" for _ in range(n))


def run_of(same, spacing):
    best = 0
    for a in range(len(same)):
        for b in range(a + 1, len(same) + 1):
            bad = [k for k in range(a, b) if not same[k]]
            if same[b - 1] and all(y - x >= spacing for x, y in zip(bad, bad[1:], strict=False)):
                best = max(best, b - a)
    return best


def brute(docs, items, window=13, min_words=13, spacing=4):
    """Items that share a masked window with a document and overlap it there."""
    out = {}
    for i, t in docs:
        w, hit = tokens(t), set()
        for k, s in items:
            v = tokens(s)
            size = min(window, len(v))
            if size < d.MIN_ITEM:
                continue
            offsets = set()
            for a in range(len(w) - size + 1):
                for b in range(len(v) - size + 1):
                    bad = {k for k in range(size) if w[a + k] != v[b + k]}
                    if any(bad <= set(m) for m in d.IGNORED):
                        offsets.add(a - b)
            for o in offsets:
                lo, hi = max(0, o), min(len(w), o + len(v))
                if run_of([w[x] == v[x - o] for x in range(lo, hi)], spacing) >= min(min_words, len(v)):
                    hit.add(k)
        out[i] = sorted(hit)
    return out


def test_best_run():
    rng = np.random.default_rng(0)
    for _ in range(300):
        same = rng.random(rng.integers(0, 25)) < 0.75
        assert d.best_run(same, 4)[0] == run_of(same.tolist(), 4)


def sample():
    rng = seeded(12)
    items = [(k, prose(rng, n)) for k, n in enumerate([5, 12, 13, 25, 40])] + [(9, None), (10, "")]
    docs = [*awkward()]
    for i in range(40):
        w = words(items[rng.randrange(1, 5)][1])
        for k in range(i % 4):
            w[rng.randrange(len(w))] = f"new{k}"
        cut = w[: rng.randrange(8, len(w) + 1)] if i % 3 == 0 else w
        docs.append(f"{prose(rng, rng.randrange(30))} {' '.join(cut).title()} {prose(rng, rng.randrange(30))}")
    return docs, items


def test_matches_brute_force(spark):
    docs, items = sample()
    got: dict = {i: [] for i in range(len(docs))}
    bench = spark.createDataFrame(items, "item_id long, text string")
    for r in d.overlaps(frame(spark, docs), bench).collect():
        got[r.doc_id].append(r.item_id)
    want = brute(list(enumerate(docs)), items)
    assert {i: sorted(x) for i, x in got.items()} == want and sum(map(bool, want.values())) > 15
    df = frame(spark, docs).withColumnsRenamed({"lang": "tid", "source": "hits"})
    kept = d.drop_contaminated(df, bench)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, x in want.items() if not x}


def test_odd_rows(spark):
    bench = spark.createDataFrame([(1, prose(seeded(1), 30)), (2, prose(seeded(1), 30))], "item_id long, text string")
    text = prose(seeded(1), 30)
    df = spark.createDataFrame([(None, text, "", "", 0), (1, text, "", "", 0), (1, text, "", "", 0), (1, "other", "", "", 0)], SCHEMA)
    assert sorted((r.doc_id or -1, r.item_id) for r in d.overlaps(df, bench).collect()) == [(-1, 1), (-1, 2), (1, 1), (1, 1), (1, 2), (1, 2)]
    assert [r.text for r in d.drop_contaminated(df, bench).collect()] == ["other"]
    assert d.overlaps(frame(spark, []), bench).count() == 0 and d.overlaps(df, bench.limit(0)).count() == 0
    assert rows(d.drop_contaminated(frame(spark, ["a"]), bench.limit(0)))
