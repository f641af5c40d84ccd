from tracemill.llm import near_copies, simhash

from .common import SCHEMA, awkward, frame, prose, rows, seeded, words


def shingles(text, n=5):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}


def brute(texts):
    """The class of each text, and the pairs that differ but are similar enough."""
    sets, root, near = [shingles(t) for t in texts], list(range(len(texts))), []
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 100 * len(a & b) >= 80 * len(a | b):
                near += [(j, i)] * (a != b)
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root, near


def changed(rng, text, n):
    w = text.split(" ")
    for i in rng.sample(range(len(w)), n):
        w[i] = f"changed{i}"
    return " ".join(w)


def sample():
    rng = seeded(31)
    base = [prose(rng, n, 4000) for n in (60, 100, 150, 200, 300) * 4]
    out = awkward() + base + ["one two", "One TWO", "one two three"]
    for b in base:
        n = len(b.split(" "))
        out += [changed(rng, b, k) for k in (1, n // 60 + 1, n // 45, n // 30, n // 8)]
    return out + [b.upper() for b in base[:3]]


def test_classes_match_brute_force(spark):
    data = sample()
    want, near = brute(data)
    got = {i: r["component_id"] for i, r in rows(near_copies.classes(frame(spark, data))).items()}
    assert got == dict(enumerate(want))
    by_bits = {i: r["component_id"] for i, r in rows(simhash.classes(frame(spark, data))).items()}
    assert len(near) > 50 and sum(by_bits[i] == by_bits[j] for i, j in near) < len(near) / 2


def test_similar_to_some_only(spark):
    """A chain: its ends are not similar, and its links must all be found."""
    rng = seeded(32)
    chain = [prose(rng, 200, 4000)]
    for k in range(12):
        chain.append(changed(rng, chain[-1], 3))
    want, _ = brute(chain)
    assert set(want) == {0}
    assert near_copies.keep_one(frame(spark, chain)).count() == 1


def test_blocks_leave_no_pair_out(spark, monkeypatch):
    data = sample() + [" ".join(f"v{i}" for i in range(40)) + f" w{k} " + " ".join(f"v{i}" for i in range(40 + k % 9)) for k in range(60)]
    want, _ = brute(data)
    tested = []
    real = near_copies._settled
    monkeypatch.setattr(near_copies, "_settled", lambda *a: tested.append(1) or real(*a))
    for block in (4, 512):
        monkeypatch.setattr(near_copies, "BLOCK", block)
        slim = near_copies._slim(frame(spark, data))
        facts = near_copies.shared.stored(near_copies._facts(slim, 5), "test")
        assert facts.count() == len(data)
        monkeypatch.setattr(near_copies.links, "__defaults__", (5, 80, 0))  # no rounds of centres: blocks must find all
        got = {i: r["component_id"] for i, r in rows(near_copies.classes(frame(spark, data))).items()}
        assert got == dict(enumerate(want))
    assert len(tested) == 2


def test_pipeline_stage_drops_near_copies(spark):
    import corpus_pipeline as C

    data = sample()
    want, _ = brute(data)
    df = frame(spark, data).withColumnsRenamed({"lang": "sid", "source": "component_id"})
    out = dict(C.STAGES)["simhash near-dedup"](spark, df, "")
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == set(want)


def test_odd_rows(spark):
    assert near_copies.classes(frame(spark, [])).count() == 0
    data = [(None, "same text here", "", "", 0), (4, "same text here", "", "", 0), (4, "same text here", "", "", 0), (9, "Same text HERE", "", "", 0)]
    df = spark.createDataFrame(data, SCHEMA)
    got = sorted((r.doc_id or -1, r.component_id) for r in near_copies.classes(df).collect())
    assert got == [(-1, 4), (4, 4), (4, 4), (9, 4)] and near_copies.keep_one(df).count() == 3
