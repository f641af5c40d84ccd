import zstandard

from tracemill.llm import quality

from .common import SCHEMA, awkward, frame, prose, rows, seeded, words


def brute(text, rules=quality.Rules()):
    text = text or ""
    w = words(text)
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    hit = {i + k for i, g in enumerate(tri) if tri.count(g) > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    raw, z = text.encode(), zstandard.ZstdCompressor(level=3)
    ratio = len(z.compress(raw)) / len(raw) if raw else 0
    low, high = next((a, b) for most, a, b in rules.bands if len(raw) <= most)
    starts = [*range(0, len(raw) - 1023, 1024), *([len(raw) - 1024] if len(raw) > 1024 and len(raw) % 1024 else [])]
    chunks = [len(z.compress(raw[k : k + 1024])) / 1024 for k in starts]
    out = sum(not 0.35 <= c <= 0.75 for c in chunks)
    good = low <= ratio <= high and out <= 0.3 * len(chunks)
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": dup,
            "n_repeat_words": len(hit), "base_failed": failed, "kept": not failed and good, "ratio": ratio, "n_chunks": len(chunks), "n_chunks_out": out}


def texts():
    rng = seeded()
    out = [t for t in awkward() if t is None or len(t) < 6000]
    out += [prose(rng, n) for n in (10, 49, 50, 51, 120, 400)]
    out += [(prose(rng, 30) + "\n") * 3, "a b c a b c\n" * 30, "| x |\n<a> #b $c\n" * 20, prose(rng, 60) + "\n" + prose(rng, 60)]
    return out


def test_counts_and_verdicts_match_brute_force(spark):
    data = texts()
    got = rows(quality.judge(frame(spark, data)))
    for i, t in enumerate(data):
        want = brute(t)
        assert {k: got[i][k] for k in want} == want, (i, t and t[:40])


def test_keep_good_carries_columns(spark):
    df = frame(spark, texts()).withColumnsRenamed({"lang": "kept", "source": "ratio"})
    kept = quality.keep_good(df)
    assert kept.schema == df.schema
    verdict = {r.doc_id for r in quality.judge(df).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == verdict and verdict


def test_noise_in_part_of_a_text_and_in_its_tail(spark):
    import base64
    import random

    rng = random.Random(4)
    base = natural()[0]
    noise = lambda n: base64.b64encode(rng.randbytes(n)).decode()[:n]
    texts = [base[:12_000] + " " + noise(8000), base[:1100] + " " + noise(900), base[:20_000], base[:3000]]
    got = rows(quality.judge(frame(spark, texts)))
    assert [got[i]["kept"] for i in range(4)] == [False, False, True, True]
    assert got[1]["n_chunks"] == 2 and got[1]["n_chunks_out"] == 1


def test_repeated_rows_and_null_ids(spark):
    text = natural()[0][:3000]
    df = spark.createDataFrame([(None, text, "", "", 0), (1, text, "", "", 0), (1, text, "", "", 0), (1, None, "", "", 0)], SCHEMA)
    got = [(r.doc_id, r.kept) for r in quality.judge(df).collect()]
    assert sorted(got, key=str) == sorted([(None, True), (1, True), (1, True), (1, False)], key=str)
    assert quality.keep_good(df).count() == 3


def test_empty_table(spark):
    assert quality.judge(frame(spark, [])).count() == 0
    assert quality.keep_good(frame(spark, [])).count() == 0


def natural():
    """Real prose of several lengths: Python's own documentation."""
    from pydoc_data.topics import topics

    out = [topics[k] for k in ("execmodel", "debugger", "formatstrings", "datamodel", "specialnames", "import", "objects", "imaginary") if k in topics]
    return out + [out[0][:n] for n in (600, 1200, 2500, 5000, 10_000)]


def test_natural_prose_is_within_the_bands(spark):
    got = rows(quality.judge(frame(spark, natural())))
    assert len(got) > 10
    old = ((300, 0.45), (600, 0.50), (1200, 0.47), (2500, 0.445), (5000, 0.42), (10_000, 0.405), (20_000, 0.392), (50_000, 0.385), (1 << 62, 0.30))
    failed = 0
    for i, t in enumerate(natural()):
        r, size = got[i], len(t.encode())
        assert r["ratio"] >= next(low for most, low, _ in quality.BANDS if size <= most), (i, size, r["ratio"])
        assert r["base_failed"] or r["kept"], (i, size, r)
        failed += r["kept"] and r["ratio"] < next(low for most, low in old if size <= most)
    assert failed > 2


def test_planted_repetition_is_below_the_bands(spark):
    base = natural()[0]
    texts = [(base[: n // 2] + " " + base[100:220] * n)[:n] for n in (600, 1200, 2500, 5000, 10_000, 20_000)]
    got = rows(quality.judge(frame(spark, texts)))
    assert all(got[i]["ratio"] < next(low for most, low, _ in quality.BANDS if len(t.encode()) <= most) and not got[i]["kept"] for i, t in enumerate(texts))
