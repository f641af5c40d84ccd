import hashlib
import math
import subprocess
import sys

import numpy as np
import pytest

from tracemill.llm import pieces

from .common import SCHEMA, awkward, frame, prose, rows, seeded


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def sample():
    rng = seeded(13)
    texts = awkward() + [prose(rng, 60), "  two  spaces\n\n\tand   tabs ", "ﬁ ½ 漢字かな 한국어 \x00\x7f", "a▁b", "x" * 200 + "tion" * 40, "1234567 3.14 foo.bar(baz)[0]", "internationalization" * 3, "a" * 59, "d" * 60, "b" * 62, "c" * 63]
    letters = "aeiou rstln  thing tion 09.,;()'\"\n▁éü"
    return texts + ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(120)]


def test_ids_equal_the_library(spark, library):
    texts = sample()
    df = frame(spark, texts).withColumnsRenamed({"lang": "h", "source": "ids"})
    for head in (pieces.HEAD, 20):
        got = rows(pieces.encode(df, head=head))
        for i, t in enumerate(texts):
            assert got[i]["ids"] == library.encode(t or ""), repr(t)[:80]
    text = rows(pieces.decode(pieces.encode(df)))
    assert all(text[i]["text"] == (t or "").replace("▁", " ") for i, t in enumerate(texts))


def test_unigram_is_viterbi(spark):
    rng = seeded(14)
    known = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.1, "aba": -4.0, "▁a": -2.2, "ba": -3.9, "bb": -6.0}
    model = pieces.Model([(p, i, s) for i, (p, s) in enumerate(known.items())], [], 99, pieces.UNIGRAM, True, [p.replace("▁", " ").encode() for p in known])

    def best(u):
        score = [0.0] + [-math.inf] * len(u)
        for e in range(1, len(u) + 1):
            for s in range(e):
                x = known.get(u[s:e], min(known.values()) - 10 if e - s == 1 else -math.inf)
                score[e] = max(score[e], score[s] + x)
        return score[-1]

    texts = ["".join(rng.choice("ab c") for _ in range(rng.randrange(1, 14))) for _ in range(60)]
    got = rows(pieces.encode(frame(spark, texts), model))
    names = list(known)
    for i, t in enumerate(texts):
        parts = [known[names[k]] if k < 99 else min(known.values()) - 10 for k in got[i]["ids"]]
        assert math.isclose(sum(parts), best("▁" + t.replace(" ", "▁")))


def test_unigram_over_a_whole_vocabulary_is_viterbi(spark):
    """The vocabulary's pieces with scores of their own, as a unigram model: each text's path has the best score."""
    bpe = pieces.Model.load()
    scored = [(p, i, -1.0 - (i % 97) / 13 - len(p) / 7) for p, i, _ in bpe.pieces]
    model = pieces.Model(scored, bpe.bytes_, bpe.unknown, pieces.UNIGRAM, True, bpe.texts)
    by_id = {i: s for _, i, s in scored}
    score, worst = {p: s for p, _, s in scored}, min(s for _, _, s in scored) - 10
    rng = seeded(17)
    texts = [prose(rng, 12) for _ in range(20)] + ["International ation, the of\n\n  and 12.5 été 漢"]
    got = rows(pieces.encode(frame(spark, texts), model))
    for i, t in enumerate(texts):
        u = ("▁" + t.replace(" ", "▁")) if t else ""
        best = [(0.0, ())] + [(-math.inf, ())] * len(u)
        for e in range(1, len(u) + 1):
            for s in range(max(0, e - bpe.longest), e):
                x = score.get(u[s:e], worst if e - s == 1 else -math.inf)
                if best[s][0] + x > best[e][0]:
                    best[e] = (best[s][0] + x, s)
        total, k = 0.0, 0
        for x in got[i]["ids"]:  # byte pieces of one character count once
            if x in bpe.bytes_:
                k += 1
                continue
            total += by_id[x]
        missing = [c for c in u if c not in score]
        assert k == sum(len(c.encode()) for c in missing) and math.isclose(total + worst * len(missing), best[-1][0], rel_tol=1e-9), t


def test_odd_rows(spark, library):
    assert pieces.encode(frame(spark, [])).count() == 0
    df = spark.createDataFrame([(None, "x y", "", "", 0), (1, "x y", "", "", 0), (1, "x y", "", "", 0), (1, "z", "", "", 0)], SCHEMA)
    got = sorted((r.doc_id or -1, r.n_tokens) for r in pieces.digests(df, head=1).collect())
    assert got == [(-1, 2), (1, 1), (1, 2), (1, 2)]
    ids = np.array(library.encode(" a"))
    assert pieces.Speller(pieces.Model.load()).texts(ids, np.array([0, len(ids), len(ids)])) == [b" a", b""]


def test_digests_equal_the_library(spark, library):
    texts = sample() + ["long text " * 300_000]  # more than one slice
    got = rows(pieces.digests(frame(spark, texts), head=50))
    for i, t in enumerate(texts):
        ids = library.encode(t or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()
        assert got[i]["text_sha256"] == hashlib.sha256((t or "").replace("▁", " ").encode()).hexdigest()


KEPT = r"""
import re
import types

import numpy as np
import pyarrow as pa
from tracemill.llm import pieces


def mb():
    return int(re.search(r"\nPss_Anon:\s+(\d+)", open("/proc/self/smaps_rollup").read())[1]) // 1024


def batches():
    rng = np.random.default_rng(5)
    for _ in range(2):
        letters = rng.choice(np.frombuffer(b"aeioulnrst ", np.uint8), (6000, 2000))
        yield pa.record_batch({"text": [row.tobytes().decode() for row in letters]})


def passed_to_spark(run, schema):
    given.append(run)
    raise InterruptedError


given = []
docs = types.SimpleNamespace(sparkSession=types.SimpleNamespace(conf={"spark.sql.shuffle.partitions": "1"}), mapInArrow=passed_to_spark)
docs.select = lambda *columns: docs
try:
    pieces.distinct_units(docs, pieces.Model.load())
except InterruptedError:
    pass
before = mb()
assert sum(b.num_rows for b in given[0](batches())) > 10**5
print(mb() - before)
"""


def test_a_worker_gives_its_memory_back():
    """What a process that has counted units keeps, in MB: it stands beside the executor's JVM while that encodes them."""
    done = subprocess.run([sys.executable, "-c", KEPT], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 50
