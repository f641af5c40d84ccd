import corpus_pipeline as C
from tracemill.llm import pieces, simhash

from .common import prose, seeded, words
from .test_decontaminate import brute as leaks
from .test_line_dedup import brute as lines
from .test_quality import brute as verdict
from .test_simhash import brute as groups
from .test_simhash import fingerprint

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sample():
    rng = seeded(21)
    items = [(1, prose(rng, 30, 4000)), (2, prose(rng, 25, 4000))]
    common = "a line that many of these documents have in common, of some length"
    texts = [None, "", "spam " * 200]
    for i in range(25):
        t = prose(rng, rng.randrange(60, 200), 4000)
        texts.append(f"{t}\n{common}" if i % 3 == 0 else t)
    texts += [texts[5], texts[5] + " end", f"{prose(rng, 60, 4000)} {items[0][1]} {prose(rng, 60, 4000)}"]
    return texts, items


def test_stages_match_brute_force(spark, tmp_path):
    import sentencepiece

    texts, items = sample()
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = {i: t for i, t in enumerate(texts) if verdict(t)["kept"]}
    docs = {i: text for i, _, _, _, text in lines(list(docs.items()))}
    classes = groups([(i, fingerprint(t)) for i, t in docs.items()])
    docs = {i: t for i, t in docs.items() if classes[i] == i}
    bad = leaks(list(docs.items()), items)
    docs = {i: t for i, t in docs.items() if not bad[i]}
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    got = {r.doc_id: r.ids for r in C.run(spark, str(tmp_path)).collect()}
    assert got == {i: library.encode(t) for i, t in docs.items()}
    assert 10 < len(got) < len(texts) - 5


def test_stages_keep_columns(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, prose(seeded(1), 90, 4000), "en", "s", 1)], SCHEMA)
    assert [n for n, _ in C.STAGES] and 4 <= len(C.STAGES) <= 5
    for _, stage in C.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    assert simhash.keep_one(docs).count() == 1 and words("a b") == ["a", "b"]


def test_empty_documents_repeated_rows_and_clashing_names(spark, tmp_path):
    spark.createDataFrame([(1, prose(seeded(2), 30, 4000))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0
    text = prose(seeded(3), 90, 4000).replace("é", "e")
    rows = [(1, text, "en", "s", 1)] * 3 + [(None, text, "en", "s", 1), (2, text.upper(), "en", "s", 1), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    names = ["_gone", "_d", "_k", "drop", "tid", "sid", "rest", "_row"]
    docs = docs.selectExpr("*", *[f"{i} AS {n}" for i, n in enumerate(names)])
    for _, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns[5:] == names
    assert sorted(r.doc_id or -1 for r in docs.collect()) == [-1, 1, 1, 1]
    assert {tuple(r[5:]) for r in docs.collect()} == {tuple(range(len(names)))}
