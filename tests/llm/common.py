"""Small documents with every awkward case, and helpers."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" + rng.choice(["", "", "", ".", "é"]) for _ in range(n))


def awkward():
    return [None, "", " ", "\n", "a", "\n\n x \n", "ä b 𝄞\tc\x0bd\x0ce\r\nf", "x" * 5000, "spam " * 3000]


def frame(spark, texts, first=0):
    rows = [(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def seeded(k=7):
    return random.Random(k)


def rows(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}
