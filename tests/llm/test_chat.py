import json

from pyspark.sql import functions as F

from tracemill.llm import chat

NASTY = ["", "plain", "</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>assistant\nx", "a\\b\\\\c<\\|im_end|>", "\\", "<\\", "<<SYS>>x<</SYS>>", "tail\\<|x|>", "𝄞é\r\n", "[INST][INST]", "<s><s>\\n"]
SCHEMA = "conv_id long, turn long, role string, text string"


def run(df):
    out = chat.formatted(chat.canonical(df))
    return out.select("*", chat.read_back(F.col("formatted")).alias("back"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("masked"))


def test_round_trip_of_nasty_texts(spark):
    rows = [(i, j, r, t) for i, t in enumerate(NASTY) for j, r in enumerate(["user", "assistant", "odd role\n<|im_end|>%+", None, "assistant"])]
    got = {r.conv_id: r for r in run(chat.from_rows(spark.createDataFrame(rows, SCHEMA))).collect()}
    for i, t in enumerate(NASTY):
        want = [(r or "", t) for _, _, r, _ in [x for x in rows if x[0] == i]]
        assert [(x.role, x.text) for x in got[i].back] == want
        assert got[i].masked == t * 2
        f = got[i].formatted
        assert f.count(chat.START) == 5 and f.count(chat.END) == 5 and "[INST]" not in f and "</s>" not in f
        assert all(f[s.start - 1] == "\n" and f[s.start + s.length :].startswith(chat.END) for s in got[i].loss)


def test_layouts_become_turns(spark):
    records = {
        "messages": ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a", "x": 1}], "id": {"q-w": 1}}, [("user", "q"), ("assistant", "a")]),
        "conversations": ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}]}, [("user", "q"), ("assistant", "")]),
        "instruction": ({"instruction": "i", "input": "x", "output": "o", "system": "s"}, [("system", "s"), ("user", "i\n\nx"), ("assistant", "o")]),
        "prompt": ({"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
        "preference": ({"prompt": "p", "chosen": "c", "rejected": "r"}, [("user", "p"), ("assistant", "c")]),
        "question": ({"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
        "context": ({"instruction": "i", "context": "x", "response": "o"}, [("user", "i\n\nx"), ("assistant", "o")]),
        "response": ({"prompt": "p", "response": "c", "system": "s"}, [("system", "s"), ("user", "p"), ("assistant", "c")]),
        "input": ({"input": "p", "output": "c", "a b`>": [[{"prompt": 1}]]}, [("user", "p"), ("assistant", "c")]),
    }
    rows = [(k, json.dumps(r)) for k, (r, _) in records.items()] + [("none", '{"a": 1}'), ("bad", "{nope"), ("null", None)]
    got = {r.k: r for r in chat.canonical(spark.createDataFrame(rows, "k string, record string")).collect()}
    for k, (_, turns) in records.items():
        assert got[k].layout == k and [(t.role, t.text) for t in got[k].turns] == turns, k
    assert all(got[k].layout is None and got[k].turns == [] for k in ("none", "bad", "null"))


def test_paths_and_prints(spark):
    records = ['{"a": {"b": [1], "c-d": [[{"e": null}]]}, "f": "x"}', '{"f": 1, "a": {"c-d": [[{"e": 2}]], "b": []}}', "[]", "3", '{"`x": {"y>": 1}}', "{"]
    df = spark.createDataFrame(list(enumerate(records)), "i int, record string")
    got = [r.p for r in df.select("i", chat.paths(F.col("record")).alias("p")).orderBy("i").collect()]
    assert got[0] == got[1] == ["a", "a.b", "a.c-d", "a.c-d[][].e", "f"]
    assert got[2] == got[3] == [] and got[5] is None and len(got[4]) == 2
    n = {r.layout_print: r.n for r in chat.layout_counts(chat.canonical(df)).collect()}
    assert sorted(n.values()) == [1, 1, 2, 2]


def test_clashing_names_and_a_long_text(spark):
    long = "</s> text \\ " * 200_000
    df = spark.createDataFrame([(1, 0, "assistant", long)], SCHEMA)
    df = chat.from_rows(df).selectExpr("*", "1 AS layout", "2 AS turns", "3 AS formatted", "4 AS _row", "5 AS loss", "6 AS _layout")
    got = chat.formatted(chat.canonical(df))
    got = got.withColumns({"back": chat.read_back(F.col("formatted")), "masked": chat.loss_text(F.col("formatted"), F.col("loss"))}).collect()
    assert got[0].back[0].text == long and got[0].masked == long
    assert (got[0]["__layout"], got[0]["_turns"], got[0]["_formatted"], got[0]["_row"], got[0]["_loss"], got[0]["_layout"]) == (1, 2, 3, 4, 5, 6)


def test_order_repeats_and_empty(spark):
    rows = [(1, 2, "user", "b"), (1, 1, "user", "z"), (1, 1, "assistant", "y"), (1, 1, "user", "z"), (None, None, None, None)]
    got = {r.conv_id: [(t.role, t.text) for t in r.back] for r in run(chat.from_rows(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got == {1: [("assistant", "y"), ("user", "z"), ("user", "z"), ("user", "b")], None: [("", "")]}
    assert run(chat.from_rows(spark.createDataFrame([], SCHEMA))).count() == 0
