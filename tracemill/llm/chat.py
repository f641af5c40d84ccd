"""Chat formatting by schema fingerprints (operator 7), in DataFrame and SQL functions only.

Records come as JSON texts of any layout (or rows that are made into such).  Their
nested field paths are read off by ``schema_of_variant`` and hashed; the hash of them all is the
fingerprint of a layout.  A declarative mapping (field paths to turns) is selected where a record has the hashes of all its
paths, so layouts of any number are told apart row by row, and rows are converted into canonical turns
(role, text).  The template marks turns as ``<|im_start|>role\\ntext<|im_end|>\\n``.
Roles are percent-encoded; in texts a backslash is doubled and a control string is
broken by a backslash after its first character, so both are read back exactly.  The loss
mask is an array of (start, length) in code points: the texts of the assistant.

Defined cases: a null text or role is empty; a null conversation id is a conversation of its
own; turns with equal numbers are ordered by role and text, null numbers come first; rows that
repeat a turn are turns; a record whose layout no mapping knows, or that is no JSON, gives
no turns and is marked by a null ``layout``; an empty table gives an empty result; extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

START, END, ASSISTANT = "<|im_start|>", "<|im_end|>", "assistant"
#: Control strings of common chat templates that a text must not bring in; the first character is followed by a backslash.
CONTROL = r"(<|\[)(?=\|[A-Za-z_]+\|>|/?s>|/?INST\]|</?SYS>>)"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """A layout: the field paths that a record must have, the schema to read it by, and SQL that makes turns of the parsed record ``r``."""

    name: str
    paths: tuple[str, ...]
    schema: str
    turns: str


def _turn(role: str, text: str) -> str:
    return f"named_struct('role', {role}, 'text', {text})"


#: Tried in order: the first whose paths a layout has.
MAPPINGS = (
    Mapping("messages", ("messages[].role", "messages[].content"), "messages array<struct<role:string,content:string>>",
            f"transform(r.messages, x -> {_turn('x.role', 'x.content')})"),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), "conversations array<struct<`from`:string,value:string>>",
            f"transform(r.conversations, x -> {_turn('''CASE x.`from` WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE x.`from` END''', 'x.value')})"),
    Mapping("instruction", ("instruction", "output"), "system string, instruction string, input string, output string",
            f"concat(if(r.system IS NULL, array(), array({_turn(repr('system'), 'r.system')})), array({_turn(repr('user'), '''concat(r.instruction, if(coalesce(r.input, '') = '', '', concat('\\n\\n', r.input)))''')}, {_turn(repr('assistant'), 'r.output')}))"),
    Mapping("prompt", ("prompt", "completion"), "prompt string, completion string",
            f"array({_turn(repr('user'), 'r.prompt')}, {_turn(repr('assistant'), 'r.completion')})"),
    Mapping("context", ("instruction", "response"), "system string, instruction string, context string, response string",
            f"concat(if(r.system IS NULL, array(), array({_turn(repr('system'), 'r.system')})), array({_turn(repr('user'), """concat(r.instruction, if(coalesce(r.context, '') = '', '', concat('\\n\\n', r.context)))""")}, {_turn(repr('assistant'), 'r.response')}))"),
    Mapping("response", ("prompt", "response"), "system string, prompt string, response string",
            f"concat(if(r.system IS NULL, array(), array({_turn(repr('system'), 'r.system')})), array({_turn(repr('user'), 'r.prompt')}, {_turn(repr('assistant'), 'r.response')}))"),
    Mapping("preference", ("prompt", "chosen"), "prompt string, chosen string",
            f"array({_turn(repr('user'), 'r.prompt')}, {_turn(repr('assistant'), 'r.chosen')})"),
    Mapping("question", ("question", "answer"), "question string, answer string",
            f"array({_turn(repr('user'), 'r.question')}, {_turn(repr('assistant'), 'r.answer')})"),
    Mapping("input", ("input", "output"), "input string, output string",
            f"array({_turn(repr('user'), 'r.input')}, {_turn(repr('assistant'), 'r.output')})"),
)


#: Steps of a schema text such as OBJECT<a: ARRAY<OBJECT<`b c`: STRING>>>: a name, the start of an object or an array, an end.
_STEP = r"`(?:[^`]|``)*`: |[^\s<>,:`]+: |OBJECT<|ARRAY<|>"


def paths(record: Column) -> Column:
    """The nested field paths of a JSON text, array steps written []; null if it isn't JSON."""
    steps = F.regexp_extract_all(F.schema_of_variant(F.try_parse_json(record)), F.lit(_STEP), F.lit(0))
    texts = F.array().cast("array<string>")
    zero = F.struct(F.lit("").alias("at"), texts.alias("above"), texts.alias("found"))

    def walk(acc: Column, step: Column) -> Column:
        above, at = acc["above"], acc["at"]
        last = F.coalesce(F.get(above, F.size(above) - 1), F.lit(""))
        name = F.regexp_replace(step, "^`?|`?: $", "")
        path = F.when(last == "", name).otherwise(F.concat(last, F.lit("."), name))
        ends, begins = step == ">", step.isin("OBJECT<", "ARRAY<")
        return F.struct(
            F.when(ends, last).when(step == "ARRAY<", F.concat(at, F.lit("[]"))).when(begins, at).otherwise(path).alias("at"),
            F.when(ends, F.slice(above, F.lit(1), F.greatest(F.size(above) - 1, F.lit(0)))).when(begins, F.concat(above, F.array(at))).otherwise(above).alias("above"),
            F.when(ends | begins, acc["found"]).otherwise(F.concat(acc["found"], F.array(path))).alias("found"),
        )

    return F.when(steps.isNotNull(), F.aggregate(steps, zero, walk, lambda acc: F.array_sort(F.array_distinct(acc["found"]))))


def canonical(records: DataFrame, record: str = "record") -> DataFrame:
    """The records with ``layout``, ``layout_print`` (the hash of all field paths) and ``turns``; all other columns stay, those of these names as _layout and so on."""
    row = records.select(F.struct(*[records[c] for c in records.columns]).alias("_row"), records[record].cast("string").alias("_record"))
    row = row.withColumn("_paths", paths(F.col("_record")))
    row = row.withColumn("_hashes", F.transform("_paths", lambda x: F.xxhash64(x)))
    name = F.lit(None).cast("string")
    for m in reversed(MAPPINGS):
        wanted = F.array(*[F.xxhash64(F.lit(x)) for x in m.paths])
        name = F.when(F.forall(wanted, lambda h: F.array_contains("_hashes", h)), F.lit(m.name)).otherwise(name)
    row = row.withColumn("_layout", F.when(F.col("_hashes").isNotNull(), name))
    turns = F.lit(None).cast(TURNS)
    for m in MAPPINGS:
        mine = F.col("_layout") == m.name
        row = row.withColumn(f"_as_{m.name}", F.when(mine, F.from_json(F.col("_record"), m.schema)))
        turns = F.when(mine, F.expr(m.turns.replace("r.", f"_as_{m.name}.")).cast(TURNS)).otherwise(turns)
    clean = F.transform(F.coalesce(turns, F.array().cast(TURNS)), lambda x: F.struct(F.coalesce(x["role"], F.lit("")).alias("role"), F.coalesce(x["text"], F.lit("")).alias("text")))
    new = {"layout": F.col("_layout"), "layout_print": F.when(F.col("_paths").isNotNull(), F.xxhash64("_paths")), "turns": clean}
    return row.select(*_beside(records, new))


def _beside(df: DataFrame, new: dict[str, Column], row: str = "_row") -> list[Column]:
    """The columns of a frame that is held in a struct, and new ones; old columns of the same names get underscores in front."""
    own = [F.col(row).getField(c).alias(shared.unused("_" + c, df) if c.lower() in new else c) for c in df.columns]
    return [*own, *[x.alias(c) for c, x in new.items()]]


def layout_counts(records: DataFrame) -> DataFrame:
    """(layout, layout_print, n) of canonical records; a null layout counts the records that no mapping knows."""
    return records.groupBy("layout", "layout_print").agg(F.count("*").alias("n"))


def from_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, record): the rows of conversations (conv_id, turn, role, text) as JSON records of messages."""
    one = F.struct(F.col("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("content"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("m"))
    messages = F.transform("m", lambda x: F.struct(x["role"], x["content"]))
    return grouped.select("conv_id", F.to_json(F.struct(messages.alias("messages"))).alias("record"))


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, "$1\\\\")


def unescaped(text: Column) -> Column:
    """Each backslash is dropped; one that follows it is kept."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def formatted(turns: DataFrame) -> DataFrame:
    """The rows with ``formatted`` and ``loss`` (array of start and length in code points, from 0)."""
    parts = F.transform("turns", lambda x: F.struct(F.concat(F.lit(START), F.url_encode(x["role"]), F.lit("\n")).alias("head"), escaped(x["text"]).alias("body"), (x["role"] == ASSISTANT).alias("loss")))
    step = turns.select(F.struct(*[turns[c] for c in turns.columns]).alias("_row"), parts.alias("_parts"))
    text = F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit(END + "\n"))), "")
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("out"))

    def add(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["head"])
        size = F.length(p["body"])
        span = F.array(F.struct(start.alias("start"), size.alias("length")))
        return F.struct((start + size + len(END) + 1).alias("at"), F.when(p["loss"], F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    return step.select(*_beside(turns, {"formatted": text, "loss": F.aggregate("_parts", zero, add, lambda acc: acc["out"])}))


def read_back(formatted_text: Column) -> Column:
    """The turns of a formatted text: array<struct<role, text>>."""
    pieces = F.filter(F.split(formatted_text, r"<\|im_start\|>"), lambda x: x != "")
    cut = lambda x: F.instr(x, F.lit("\n"))
    role = lambda x: F.try_url_decode(F.substring(x, F.lit(1), cut(x) - 1))
    body = lambda x: F.substring(x, cut(x) + 1, F.length(x) - cut(x) - len(END) - 1)
    return F.transform(pieces, lambda x: F.struct(role(x).alias("role"), unescaped(body(x)).alias("text")))


def loss_text(formatted_text: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substring(formatted_text, s["start"] + 1, s["length"]))), "")
