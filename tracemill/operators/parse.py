"""From texts to raw events to the typed wide table, in native expressions."""

from __future__ import annotations

from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..schema import ALWAYS_TEXT, FIRST_OF, HOT, IN_COLUMNS, PROPERTIES, TYPED
from ..sources.grammar import HEADER, MASK, PROPERTY
from .fingerprint import fingerprint


def split_events(files: DataFrame, content: str = "content") -> DataFrame:
    """A row for each event of each text: all columns but the text, ``position`` and ``body``; what precedes the first mask is dropped."""
    text = F.regexp_replace(F.col(content), "^\\x{FEFF}", "")
    rest = [c for c in files.columns if c != content]
    parts = files.select(*rest, F.posexplode(F.split(text, f"(?m)(?=^{MASK})")).alias("position", "body"))
    return parts.filter(F.col("body").rlike(f"\\A{MASK}"))


def properties(text: Column) -> Column:
    """The properties of an event's rest: an array, because names may repeat."""
    found = F.regexp_extract_all(text, F.lit(PROPERTY), F.lit(0))

    def one(m: Column) -> Column:
        name = F.substring_index(m, "=", 1)
        rest = F.substring(m, F.length(name) + 2, F.length(m))
        quote = F.substring(rest, 1, 1)
        plain = F.when(rest.endswith(","), F.substring(rest, F.lit(1), F.length(rest) - 1)).otherwise(rest)
        # only quoted values, which are few, are matched again for their inside
        single = F.replace(F.regexp_extract(m, PROPERTY, 2), F.lit("''"), F.lit("'"))
        double = F.replace(F.regexp_extract(m, PROPERTY, 3), F.lit('""'), F.lit('"'))
        value = F.when(quote == "'", single).when(quote == '"', double).otherwise(plain)
        return F.struct(name.alias("name"), value.alias("value"), quote.isin("'", '"').alias("quoted"))

    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast(PROPERTIES)).otherwise(F.transform(found, one).cast(PROPERTIES))


def once(**columns: Column) -> Column:
    """Columns that are computed once a row, however often later filters and projections use them.

    A generator of one row stands between: Catalyst neither pushes predicates on these columns
    below it nor copies their expressions into each use.
    """
    return F.inline(F.array(F.struct(*[x.alias(c) for c, x in columns.items()])))


def parse_events(events: DataFrame, body: str = "body") -> DataFrame:
    """Adds time, duration, event, level, parse_error and props; the body is dropped.

    The header is cut first and properties in a step of their own, so that filters on time, duration, event or level reach below them.
    """
    rest = [c for c in events.columns if c != body]
    # one pass cuts the header into its parts: null where it is no header
    step = events.select(*rest, once(_text=F.rtrim(F.col(body), F.lit("\r\n"))))
    head = F.split("_text", ",", 4)
    first = F.substring_index(head[0], "-", 1)
    good = (F.size(head) >= 3) & F.contains(head[0], F.lit("-"))
    step = step.select(*rest, "_text", once(_head=head, _first=first, _good=good))
    own = lambda x: F.when(F.col("_good"), x).otherwise(F.lit(""))
    duration = F.substring(F.get("_head", F.lit(0)), F.length("_first") + 2, F.length("_text"))
    names = [*rest, "time", "duration", "event", "level", "parse_error"]
    step = step.select(*rest, "_text", once(
        time=own(F.col("_first")), duration=own(S.canonical_duration(duration)), event=own(F.get("_head", F.lit(1))), level=own(F.get("_head", F.lit(2))),
        parse_error=~F.col("_good"), _rest=own(F.coalesce(F.get("_head", F.lit(3)), F.lit(""))),
    ))
    return step.select(*names, properties(F.col("_rest")).alias("props"))  # a plain column, so that it goes where nobody reads it


def read_texts(files: DataFrame) -> DataFrame:
    """Raw events of (file_path, content): the columns of schema.RAW but offsets.  Rejected headers are left out."""
    name = F.element_at(F.split(F.col("file_path"), r"[/\\]"), -1)
    raw = parse_events(split_events(files)).filter(~F.col("parse_error")).withColumn("filename", name)
    stamp = F.concat(S.date_prefix(F.col("filename")), F.col("time"))
    return raw.select("file_path", "filename", "position", stamp.alias("timestamp"), "duration", "event", "level", "props")


def first_wins(props: Column) -> Column:
    """map<string,string> with the first value of each name; ``props`` must be a column, not a long expression."""
    names = props["name"]
    distinct = F.array_distinct(names)
    return F.map_from_arrays(distinct, F.transform(distinct, lambda k: F.get(props, (F.array_position(names, k) - 1).cast("int"))["value"]))


def to_bench(raw: DataFrame) -> DataFrame:
    """The narrow table: rolling time, saturating duration, all properties in a map (last wins)."""
    step = raw.select(*[c for c in raw.columns if c != "props"], once(_last=F.reverse("props")))
    return step.select(
        S.rolling_event_time(F.col("timestamp")).alias("timestamp"), S.saturating_duration(F.col("duration")).alias("duration"),
        "event", "level", "filename", "file_path", first_wins(F.col("_last")).alias("props"),
    )


@lru_cache(maxsize=8)
def _wide(smart_context: bool, gateway: int) -> tuple[Column, ...]:
    """The columns of the wide table over a map ``_m``; made once for a JVM, as that takes thousands of calls to it."""
    get = lambda name: S.map_get(F.col("_m"), name)
    text = {c: get(p) for c, p in HOT.items()} | {c: S.first_nonempty(*map(get, names)) for c, names in FIRST_OF.items()}
    typed = {c: f for kind, f in (("u64", S.u64), ("u32", S.u32), ("u8", S.u8), ("i64", S.i64)) for c in TYPED[kind] for f in [f]}
    odd_session = lambda k, v: (k == "SessionID") & (S.u32(v) == 0) & ~v.isin("", "0")
    columns = {
        "ts": S.strict_event_time(F.col("timestamp")), "duration_us": S.u64(F.col("duration")), "event": F.col("event"), "level": F.col("level"),
        "collection": S.path_segment(S.relative_path(F.col("file_path"))), "src_file": F.col("filename"), "src_path": F.col("file_path"), "src_line": F.lit(0).cast("bigint"),
    } | {c: typed[c](x) if c in typed else x for c, x in text.items()}
    columns["lock_wait_conns"] = S.wait_connections(text["lock_wait_conns"])
    columns |= {
        "context_hash": S.text_hash(text["context"]), "context_line": S.context_line(text["context"], smart_context), "sql_hash": S.text_hash(text["sql_text"]),
        "props": F.map_filter("_m", lambda k, v: ~k.isin(*IN_COLUMNS) | odd_session(k, v)),
    }
    return tuple(x.alias(c) for c, x in columns.items())


def to_rich(raw: DataFrame, smart_context: bool = True, fingerprints: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """The wide table of 50 columns (and ``event_date`` to partition by); ``keep`` names columns of ``raw`` that stay."""
    step = raw.select(*[c for c in raw.columns if c != "props"], once(_m=first_wins(F.col("props"))))
    out = step.select(*_wide(smart_context, id(SparkContext._gateway)), *keep)
    out = with_fingerprint(out) if fingerprints else out
    return out.withColumn("event_date", F.to_date("ts"))


def with_fingerprint(rich: DataFrame, text: str = "sql_text") -> DataFrame:
    """Adds sql_norm, sql_norm_hash, param_count and sql_params; only non-empty texts are lexed."""
    out = rich.withColumn("_f", F.when(F.col(text) != "", fingerprint(F.col(text))))
    has = F.col("_f").isNotNull()
    return out.select(
        *rich.columns, F.coalesce("_f.norm", F.lit("")).alias("sql_norm"), F.when(has, F.xxhash64("_f.norm")).otherwise(F.lit(0)).cast("bigint").alias("sql_norm_hash"),
        F.least(F.when(has, F.size("_f.params")).otherwise(0), F.lit(65535)).cast("int").alias("param_count"), F.coalesce("_f.params", F.array().cast("array<string>")).alias("sql_params"),
    )


def is_json_number(prop: Column) -> Column:
    """Whether a property is written as a number."""
    return ~prop["quoted"] & ~prop["name"].isin(*ALWAYS_TEXT) & S.is_number(prop["value"])
