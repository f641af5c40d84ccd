"""Column helpers with the conversion rules of the trace tables; all are native expressions.

Missing is the type's zero value: '' or 0, never null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

U64_MAX, I64_MAX = (1 << 64) - 1, (1 << 63) - 1


def _whole_number(x: Column, pattern: str, low: int, high: int) -> Column:
    """A number of digits only, within bounds; anything else is 0.  Leading zeros don't count towards the 38 digits of a decimal."""
    bare = F.regexp_replace(x, r"^([+-]?)0+(?=[0-9])", "$1")
    value = F.when(x.rlike(pattern) & (F.length(bare) <= 38), bare.try_cast("decimal(38,0)"))
    whole = lambda n: F.lit(str(n)).cast("decimal(38,0)")
    return F.coalesce(F.when(value.between(whole(low), whole(high)), value), whole(0))


def u64(x: Column, exact: bool = False) -> Column:
    """Unsigned 64 bits; as a bigint values above 2**63 - 1 are clamped, ``exact`` gives decimal(20,0)."""
    value = _whole_number(x, r"\A\+?[0-9]+\z", 0, U64_MAX)
    return value.cast("decimal(20,0)") if exact else F.least(value, F.lit(I64_MAX).cast("decimal(38,0)")).cast("bigint")


def u32(x: Column) -> Column:
    return _whole_number(x, r"\A\+?[0-9]+\z", 0, (1 << 32) - 1).cast("bigint")


def u8(x: Column) -> Column:
    return _whole_number(x, r"\A\+?[0-9]+\z", 0, 255).cast("int")


def i64(x: Column) -> Column:
    return _whole_number(x, r"\A[+-]?[0-9]+\z", -(1 << 63), I64_MAX).cast("bigint")


def saturating_duration(x: Column) -> Column:
    """Digits as decimal(20,0); more than 64 bits hold is the largest value, anything but digits 0."""
    bare = F.regexp_replace(x, r"^0+(?=[0-9])", "")
    big = F.lit(str(U64_MAX)).cast("decimal(38,0)")
    value = F.when(F.length(bare) > 20, big).otherwise(F.least(bare.try_cast("decimal(38,0)"), big))
    return F.when(x.rlike(r"\A[0-9]+\z"), value).otherwise(F.lit(0)).cast("decimal(20,0)")


def canonical_duration(x: Column) -> Column:
    return F.regexp_replace(x, r"^0+(?=\d)", "")


def is_number(x: Column) -> Column:
    """A strict JSON number of 32 bytes at most."""
    return x.rlike(r"\A-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?\z") & (F.octet_length(x) <= 32)


def first_nonempty(*xs: Column) -> Column:
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in xs], F.lit(""))


def or_label(x: Column, label: str = "(нет)") -> Column:
    return F.when(x == "", F.lit(label)).otherwise(x)


def trim_spaces(x: Column) -> Column:
    return F.trim(x)


def trim_blanks(x: Column) -> Column:
    return F.trim(x, F.lit(" \t"))


def lines(x: Column) -> Column:
    """Non-empty lines without carriage returns."""
    return F.filter(F.split(F.replace(x, F.lit("\r"), F.lit("")), "\n"), lambda v: v != "")


def last_nonempty_line(x: Column) -> Column:
    return F.coalesce(F.try_element_at(lines(x), F.lit(-1)), F.lit(""))


def path_segment(path: Column) -> Column:
    return F.split(path, r"[/\\]")[0]


def relative_path(path: Column, separator: str = "\\") -> Column:
    """Two ancestors and the base name; a missing ancestor is empty."""
    parts = F.filter(F.split(path, r"[/\\]"), lambda v: v != ".")
    padded = F.concat(F.array(F.lit(""), F.lit("")), parts)
    return F.array_join(F.slice(padded, -3, 3), separator)


def date_prefix(filename: Column) -> Column:
    """20YY-MM-DDTHH: of a name that begins with eight digits, else ''."""
    return F.when(filename.rlike("^[0-9]{8}"), F.regexp_replace(F.substring(filename, 1, 8), r"^(..)(..)(..)(..)$", "20$1-$2-$3T$4:")).otherwise(F.lit(""))


def wait_connections(x: Column) -> Column:
    return F.when(x == "", F.array().cast("array<bigint>")).otherwise(F.transform(F.split(x, ","), lambda v: u32(F.trim(v))))


def _epoch() -> Column:
    return F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))


def strict_event_time(text: Column) -> Column:
    """yyyy-MM-ddTHH:mm:ss.SSSSSS; anything that is no such moment is the epoch."""
    good = text.rlike(r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}\z")
    moment = F.try_to_timestamp(F.when(good, text), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).cast("timestamp_ntz")
    return F.coalesce(moment, _epoch())


def rolling_event_time(text: Column) -> Column:
    """The same form, but parts beyond their range roll over (month 13 is the next January); other forms are the epoch."""
    part = lambda a, n: F.substring(text, a, n).try_cast("int")
    good = text.rlike(r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}\z")
    month = F.add_months(F.make_date(part(1, 4), F.lit(1), F.lit(1)), part(6, 2) - 1)
    day = F.date_add(month, part(9, 2) - 1).cast("timestamp_ntz")
    clock = F.make_dt_interval(F.lit(0), part(12, 2), part(15, 2), F.substring(text, 18, 9).try_cast("decimal(18,6)"))
    return F.when(good, day + clock).otherwise(_epoch())


def minute(ts: Column) -> Column:
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def five_minutes(ts: Column) -> Column:
    return F.window(ts, "5 minutes")["start"].cast("timestamp_ntz")


def hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def duration_bucket(us: Column) -> Column:
    """Seven classes of durations."""
    out = F.lit("7. >60с")
    for limit, name in ((60_000_000, "6. 10–60с"), (10_000_000, "5. 3–10с"), (3_000_000, "4. 1–3с"), (1_000_000, "3. 0.5–1с"), (500_000, "2. 0.1–0.5с"), (100_000, "1. <0.1с")):
        out = F.when(us < limit, name).otherwise(out)
    return out


#: Six classes of parameter counts, in order.
PARAM_BUCKETS = ("0", "1", "2-10", "11-100", "101-1000", "1000+")


#: The largest count of each class but the last.
PARAM_BOUNDS = (0, 1, 10, 100, 1000)
PARAM_BUCKET_SQL = "CASE " + " ".join(f"WHEN param_count <= {n} THEN '{name}'" for n, name in zip(PARAM_BOUNDS, PARAM_BUCKETS, strict=False)) + f" ELSE '{PARAM_BUCKETS[-1]}' END"


def param_bucket(n: Column) -> Column:
    out = F.lit(PARAM_BUCKETS[-1])
    for bound, name in reversed(list(zip(PARAM_BOUNDS, PARAM_BUCKETS, strict=False))):
        out = F.when(n <= bound, name).otherwise(out)
    return out


def param_bucket_order(x: Column) -> Column:
    out = F.lit(9)
    for i, name in enumerate(PARAM_BUCKETS):
        out = F.when(x == name, i).otherwise(out)
    return out


def text_hash(x: Column) -> Column:
    """A grouping key of a text: 0 for the empty one, xxhash64 otherwise."""
    return F.when(x == "", F.lit(0).cast("bigint")).otherwise(F.xxhash64(x))


def hash_hex(x: Column) -> Column:
    return F.lpad(F.hex(x), 16, "0")


def map_get(m: Column, key: str) -> Column:
    return F.coalesce(m[key], F.lit(""))


def nth(array: Column, i: int) -> Column:
    """The i-th element from 1, '' beyond the end."""
    return F.coalesce(F.try_element_at(array, F.lit(i)), F.lit(""))


# ---- the significant line of a call stack

#: Methods that mark a report engine's line; the last pair only on lines that name the engine.
TRIGGERS = ("Вывести", "ВывестиЭлемент", "НачатьВывод", "Output", "OutputItem", "BeginOutput")
GUARDED, GUARDS = ("Инициализировать", "Initialize"), ("Компоновк", "DataComposition")
#: Modules that can be the culprit.
CULPRITS = ("Отчет", "ВнешнийОтчет", "Обработка", "ВнешняяОбработка", "Report", "ExternalReport", "DataProcessor", "ExternalDataProcessor")


def _calls(line: Column, names: tuple[str, ...]) -> Column:
    return line.rlike(r"(?<![\p{L}\p{Nd}_])(?:" + "|".join(names) + r")[ \t]*\(")


def context_line(context: Column, smart: bool = True) -> Column:
    """The last non-empty line; if that calls a report engine, the deepest line of a report's or processor's own module."""
    last = last_nonempty_line(context)
    if not smart:
        return last
    trigger = _calls(last, TRIGGERS) | (_calls(last, GUARDED) & last.rlike("|".join(GUARDS)))
    culprit = F.try_element_at(F.filter(lines(context), lambda v: v.rlike(r"^[ \t]*(?:" + "|".join(CULPRITS) + r")\.")), F.lit(-1))
    return F.when(trigger, F.coalesce(culprit, last)).otherwise(last)
