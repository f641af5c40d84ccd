"""Secret scans with a battery of randomness tests (operator 8), in DataFrame functions only.

Base kinds are fixed patterns: assignments of secrets, access key ids, long hex strings.
The method adds ``random`` spans: long tokens whose encoding can be inferred
(hex, base32, base36, base64) and that pass as uniform random strings of that
alphabet.  Beside whole tokens, the long parts between their - _ / + are tested by their own
alphabets, and UUIDs by their joined digits; a random span within another is left out.  Three tests of that hypothesis are made for each token: chi-squared
uniformity of the symbols, the runs test of symbols above and below the middle, and
the lag-one serial correlation; the token's p-value is three times the smallest.
Two false-discovery controls act within length
classes (short tokens have little evidence, long ones much).  Benjamini-Hochberg keeps the share of truly
random strings among the discarded tokens below ``q``.  And the share of ordinary tokens among the reported ones is kept below
``q`` as estimated from the p-values above a half, which random strings have as often as those below.  Both work on a histogram of
-100 log10 p, whose size is bounded by classes x bins, with each p rounded up.

Spans are in code points, end exclusive: ``kind:start:end``.  Positions come from the pieces
between matches, so the whole text is read and nothing leaves the JVM.

Defined cases: null and empty texts have no spans; matches that fail a kind's condition are dropped
without a retry; ties of spans are listed by kind; rows that repeat a document get equal spans; an empty
table gives an empty result; ``scan`` keeps extra columns if asked to, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

KINDS = ("assign", "access", "hex", "random")
#: Fixed patterns.
ASSIGN = r"""(?=[pstaPSTA])(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 characters or more: shorter runs hold no longer match
HEX = r"[0-9a-f]{24,}"  # [0-9a-f]+ of 24 characters or more, likewise
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
PART = r"(?<![A-Za-z0-9])(?:(?<=[+/_-])[A-Za-z0-9]{20,}+|[A-Za-z0-9]{20,}+(?=[+/_-]))"
UUID = r"(?<![A-Za-z0-9])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![A-Za-z0-9])"
SMALL = "0123456789abcdefghijklmnopqrstuvwxyz"
LARGE = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: Length classes of the false-discovery control: lower bounds.
CLASSES = (20, 24, 32, 48, 64, 128)
BINS, Q = 2000, 0.05


def _placed(text: Column, matches: Column, pattern: str) -> Column:
    """array<struct<start, end, m>> of the matches, from the lengths of the pieces between them."""
    pieces = F.split(text, pattern, -1)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,m:string>>").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["p"])
        end = start + F.length(x["m"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["m"].alias("m")))).alias("out"))

    zipped = F.zip_with(matches, F.slice(pieces, 1, F.size(matches)), lambda m, p: F.struct(m.alias("m"), p.alias("p")))
    return F.when(F.size(matches) > 0, F.aggregate(zipped, zero, add, lambda acc: acc["out"])).otherwise(zero["out"])


def _tail(z: Column) -> Column:
    """P(Z > z) of the standard normal: a rational approximation, beyond 4 the asymptotic one."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    density = F.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    upper = density * F.when(x < 4, poly).otherwise(1 / F.greatest(x, F.lit(1.0)) * (1 - 1 / F.greatest(x * x, F.lit(1.0))))
    return F.when(z >= 0, upper).otherwise(1 - upper)


def _facts(token: Column) -> Column:
    """struct<core, k>: the token without padding in the alphabet's own letters, and the alphabet's size (0: no encoding)."""
    core = F.regexp_replace(token, "=+$", "")
    small = F.lower(core)
    k = (
        F.when(~core.rlike("[A-Za-z]"), 0)
        .when(core.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), 16)
        .when(core.rlike("^[A-Z2-7]+$"), 32)
        .when(core.rlike("^(?:[0-9a-z]+|[0-9A-Z]+)$"), 36)
        .when(core.rlike("[A-Z]") & core.rlike("[a-z]"), 64)
        .otherwise(0)
    )
    return F.struct(F.when(k == 64, F.translate(core, "-_", "+/")).otherwise(small).alias("core"), k.alias("k"))


def _p_value(core: Column, k: Column, v: Column) -> Column:
    """Three times the smallest p-value of the battery; v: the symbols' places in the alphabet, from 1."""
    n = F.length(core).cast("double")
    squares = F.aggregate(
        F.array_distinct(F.split(core, "")), F.lit(0.0), lambda acc, c: acc + F.pow(n - F.length(F.replace(core, c, F.lit(""))).cast("double"), F.lit(2.0))
    )
    chi = k / n * squares - n
    # few symbols of a large alphabet: a gamma law with the statistic's own mean and variance, by its cube root
    shape = (k - 1) * n / (2 * (n - 1))
    p_chi = _tail(3 * F.sqrt(shape) * (F.cbrt(chi / (k - 1)) - 1 + 1 / (9 * shape)))
    high = F.size(F.filter(v, lambda x: x > k / 2)).cast("double")
    low = n - high
    pairs = F.zip_with(F.slice(v, 1, F.size(v) - 1), F.slice(v, 2, F.size(v) - 1), lambda a, b: F.struct(a.cast("double").alias("a"), b.cast("double").alias("b")))
    runs = F.aggregate(pairs, F.lit(1.0), lambda acc, x: acc + F.when((x["a"] > k / 2) != (x["b"] > k / 2), 1.0).otherwise(0.0))
    spread = 2 * high * low / n
    deviation = F.sqrt(F.greatest(spread * (spread - 1) / (n - 1), F.lit(1e-9)))
    p_runs = F.when((high == 0) | (low == 0), 0.0).otherwise(2 * _tail(F.abs((runs - spread - 1) / deviation)))
    mean, variance = (k + 1) / 2, (k * k - 1) / 12
    serial = F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + (x["a"] - mean) * (x["b"] - mean)) / ((n - 1) * variance)
    p_serial = 2 * _tail(F.abs(serial * F.sqrt(n - 1)))
    return F.least(F.lit(1.0), 3 * F.least(p_chi, p_runs, p_serial))


def _scored(tokens: Column) -> Column:
    """array<struct<start, end, length, p>> of the tokens with an inferred encoding."""
    with_facts = F.filter(F.transform(tokens, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), _facts(x["m"]).alias("f"))), lambda x: x["f"]["k"] > 0)
    alphabet = lambda k: F.when(k == 64, F.lit(LARGE)).when(k == 32, F.lit(SMALL[10:] + "234567")).otherwise(F.lit(SMALL))
    placed = F.transform(with_facts, lambda x: F.struct(x["start"], x["end"], x["f"], F.transform(F.split(x["f"]["core"], ""), lambda c: F.instr(alphabet(x["f"]["k"]), c)).alias("v")))
    return F.transform(
        placed,
        lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.length(x["f"]["core"]).alias("length"), _p_value(x["f"]["core"], x["f"]["k"].cast("double"), x["v"]).alias("p")),
    )


def _class_of(length: Column) -> Column:
    out = F.lit(0)
    for i, low in enumerate(CLASSES):
        out = F.when(length >= low, i).otherwise(out)
    return out


def _bin_of(p: Column) -> Column:
    """-100 log10 p, rounded down (so p is rounded up), at most BINS."""
    return F.least(F.floor(-100 * F.log10(F.greatest(p, F.lit(1e-300)))), F.lit(BINS)).cast("int")


def discard_from(found: DataFrame, q: float = Q) -> list[int]:
    """For each length class the least bin whose tokens are not reported (BINS + 1: all are), by both controls."""
    tokens = found.select(F.explode("random").alias("x")).select(_class_of(F.col("x.length")).alias("class"), _bin_of(F.col("x.p")).alias("bin"))
    counts = tokens.groupBy("class", "bin").count().collect()  # at most len(CLASSES) * (BINS + 1) rows
    return [limit_of([(r["bin"], r["count"]) for r in counts if r["class"] == c], q) for c in range(len(CLASSES))]


def limit_of(counts: list[tuple[int, int]], q: float) -> int:
    """The least bin that is not reported, from the (bin, tokens) of a length class."""
    total = sum(n for _, n in counts)
    # discards: Benjamini-Hochberg, least p-values first
    seen, discard = 0, BINS + 1
    for b, n in sorted(counts, reverse=True):
        seen += n
        if 10 ** (-b / 100) <= q * seen / total:
            discard = b
    # reports: half of the random tokens have p above a half, others hardly any, which tells how many are random
    random = min(total, 2 * (1 + sum(n for b, n in counts if b < 30)))
    seen, report = 0, 0
    for b, n in sorted(counts):
        seen += n
        ordinary = min(seen - random * (1 - 10 ** (-(b + 1) / 100)), total - random)
        if ordinary <= q * seen:
            report = b + 1
    return min(discard, report if counts else discard)


def _matched(docs: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    step = docs.select(F.struct(*[docs[c] for c in carry]).alias("_row"), text.alias("_text"))  # a struct, so that no name clashes
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "random": TOKEN, "part": PART, "uuid": UUID}
    step = step.select("*", *[F.regexp_extract_all("_text", F.lit(p), F.lit(0)).alias(f"_{k}") for k, p in patterns.items()])
    step = step.select("_row", *[_placed(F.col("_text"), F.col(f"_{k}"), p).alias(f"_{k}") for k, p in patterns.items()])
    good = F.filter("_assign", lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= 6)
    joined = F.transform("_uuid", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.replace(x["m"], F.lit("-"), F.lit("")).alias("m")))
    tokens = F.concat("_random", "_part", joined)
    return step.select("_row", good.alias("assign"), F.col("_access").alias("access"), F.col("_hex").alias("hex"), _scored(tokens).alias("random"))


def scan(docs: DataFrame, q: float = Q, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns and ``spans``: array<struct<start, kind, end>> in order; kind is the index in KINDS."""
    found = shared.stored(_matched(docs, carry), "secrets")
    least = F.array(*map(F.lit, discard_from(found, q)))
    passed = F.filter("random", lambda x: _bin_of(x["p"]) < F.get(least, _class_of(x["length"])))
    found = found.withColumn("random", F.array_distinct(F.transform(passed, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))))
    within = lambda x, y: (y["start"] <= x["start"]) & (y["end"] >= x["end"]) & (y["end"] - y["start"] > x["end"] - x["start"])
    random = F.filter("random", lambda x: ~F.exists("random", lambda y: within(x, y)))

    def of_kind(spans: Column, kind: int) -> Column:
        return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))

    parts = [of_kind(c, i) for i, c in enumerate((F.col("assign"), F.col("access"), F.col("hex"), random))]
    own = [F.col("_row").getField(c).alias(c) for c in carry]
    return found.select(*own, F.sort_array(F.concat(*parts)).alias(shared.unused("spans", docs.select(*carry))))


def listed(array: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(array, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
