"""Personal data with information-theoretic sanitisation (operator 9).

Protected entities are e-mail addresses, IP addresses, card and phone numbers,
found by fixed patterns in whole texts, and what they have in common with others: the host of an address, the network
of an IP address (three parts), the first six digits of a card or phone number.  A corpus pass then estimates how strongly
other terms reveal them: for a term t and an entity e, P(e | t) is the share of the
texts holding t that also hold e, however far apart, and I(e; t) = log2 P(e | t) / P(e) the information
in bits that t gives about e.  Terms beyond ``share`` and ``bits`` with at least ``support`` different
texts disclose the entity, if the bits of all these texts together exceed what chance gives among as many pairs of
terms and entities (log2 of the pairs, and ``surplus``: 2 ** -surplus pairs are expected by chance at most).
Disclosing terms are generalised to their class, and those beyond ``share_remove`` removed,
wherever they stand in any text, since the statistics cover all of them.  Terms of any length count.
Equal texts count once, so copies prove nothing; entities of fewer than ``support`` texts can have no such term.

Spans are in code points, end exclusive: ``kind:start:end``.

Defined cases: null and empty texts have no spans; rows that repeat a document get equal
spans; texts of an entity only have no terms; ties of spans are listed by kind; an empty table
gives an empty result; ``sanitise`` carries all columns, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .tokens import Spans, Texts, chars, hash_spans, lowered, sliced, texts_of, words_of

KINDS = ("email", "ip", "card", "phone", "term")
#: Fixed patterns; the e-mail pattern [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ is matched from its @ outwards.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[^0-9]+")


@dataclass(frozen=True)
class Disclosure:
    """Thresholds of the corpus statistics."""

    support: int = 3
    share: float = 0.5
    share_remove: float = 0.9
    bits: float = 4.0
    surplus: float = 3.0


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(d // 5 + 2 * d % 10 for d in map(int, digits[-2::-2]))
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the four base kinds, in order; kind is the index in KINDS."""
    out = [(a, 0, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := DIGITS.sub("", m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= len(DIGITS.sub("", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    out.sort()
    return out


_EDGE = np.zeros(256, bool)
_EDGE[list(b"""!"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~""")] = True


def _terms(t: Texts) -> Spans:
    """Words without ASCII punctuation at their ends."""
    w = words_of(t)
    start, end = w.start.copy(), w.end.copy()
    live = np.flatnonzero(_EDGE[t.buf[start]])
    while len(live):
        start[live] += 1
        live = live[(start[live] < end[live]) & _EDGE[t.buf[np.minimum(start[live], t.size)]]]
    live = np.flatnonzero((end > start) & _EDGE[t.buf[end - 1]])
    while len(live):
        end[live] -= 1
        live = live[(end[live] > start[live]) & _EDGE[t.buf[end[live] - 1]]]
    return Spans(start, end, w.doc, w.first)


def _narrow(docs: DataFrame) -> DataFrame:
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tid"))


FOUND = "doc_id long, tid long, starts array<int>, kinds array<tinyint>, ends array<int>, entities array<long>"


def facets(kind: int, text: str) -> list[str]:
    """Names of an entity: the whole, and what it has in common with others."""
    if kind == 0:
        common = text[text.rindex("@") :].lower()
    elif kind == 1:
        common = text[: text.rindex(".") + 1]
    else:
        common = DIGITS.sub("", text)[:6]
    return [f"{kind}={text}", f"{kind}~{common}"]


def _entities(text: str, spans: list[tuple[int, int, int]]) -> list[int]:
    """Hashes of the entities of a text, each once."""
    names = {name for a, k, b in spans for name in facets(k, text[a:b])}
    return [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little", signed=True) for x in sorted(names)]


def _found(slim: DataFrame) -> DataFrame:
    """FOUND: base spans of each document, and the hashes of its entities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch):
                texts = part.column("text").to_pylist()
                spans = [base_spans(x) for x in texts]
                entities = [_entities(x, s) for x, s in zip(texts, spans, strict=True)]
                lists = [pa.array([[x[k] for x in s] for s in spans], pa.list_(kind)) for k, kind in ((0, pa.int32()), (1, pa.int8()), (2, pa.int32()))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("tid"), *lists, pa.array(entities, pa.list_(pa.int64()))], ["doc_id", "tid", "starts", "kinds", "ends", "entities"])

    return slim.mapInArrow(run, FOUND)


def _outside(t: Texts, w: Spans, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which terms are not empty and touch no base span, and where all begin and end in code points of their text."""
    at = chars(t)
    begin, end = at[w.start] - at[t.off[w.doc]], at[w.end] - at[t.off[w.doc]]
    free = w.end > w.start
    for i, text in enumerate(texts):
        f, l = w.first[i], w.first[i + 1]
        for s, _, stop in base_spans(text):
            free[f + int(np.searchsorted(end[f:l], s, "right")) : f + int(np.searchsorted(begin[f:l], stop))] = False
    return free, begin, end


def _terms_of(slim: DataFrame, tids: DataFrame) -> DataFrame:
    """(tid, terms): the distinct terms outside base spans of the texts with a given tid; a bitmap of fixed size leaves most others out before the join."""
    bits = slim.sparkSession.sparkContext.broadcast(shared.bitmap(tids, "tid"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tid = np.asarray(batch.column("tid")).view(np.uint64)
            _, once = np.unique(tid, return_index=True)
            once = np.sort(once[shared.in_bitmap(bits.value, tid[once])])
            for part in sliced(batch.take(pa.array(once))):
                t = lowered(texts_of(part.column("text")))
                w = _terms(t)
                free, _, _ = _outside(t, w, part.column("text").to_pylist())
                h = hash_spans(t, w.start, np.maximum(w.start, w.end), 9).view(np.int64)
                terms = [np.unique(h[f:l][free[f:l]]) for f, l in zip(w.first, w.first[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([part.column("tid"), pa.array(terms, pa.list_(pa.int64()))], ["tid", "terms"])

    found = slim.select("text", "tid").mapInArrow(run, "tid long, terms array<long>")
    return found.join(tids, "tid", "left_semi").groupBy("tid").agg(F.first("terms").alias("terms"))


def _texts_with(slim: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, tid) of the texts that hold a term; a bitmap of fixed size leaves most others out before the join."""
    bits = slim.sparkSession.sparkContext.broadcast(shared.bitmap(terms, "term"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch):
                t = lowered(texts_of(part.column("text")))
                w = _terms(t)
                good = np.flatnonzero(w.end > w.start)
                h = hash_spans(t, w.start[good], w.end[good], 9)
                hit = shared.in_bitmap(bits.value, h)
                h, doc = h[hit].view(np.int64), w.doc[good[hit]]
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(h[new]), part.column("tid").take(pa.array(doc[new]))], ["term", "tid"])

    return slim.select("text", "tid").mapInArrow(run, "term long, tid long").join(terms, "term", "left_semi")


def _places(slim: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, tid, term, start, end): each place of a term outside base spans; terms the bitmap lets through by chance are left to a join."""
    bits = slim.sparkSession.sparkContext.broadcast(shared.bitmap(terms, "term"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch):
                t = lowered(texts_of(part.column("text")))
                w = _terms(t)
                h = hash_spans(t, w.start, np.maximum(w.start, w.end), 9)
                hit = shared.in_bitmap(bits.value, h) & (w.end > w.start)
                held = np.zeros(t.n, bool)
                held[w.doc[hit]] = True
                texts = part.column("text").to_pylist()
                free, begin, end = _outside(t, w, [x if held[i] else "" for i, x in enumerate(texts)])
                k = np.flatnonzero(hit & free)
                doc = pa.array(w.doc[k])
                cols = [part.column("doc_id").take(doc), part.column("tid").take(doc), pa.array(h[k].view(np.int64)), pa.array(begin[k].astype(np.int32)), pa.array(end[k].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "tid", "term", "start", "end"])

    return slim.mapInArrow(run, "doc_id long, tid long, term long, start int, end int")


def _analysed(docs: DataFrame, how: Disclosure) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The narrow documents, found rows, and (term, remove) of the terms that disclose an entity."""
    slim = _narrow(docs)
    found = shared.stored(_found(slim), "pii-found")
    entities = found.filter(F.size("entities") > 0).select("tid", F.explode("entities").alias("entity")).distinct()
    total = slim.select("tid").distinct().count()
    # of an entity that more texts have, no term can give so many bits
    most = total / 2**how.bits
    counted = entities.groupBy("entity").agg(F.count("*").alias("of_entity")).filter(F.col("of_entity").between(how.support, most))
    counted = shared.stored(counted, "pii-entities")
    entities = shared.stored(entities.join(counted.select("entity"), "entity", "left_semi").groupBy("tid").agg(F.collect_list("entity").alias("entities")), "pii-texts")
    held_by = shared.stored(_terms_of(slim, entities.select("tid")).join(entities, "tid"), "pii-terms")
    pairs = held_by.select("entities", F.explode("terms").alias("term")).select(F.explode("entities").alias("entity"), "term")
    pairs = pairs.groupBy("entity", "term").agg(F.count("*").alias("both")).filter(F.col("both") >= how.support)
    # a term is held by at least the texts that hold it and some entity: a cheap bound that already rules most pairs out
    beside = shared.stored(held_by.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("beside")), "pii-beside")
    chance = math.log2(max(1, beside.count()) * max(1, counted.count())) + how.surplus
    pairs = pairs.join(beside, "term").filter(F.col("both") >= how.share * F.col("beside")).drop("beside")
    pairs = shared.stored(pairs, "pii-pairs")
    held = _texts_with(slim, pairs.select("term").distinct()).distinct().groupBy("term").agg(F.count("*").alias("texts"))
    shares = pairs.join(held, "term").join(counted, "entity")
    p = F.col("both") / F.col("texts")
    bits = F.log2(p * total / F.col("of_entity"))
    strong = shares.filter((p >= how.share) & (bits >= how.bits) & (bits * F.col("both") >= chance)).groupBy("term").agg(F.max(p >= how.share_remove).alias("remove"))
    return slim, found, shared.stored(strong, "pii-strong")


def spans(docs: DataFrame, how: Disclosure = Disclosure()) -> DataFrame:
    """(doc_id, tid, spans: array of (start, kind, end, remove)) of each document, in order; kind is the index in KINDS."""
    slim, found, strong = _analysed(docs, how)
    terms = _places(slim, strong.select("term")).join(strong, "term")
    terms = terms.groupBy("doc_id", "tid", "start", "end").agg(F.max("remove").alias("remove"))
    terms = terms.groupBy("doc_id", "tid").agg(F.collect_list(F.struct("start", F.lit(4).cast("tinyint").alias("kind"), "end", "remove")).alias("terms"))
    terms = terms.withColumnsRenamed({"doc_id": "_d", "tid": "_t"})
    base = F.transform(F.arrays_zip("starts", "kinds", "ends"), lambda x: F.struct(x["starts"].alias("start"), x["kinds"].alias("kind"), x["ends"].alias("end"), F.lit(False).alias("remove")))
    empty = F.array().cast("array<struct<start:int,kind:tinyint,end:int,remove:boolean>>")
    both = found.join(terms.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tid") == F.col("_t")), "left")
    return both.select("doc_id", "tid", F.sort_array(F.concat(base, F.coalesce("terms", empty))).alias("spans"))


def listed(array) -> F.Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(array, lambda x: F.concat_ws(":", F.get(names, x["kind"].cast("int")), x["start"].cast("string"), x["end"].cast("string"))), ",")


def general(term: str) -> str:
    """What a disclosing term is generalised to: its class by its looks."""
    kind = "NUMBER" if term.isdigit() else "HOST" if "." in term or "/" in term else "CODE" if any(c.isdigit() for c in term) else "NAME" if term[:1].isupper() else "TERM"
    return f"[{kind}]"


def sanitise(docs: DataFrame, how: Disclosure = Disclosure()) -> DataFrame:
    """The documents with entities as ``[EMAIL]`` and the like, disclosing terms as their class (``general``) or removed; all columns."""
    own = spans(docs, how).filter(F.size("spans") > 0).select(F.col("doc_id").alias("_d"), F.col("tid").alias("_t"), F.col("spans").alias("_spans")).dropDuplicates(["_d", "_t"])
    key = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    wide = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs["doc_id"].cast("long").alias("_id"), key.alias("_key"), docs["text"].cast("string").alias("_text"))
    both = wide.join(own.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_key") == F.col("_t")), "left")

    @F.pandas_udf("string")
    def replaced(text, found):
        out = []
        for t, s in zip(text, found, strict=True):
            if t is None or s is None or not len(s):
                out.append(t)
                continue
            parts, done = [], 0
            for x in s:
                if x["start"] >= done:
                    parts += [t[done : x["start"]], "" if x["remove"] else f"[{KINDS[x['kind']].upper()}]" if x["kind"] < 4 else general(t[x["start"] : x["end"]])]
                    done = x["end"]
            out.append("".join([*parts, t[done:]]))
        return type(text)(out)

    new = both.withColumn("_text", replaced("_text", "_spans"))
    return new.select(*[F.col("_text").alias(c) if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns])
