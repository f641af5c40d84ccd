"""SentencePiece encoding and decoding over a relational lattice (operator 2).

Texts are normalised as the model says (a space becomes U+2581, one is put in front) and
cut into units between any two characters that no piece holds side by side: no merge and no
path crosses such a place, so encoding a unit is independent of its neighbours, and only distinct units are encoded:

1. the distinct units of the corpus with their counts;
2. their substrings of bounded length, exploded and equi-joined with the piece table (its size
   is that of the vocabulary, so it is broadcast): the edges of the lattice;
3. edges grouped by unit (no further shuffle: units are already dealt by it) and folded with
   ``aggregate``.  For unigram models the fold is Viterbi.  A BPE model is not encoded by the
   best path: its fold takes the edges in order of rank and merges where exactly two symbols
   are left between its ends, which gives what the library gives;
4. the most frequent units (at most HEAD of at most HEAD_BYTES bytes: a fixed bound) are broadcast and numbered;
   texts are shuffled once as compressed numbers of units, and meet the ids of their other units, which a join by hash finds, exactly.

Characters without a piece become byte pieces, so decoding gives the text back, with U+2581 read as
a space as SentencePiece does.

Defined cases: null and empty texts have no ids; rows that repeat a document get equal ids; an
empty table gives an empty result; units may be long (their fold grows with their edges); extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared
from .simhash import xxh64
from .tokens import Texts, hash_spans, sliced, texts_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
HEAD, HEAD_BYTES = 1 << 20, 48
#: Bytes of text, and of compressed numbers, that a worker takes at once: a byte of text has some fifty bytes of indices beside it.
PART, PACKED = 1 << 19, 1 << 17
U = np.uint64
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Fields of a protocol buffer message: numbers, and bytes of everything else."""
    i = 0

    def number() -> int:
        nonlocal i
        x = shift = 0
        while True:
            b = data[i]
            i += 1
            x |= (b & 127) << shift
            shift += 7
            if b < 128:
                return x

    while i < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        size = number() if tag & 7 == 2 else 4 if tag & 7 == 5 else 8
        yield tag >> 3, data[i : i + size]
        i += size


@dataclass
class Model:
    """What encoding needs of a model: (text, id, score) of ordinary pieces, byte pieces' ids, the kind and the dummy prefix."""

    pieces: list[tuple[str, int, float]]
    bytes_: list[int]
    unknown: int
    kind: int
    prefix: bool
    texts: list[bytes | None]

    @classmethod
    def load(cls, path: str = MODEL) -> Model:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        trainer, normalizer = {}, {}
        for number, value in _fields(p.serialized_model_proto()):
            if number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("only models that leave the characters and spaces of a text as they are can be encoded")
        n = p.get_piece_size()
        bytes_ = {int(p.id_to_piece(i)[1:-1], 16): i for i in range(n) if p.is_byte(i)}
        plain = [i for i in range(n) if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i))]
        texts: list[bytes | None] = [None] * n
        for i in plain:
            texts[i] = p.id_to_piece(i).replace(SPACE, " ").encode()
        for b, i in bytes_.items():
            texts[i] = bytes([b])
        return cls([(p.id_to_piece(i), i, float(p.get_score(i))) for i in plain], [bytes_[b] for b in range(256)] if len(bytes_) == 256 else [], p.unk_id(), trainer.get(3, UNIGRAM), bool(normalizer.get(3, 1)), texts)

    @property
    def longest(self) -> int:
        return max((len(p) for p, _, _ in self.pieces), default=1)

    def joined(self) -> np.ndarray:
        """256 x 256: whether some piece has a byte next to another.  Between two characters that no piece joins nothing is ever merged."""
        out = np.zeros((256, 256), bool)
        for text, _, _ in self.pieces:
            raw = np.frombuffer(text.replace(SPACE, " ").encode(), np.uint8)
            out[raw[:-1], raw[1:]] = True
        out[:, 0x80:0xC0] = True  # characters are never cut
        return out


def _units(t: Texts, joined: np.ndarray, prefix: bool) -> tuple[Texts, np.ndarray, np.ndarray]:
    """The texts with their first space, and the starts of their units; the index of each text's first unit (n + 1)."""
    size = np.diff(t.off)
    full = size > 0
    extra = full.astype(np.int64) if prefix else np.zeros(t.n, np.int64)
    off = np.concatenate([[0], np.cumsum(size + extra)])
    buf = np.full(int(off[-1]) + 16, 32, np.uint8)
    buf[np.arange(t.size) + np.repeat(np.cumsum(extra), size)] = t.buf[: t.size]
    k = buf[: off[-1]]
    start = np.ones(len(k), bool)
    start[1:] = ~joined.ravel()[k[:-1].astype(np.uint16) * np.uint16(256) + k[1:]]
    start[off[:-1][full]] = True
    at = np.flatnonzero(start)
    return Texts(buf, off), at, np.searchsorted(at, off)


def _plain(df: DataFrame) -> DataFrame:
    text = F.replace(F.coalesce(df["text"].cast("string"), F.lit("")), F.lit(SPACE), F.lit(" "))
    return df.select(df["doc_id"].cast("long").alias("doc_id"), text.alias("text")).withColumn("rid", F.xxhash64("doc_id", "text"))


def distinct_units(docs: DataFrame, model: Model, most: int = 1 << 20) -> DataFrame:
    """(h, unit, n): distinct units with their counts; a task sums up at most ``most`` units before it passes them on."""
    joined, prefix = model.joined(), model.prefix

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        total = 0

        def merged():
            h = np.concatenate([x[0] for x in held])
            n = np.concatenate([x[1] for x in held])
            units = pa.concat_arrays([x[2] for x in held])
            held.clear()  # else all is there twice
            order = np.argsort(h, kind="stable")
            lead = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
            return h[order][lead], np.add.reduceat(n[order], lead), units.take(pa.array(order[lead]))

        for batch in batches:
            for part in sliced(batch, most=PART):
                t, at, _ = _units(texts_of(part.column("text")), joined, prefix)
                if not len(at):
                    continue
                end = np.append(at[1:], t.size)
                h, lead, n = np.unique(hash_spans(t, at, end, 3).view(np.int64), return_index=True, return_counts=True)
                size = (end - at)[lead]
                place = np.concatenate([[0], np.cumsum(size)])
                data = t.buf[np.arange(place[-1]) + np.repeat(at[lead] - place[:-1], size)]
                units = pa.StringArray.from_buffers(len(h), pa.py_buffer(place.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes()))
                held.append((h, n, units))
                total += len(h)
                if total > most:
                    held = [merged()]
                    if len(held[0][0]) > most // 2:
                        yield pa.RecordBatch.from_arrays([held[0][2], pa.array(held[0][1])], ["unit", "n"])
                        held = []
                    total = sum(len(x[0]) for x in held)
        if held:
            _, n, units = merged()
            yield pa.RecordBatch.from_arrays([units, pa.array(n)], ["unit", "n"])

    # a task passes each unit on about once, so rows are dealt as they are, in more parts than usual for the work that follows;
    # the length is an aggregate, so that filters on it don't reach below the exchange and both lengths share it
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.select("text").mapInArrow(shared.lean(run), "unit string, n long").repartition(parts, "unit").groupBy("unit").agg(F.sum("n").alias("n"), F.max(F.length("unit")).alias("size"))
    return dealt.select(F.xxhash64("unit").alias("h"), "unit", "n", "size")


def _pairs(units: DataFrame, rows: list[tuple], value: str, longest: int) -> DataFrame:
    """(h, unit, n, s, l, and the value columns): substrings of the units that are pieces.

    Substrings are exploded and joined to the piece table (broadcast: its size is the vocabulary's) by a 64-bit hash, which is
    some four times cheaper than by text; hits are verified on the text.  The empty piece keeps units without any edge.
    """
    size = F.length("unit")
    starts = units.select("h", "unit", "n", F.explode(F.sequence(F.lit(0), size - 1)).alias("s"))
    parts = starts.select("*", F.explode(F.sequence(F.when(F.col("s") == 0, 0).otherwise(1), F.least(F.lit(longest), F.length("unit") - F.col("s")))).alias("l"))
    piece = F.substring(F.col("unit"), F.col("s") + 1, F.col("l"))
    table = units.sparkSession.createDataFrame(rows, f"piece string, {value}").select(F.xxhash64("piece").alias("k"), "*")
    found = parts.select("*", F.xxhash64(piece).alias("k")).join(F.broadcast(table), "k")
    # not written as an equality, which would become a second key of the join
    return found.filter((F.length("piece") == F.col("l")) & F.startswith(piece, F.col("piece"))).drop("k", "piece")


def lattice(units: DataFrame, model: Model) -> DataFrame:
    """(h, unit, n, edges): the edges of each unit's lattice, array<struct<rank, s, e, id>>; rank is the negative score, s and e count characters."""
    rows = [(p.replace(SPACE, " "), i, -s) for p, i, s in model.pieces]
    edges = _pairs(units, [*rows, ("", -1, 1e300)], "id int, rank double", model.longest)
    edge = F.struct("rank", "s", (F.col("s") + F.col("l")).alias("e"), "id")
    return edges.groupBy("unit", "h", "n").agg(F.collect_list(edge).alias("edges"))


def _spelled(text: Column, model: Model) -> Column:
    """The byte pieces of a text, or the unknown piece."""
    if not model.bytes_:
        return F.array(F.lit(model.unknown))
    code = F.hex(F.encode(text, "UTF-8"))
    table = F.array(*map(F.lit, model.bytes_))
    return F.transform(F.sequence(F.lit(0), (F.length(code) / 2 - 1).cast("int")), lambda k: F.get(table, F.conv(F.substring(code, 2 * k + 1, F.lit(2)), 16, 10).cast("int")))


def _ids(starts: Column, n: Column, unit: Column, edges: Column, model: Model) -> Column:
    """Ids of the segments that begin at ``starts``; a character without a piece gives its byte pieces, or the unknown piece."""

    def of(p: Column, i: Column) -> Column:
        stop = F.coalesce(F.get(starts, i + 1), n)
        own = F.get(F.filter(edges, lambda x: (x["s"] == p) & (x["e"] == stop)), F.lit(0))["id"]
        return F.when(own.isNull(), _spelled(F.substring(unit, p + 1, stop - p), model)).otherwise(F.array(own))

    return F.flatten(F.transform(starts, of))


def _merge_fold(edges: DataFrame, model: Model) -> DataFrame:
    """The BPE fold of long units: at each character the id of the symbol that starts there (-1: no piece), or -2 inside a symbol."""
    n = F.length("unit")
    sorted_edges = F.sort_array(F.filter("edges", lambda x: x["e"] - x["s"] > 1))
    chars = F.transform(F.filter("edges", lambda x: x["e"] - x["s"] == 1), lambda x: F.struct(x["s"].alias("s"), x["id"].alias("id")))
    missing = F.transform(F.array_except(F.sequence(F.lit(0), n - 1), F.transform(chars, lambda x: x["s"])), lambda s: F.struct(s.alias("s"), F.lit(-1).alias("id")))
    begun = F.transform(F.sort_array(F.concat(chars, missing)), lambda x: x["id"])

    def merge_array(c: Column, x: Column) -> Column:
        inner = F.slice(c, x["s"] + 2, x["e"] - x["s"] - 1)
        ok = (F.get(c, x["s"]) != -2) & (F.coalesce(F.get(c, x["e"]), F.lit(0)) != -2) & (F.size(F.filter(inner, lambda i: i != -2)) == 1)
        put = F.concat(F.slice(c, F.lit(1), x["s"]), F.array(x["id"]), F.array_repeat(F.lit(-2), x["e"] - x["s"] - 1), F.slice(c, x["e"] + 1, F.size(c)))
        return F.when(ok, put).otherwise(c)

    step = edges.select("*", F.aggregate(sorted_edges, begun, merge_array).alias("symbols"))
    spelled = F.flatten(F.transform("symbols", lambda x, i: F.when(x == -2, F.array().cast("array<int>")).when(x == -1, _spelled(F.substring(F.col("unit"), i + 1, F.lit(1)), model)).otherwise(F.array(x))))
    return step.select("h", "unit", "n", spelled.alias("ids"))


#: An edge of a short unit as one long: rank order, start, end, id.
_RANK, _START, _END, _ID = 1 << 36, 1 << 28, 1 << 20, (1 << 20) - 1
SHORT = 60


def _short_fold(units: DataFrame, model: Model) -> DataFrame:
    """The BPE fold of units of up to SHORT characters: edges are packed longs, symbol borders the bits of a long."""
    order = sorted(model.pieces, key=lambda x: (-x[2], x[1]))
    rows = [(p.replace(SPACE, " "), r * _RANK + i) for r, (p, i, _) in enumerate(order)]
    edge = F.col("packed") + F.col("s").cast("long") * F.lit(_START) + (F.col("s") + F.col("l")).cast("long") * F.lit(_END)
    edges = _pairs(units, [*rows, ("", len(order) * _RANK)], "packed long", model.longest).select("h", "unit", "n", edge.alias("x"))
    edges = edges.groupBy("unit", "h", "n").agg(F.collect_list("x").alias("x"))

    one = F.lit(1).cast("long")
    left = lambda v, k: F.call_function("shiftleft", v, k)
    right = lambda v, k: F.call_function("shiftright", v, F.lit(k))
    s_of = lambda x: right(x, 28).bitwiseAND(F.lit(255)).cast("int")
    e_of = lambda x: right(x, 20).bitwiseAND(F.lit(255)).cast("int")
    ends = lambda x: left(one, s_of(x)).bitwiseOR(left(one, e_of(x)))
    inner = lambda x: left(one, e_of(x)) - left(one, s_of(x) + 1)

    def merge(c: Column, x: Column) -> Column:
        return F.when((c.bitwiseAND(ends(x)) == ends(x)) & (F.bit_count(c.bitwiseAND(inner(x))) == 1), c.bitwiseAND(F.bitwise_not(inner(x)))).otherwise(c)

    n = F.length("unit")
    step = edges.select("*", F.aggregate(F.sort_array(F.filter("x", lambda x: e_of(x) - s_of(x) > 1)), left(one, n + 1) - 1, merge).alias("bits"))
    bits = F.col("bits")
    used = F.filter("x", lambda x: (e_of(x) > s_of(x)) & (bits.bitwiseAND(ends(x)) == ends(x)) & (bits.bitwiseAND(inner(x)) == 0))
    step = step.select("*", used.alias("used"))
    covered = F.aggregate("used", F.lit(0), lambda acc, x: acc + e_of(x) - s_of(x))
    ids = F.transform(F.sort_array(F.transform("used", lambda x: s_of(x) * F.lit(_END) + x.bitwiseAND(F.lit(_ID)))), lambda y: y.bitwiseAND(F.lit(_ID)).cast("int"))
    starts_of = F.filter(F.sequence(F.lit(0), n - 1), lambda p: F.call_function("shiftright", bits, p).bitwiseAND(one) == 1)
    spelled = _ids(starts_of, n, F.col("unit"), F.transform("used", lambda x: F.struct(s_of(x).alias("s"), e_of(x).alias("e"), x.bitwiseAND(F.lit(_ID)).cast("int").alias("id"))), model)
    return step.select("h", "unit", "n", F.when(covered == n, ids).otherwise(spelled).alias("ids"))


def _viterbi_fold(edges: DataFrame, model: Model) -> DataFrame:
    """The unigram fold: the best score of each place with its last edge's start, then the way back.  A character without a piece costs 10 more than the worst piece."""
    n = F.length("unit")
    worst = F.lit(min((s for _, _, s in model.pieces), default=0.0) - 10.0)
    state = "array<struct<score:double,back:int>>"

    def forward(st: Column, e: Column) -> Column:
        into = F.filter("edges", lambda x: (x["e"] == e) & (x["e"] > x["s"]))
        scored = F.transform(into, lambda x: F.struct((F.get(st, x["s"])["score"] - x["rank"]).alias("score"), x["s"].alias("back")))
        alone = F.array(F.struct((F.get(st, e - 1)["score"] + worst).alias("score"), (e - 1).alias("back")))
        known = F.exists(into, lambda x: x["s"] == e - 1)
        return F.concat(st, F.array(F.array_max(F.when(known, scored).otherwise(F.concat(scored, alone)))))

    best = F.aggregate(F.sequence(F.lit(1), n), F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("back"))).cast(state), forward)
    zero = F.struct(n.alias("at"), F.array().cast("array<int>").alias("out"))

    def backward(acc: Column, _: Column) -> Column:
        back = F.get(F.col("best"), acc["at"])["back"]
        return F.when(acc["at"] > 0, F.struct(back.alias("at"), F.concat(F.array(back), acc["out"]).alias("out"))).otherwise(acc)

    step = edges.select("*", best.alias("best"))
    step = step.select("h", "unit", "n", "edges", F.aggregate(F.sequence(F.lit(1), n), zero, backward, lambda acc: acc["out"]).alias("starts"))
    return step.select("h", "unit", "n", _ids(F.col("starts"), n, F.col("unit"), F.col("edges"), model).alias("ids"))


def encoded_units(docs: DataFrame, model: Model) -> DataFrame:
    """(h, unit, n, ids): the distinct units of the texts with their ids."""
    units = distinct_units(_plain(docs), model)
    if model.kind == UNIGRAM:
        return _viterbi_fold(lattice(units, model), model)
    long = _merge_fold(lattice(units.filter(F.col("size") > SHORT), model), model)
    return _short_fold(units.filter(F.col("size") <= SHORT), model).unionByName(long)


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of consecutive ranges, one after the other."""
    place = np.concatenate([[0], np.cumsum(sizes)])
    return np.arange(place[-1]) + np.repeat(starts - place[:-1], sizes)


class Head:
    """The most frequent units, ranked by their counts: their hashes in order with their ranks, and the ids of each rank."""

    def __init__(self, units: DataFrame, most: int):
        good = units.filter(F.col("bytes") <= HEAD_BYTES).withColumn("bin", F.floor(8 * F.log2("n")).cast("int"))
        bins = sorted(((r["bin"], r["count"]) for r in good.groupBy("bin").count().collect()), reverse=True)  # at most 8 * 63 rows
        total, least = 0, None
        for b, count in bins:  # whole bins, so that nothing is sorted; the rest is joined
            if total + count > most:
                break
            total, least = total + count, b
        top = good.filter(F.col("bin") >= (1 << 20 if least is None else least)).select("h", "n", "ids").toArrow().combine_chunks()
        h, n = (np.asarray(top.column(c)).astype(np.int64) if top.num_rows else np.zeros(0, np.int64) for c in ("h", "n"))
        order = np.lexsort((h, -n))
        lists = top.column("ids").combine_chunks().take(pa.array(order)) if top.num_rows else pa.array([], pa.list_(pa.int32()))
        self.ids = np.asarray(lists.flatten()).astype(np.int32)
        self.off = np.asarray(lists.offsets).astype(np.int32) - np.int32(lists.offsets[0].as_py() if len(lists) else 0)
        h = h[order].view(np.uint64)
        by_hash = np.argsort(h)
        self.h, self.rank = h[by_hash], by_hash.astype(np.int32)
        self.shift = U(64 - max(1, int(len(h)).bit_length()))
        self.lead = np.searchsorted(self.h, np.arange(1 << int(64 - self.shift), dtype=np.uint64) << self.shift).astype(np.int32)

    def ranks(self, h: np.ndarray) -> np.ndarray:
        """The rank of each hash, -1 if it isn't here."""
        out = np.full(len(h), -1, np.int64)
        if not len(self.h):
            return out
        at = self.lead[(h >> self.shift).astype(np.int64)]
        live = np.arange(len(h))
        while len(live):
            live = live[at[live] < len(self.h)]
            have = self.h[at[live]]
            hit = live[have == h[live]]
            out[hit] = self.rank[at[hit]]
            live = live[have < h[live]]
            at[live] += 1
        return out


#: A document as numbers of units: 2 bytes, or LONG and 4 bytes in a list of their own; from REST on they number the document's other units by hash.
LONG, REST = 0xFFFF, 1 << 31


def _numbered(part: pa.RecordBatch, joined: np.ndarray, prefix: bool, head: Head) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text's units the numbers, and n + 1 offsets; the other units' hashes in order, and n + 1 offsets; bytes."""
    t, at, lead = _units(texts_of(part.column("text")), joined, prefix)
    h = xxh64(t.buf, at, np.append(at[1:], t.size) - at)
    rank = head.ranks(h)
    hole = np.flatnonzero(rank < 0)
    own = np.repeat(np.arange(t.n), np.diff(lead))[hole]
    key = h[hole].view(np.int64)
    order = np.lexsort((key, own))
    o, k = own[order], key[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (k[1:] != k[:-1])
    first = np.searchsorted(o[new], np.arange(t.n + 1))
    rank[hole[order]] = REST + np.cumsum(new) - 1 - first[o]
    return rank, lead, k[new], first, np.diff(t.off)


def _assembled(docs: DataFrame, model: Model, head: int, finish, schema: str) -> DataFrame:
    """What ``finish`` makes of the ids of all documents: it takes their doc_ids, flat ids, offsets and bytes, and returns columns of ``schema``."""
    spark = docs.sparkSession
    joined, prefix = model.joined(), model.prefix
    # groups are small and many: keep up to this many of a task in its hash map before sorting
    limit = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "65536")
    try:
        units = shared.stored(encoded_units(docs, model).select("h", "n", F.octet_length("unit").alias("bytes"), "ids"), "units")
    finally:
        spark.conf.set(limit, before)
    table = spark.sparkContext.broadcast(Head(units, head))
    names = [x.split()[0] for x in schema.split(", ")]

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, once = np.unique(np.asarray(batch.column("rid")), return_index=True)
            new = np.zeros(batch.num_rows, bool)
            new[once] = True
            for part in sliced(batch.append_column("new", pa.array(new)), most=PART):
                part = part.filter(part.column("new"))  # parts are copied, not the batch
                _, _, key, first, _ = _numbered(part, joined, prefix, table.value)
                rid = part.column("rid").take(pa.array(np.repeat(np.arange(part.num_rows), np.diff(first))))
                yield pa.RecordBatch.from_arrays([rid, pa.array(key)], ["rid", "h"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in sliced(batch, most=PART):
                number, lead, _, _, size = _numbered(part, joined, prefix, table.value)
                short = np.minimum(number, LONG).astype("<u2")
                long = number[short == LONG].astype("<u4")
                cut = np.concatenate([[0], np.cumsum(short == LONG)])[lead]
                blobs = [z.compress(short[lead[i] : lead[i + 1]].tobytes() + long[cut[i] : cut[i + 1]].tobytes()) for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([part.column("rid"), part.column("doc_id"), pa.array(blobs, pa.binary()), pa.array(np.diff(lead)), pa.array(size)], ["rid", "doc_id", "blob", "n", "n_bytes"])

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for batch in batches:
            for part in sliced(batch, "blob", PACKED):
                n = np.asarray(part.column("n"))
                raw = [z.decompress(x.as_py()) for x in part.column("blob")]
                short = np.concatenate([np.frombuffer(x, "<u2", k) for x, k in zip(raw, n, strict=True)]).astype(np.int64)
                short[short == LONG] = np.concatenate([np.frombuffer(x, "<u4", offset=2 * k) for x, k in zip(raw, n, strict=True)])
                found = part.column("found")
                base = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(found), 0)))])[:-1]
                lists = found.flatten().field("ids")
                off = np.asarray(lists.offsets).astype(np.int64)
                rest = np.flatnonzero(short >= REST)
                own = np.repeat(np.arange(len(n)), n)
                k = short[rest] - REST + base[own[rest]]
                short[rest] = 0
                known = table.value
                start, size = np.zeros(len(short), np.int64), np.zeros(len(short), np.int64)
                if len(known.h):
                    start[:], size[:] = known.off[short], known.off[short + 1] - known.off[short]
                start[rest], size[rest] = len(known.ids) + off[k], off[k + 1] - off[k]
                place = _ragged(start, size)
                far = place >= len(known.ids)
                flat = np.empty(len(place), np.int32)
                flat[~far], flat[far] = known.ids[place[~far]], np.asarray(lists.values)[place[far] - len(known.ids)]
                ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n)])]
                yield pa.RecordBatch.from_arrays(finish(part.column("doc_id"), flat, ends, part.column("n_bytes")), names)

    slim = _plain(docs)
    # all rows of a hash meet in one task, so the second grouping needs no shuffle
    found = slim.select("text", "rid").mapInArrow(shared.lean(others), "rid long, h long").join(units.select("h", "ids").hint("shuffle_merge"), "h")
    found = found.groupBy("rid", "h").agg(F.first("ids").alias("ids")).groupBy(F.col("rid").alias("_r")).agg(F.sort_array(F.collect_list(F.struct("h", "ids"))).alias("found"))
    blobs = slim.mapInArrow(shared.lean(packed), "rid long, doc_id long, blob binary, n long, n_bytes long")
    both = blobs.join(found.hint("shuffle_hash"), F.col("rid") == F.col("_r"), "left").select("doc_id", "blob", "n", "found", "n_bytes")
    return both.mapInArrow(shared.lean(last), schema)


ENCODED = "doc_id long, ids array<int>, n_bytes long"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, text_sha256 string"


def encode(docs: DataFrame, model: Model | None = None, head: int = HEAD) -> DataFrame:
    """ENCODED: the ids of each document, and the bytes of its normalised text."""

    def finish(doc_id, flat, ends, n_bytes):
        return [doc_id, pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat)), n_bytes]

    return _assembled(docs, model or Model.load(), head, finish, ENCODED)


class Speller:
    """Texts of ids."""

    def __init__(self, model: Model):
        raw = [x or b"" for x in model.texts]
        self.size = np.array([len(x) for x in raw], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        self.prefix = model.prefix

    def texts(self, flat: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The bytes of each list of ids, without the space put in front."""
        size = self.size[flat]
        data = self.data[_ragged(self.start[flat], size)].tobytes()
        cut = np.concatenate([[0], np.cumsum(size)])[ends].tolist()
        return [data[a + (self.prefix and data[a : min(a + 1, b)] == b" ") : b] for a, b in zip(cut, cut[1:], strict=False)]


def decode(encoded: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows with ``text``, the text of ``ids`` (null ids: null); bytes that are no UTF-8 are replaced."""
    speller = Speller(model or Model.load())

    @F.pandas_udf("string")
    def text_of(ids):
        flat = np.concatenate([np.zeros(0, np.int64), *(np.asarray(x, np.int64) for x in ids if x is not None)])
        ends = np.concatenate([[0], np.cumsum([0 if x is None else len(x) for x in ids])]).astype(np.int64)
        out = [x.decode("utf-8", "replace") for x in speller.texts(flat, ends)]
        return type(ids)([None if x is None else t for x, t in zip(ids, out, strict=True)], dtype=object)

    return encoded.withColumn("text", text_of("ids"))


def digests(docs: DataFrame, model: Model | None = None, head: int = HEAD) -> DataFrame:
    """DIGESTS of each document: of its ids as little-endian integers of 4 bytes, and of the text decoded from them."""
    model = model or Model.load()
    speller = Speller(model)

    def finish(doc_id, flat, ends, n_bytes):
        data, cut = flat.astype("<i4").tobytes(), (4 * ends).tolist()
        ids = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(cut, cut[1:], strict=False)]
        texts = [hashlib.sha256(x).hexdigest() for x in speller.texts(flat, ends)]
        return [doc_id, pa.array(np.diff(ends)), pa.array(ids, pa.string()), pa.array(texts, pa.string())]

    return _assembled(docs, model, head, finish, DIGESTS)
