"""SimHash near-duplicates by deletion-variant signatures (operator 5).

A fingerprint has 64 bits; bit b is set if it is set in over half of the XXH64
hashes (seed 42) of the document's word shingles.  Two fingerprints that differ
in at most 3 bits have, when cut into two segments, one segment that differs by
at most one bit.  So each distinct fingerprint is indexed under its one-wildcard
segment variants (2 segments x 32 wildcards), variants are joined by equality,
and hits are verified on all 64 bits.

Only distinct fingerprints are joined: copies are one row.  A bucket of a variant
with more than ``bucket`` fingerprints isn't gathered: the rest of its bits is
cut again in the same way, so that its members spread over finer buckets, down
to segments so small that a bucket is bounded by the number of bit patterns.  Within a
bucket only the links of a spanning forest leave the task, never all pairs.
Classes come from repeated minimum propagation over those links: in one task if they are at most ``FEW``, else by
joins (large star and small star) with a checkpoint a round; nothing of this reaches the driver but a count.

Defined cases: a null or empty text has fingerprint zero and links like any other;
fewer words than a shingle give one shingle of all words; repeated rows share a
class; a null doc_id is kept with the class of its fingerprint's smallest
non-null doc_id; an empty table gives an empty result; extra columns are carried by
``keep_one``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .tokens import Texts, load8, lowered, sliced, texts_of, words_of

BITS, RADIUS, SHINGLE, SEED, BUCKET = 64, 3, 3, 42, 8192
#: So many links (16 MiB) are put into classes by one task; more are first made fewer or settled by rounds of joins.
FEW = 1 << 20
U = np.uint64
#: The five primes of XXH64.
P1, P2, P3, P4, P5 = map(U, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U(r)) | (x >> U(64 - r))


def xxh64(buf: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of many byte spans at once; ``buf`` has 16 spare bytes at its end."""
    lane = load8(buf)
    length = length.astype(np.int64)
    lead = [U(x & (1 << 64) - 1) for x in (seed + int(P1) + int(P2), seed + int(P2), seed, seed - int(P1), seed + int(P5))]
    h = np.full(len(start), lead[4], np.uint64)
    pos = start.astype(np.int64).copy()
    end = pos + length
    big = np.flatnonzero(length >= 32)
    if len(big):
        acc = [np.full(len(big), v, np.uint64) for v in lead[:4]]
        live, p = np.arange(len(big)), pos[big]
        while len(live):
            for k in range(4):
                acc[k][live] = _rotl(acc[k][live] + lane[p[live] + 8 * k] * P2, 31) * P1
            p[live] += 32
            live = live[end[big[live]] - p[live] >= 32]
        v = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
        for a in acc:
            v = (v ^ (_rotl(a * P2, 31) * P1)) * P1 + P4
        h[big], pos[big] = v, p
    h += length.astype(np.uint64)
    live = np.flatnonzero(end - pos >= 8)
    while len(live):
        k = _rotl(lane[pos[live]] * P2, 31) * P1
        h[live] = _rotl(h[live] ^ k, 27) * P1 + P4
        pos[live] += 8
        live = live[end[live] - pos[live] >= 8]
    live = np.flatnonzero(end - pos >= 4)
    if len(live):
        h[live] = _rotl(h[live] ^ ((lane[pos[live]] & U(0xFFFFFFFF)) * P1), 23) * P2 + P3
        pos[live] += 4
    live = np.flatnonzero(end > pos)
    while len(live):
        h[live] = _rotl(h[live] ^ (buf[pos[live]].astype(np.uint64) * P5), 11) * P1
        pos[live] += 1
        live = live[end[live] > pos[live]]
    h ^= h >> U(33)
    h *= P2
    h ^= h >> U(29)
    h *= P3
    h ^= h >> U(32)
    return h


#: For each byte, its 8 bits as 8 counters of one byte each.
_SPREAD = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")).view("<u8").ravel().astype(np.uint64)


def majority(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each group of consecutive hashes (``first``: n + 1 offsets) the bits set in over half of them; no hashes: zero."""
    n = np.diff(first)
    some = np.flatnonzero(n)
    out = np.zeros(len(n), np.uint64)
    if not len(some):
        return out
    parts = -(-n[some] // 255)  # counters of a byte hold 255 at most
    lead = np.cumsum(parts) - parts
    within = np.arange(parts.sum()) - np.repeat(lead, parts)
    at = np.repeat(first[some], parts) + 255 * within
    data = h.view(np.uint8).reshape(-1, 8)
    for k in range(8):
        sums = np.add.reduceat(_SPREAD[data[:, k]], at)
        counts = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), lead, axis=0)
        bits = np.packbits(2 * counts > n[some][:, None], axis=1, bitorder="little").ravel()
        out[some] |= bits.astype(np.uint64) << U(8 * k)
    return out


def fingerprints_of(t: Texts, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The fingerprint of each text, A-Z lower-cased."""
    t = lowered(t)
    w = words_of(t)
    n = np.diff(w.first)
    size = w.end - w.start
    # the words again, each followed by one space: a shingle is then one span
    place = np.concatenate([[0], np.cumsum(size + 1)])
    flat = np.full(int(place[-1]) + 16, 32, np.uint8)
    inside = np.zeros(t.size + 1, np.int8)
    np.add.at(inside, w.start, 1)
    np.add.at(inside, w.end, -1)
    source = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    flat[np.arange(len(source)) + np.repeat(np.arange(len(w)), size)] = t.buf[source]
    count = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    first = np.concatenate([[0], np.cumsum(count)])
    own = np.repeat(np.arange(t.n), count)
    lead = np.arange(first[-1]) - first[own] + w.first[own]
    last = np.minimum(lead + shingle, w.first[own + 1])
    return majority(xxh64(flat, place[lead], place[last] - 1 - place[lead], seed), first)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch):
                fp = fingerprints_of(texts_of(part.column("text")), shingle, seed)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def _cut(open_bits: tuple[int, ...], fixed: int) -> list[int]:
    """The one-wildcard variants of both halves of the open bits, as masks of all bits then fixed."""
    half = len(open_bits) // 2
    return [fixed | sum(1 << b for b in seg if b != wild) for seg in (open_bits[:half], open_bits[half:]) for wild in seg]


def _open(mask: int) -> tuple[int, ...]:
    return tuple(b for b in range(BITS) if not mask >> b & 1)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _variants(df: DataFrame) -> DataFrame:
    """(fp, mask, key) of level 0, from rows dealt evenly: each makes 64."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    masks = F.array(*[F.lit(_signed(m)) for m in _cut(tuple(range(BITS)), 0)])
    return df.repartition(n, "fp").select("fp", F.explode(masks).alias("mask")).select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))


def _folded(key, mask, shift):
    """A few mixed bits of a bucket, the same in Spark and in numpy."""
    return key ^ shift(key, 33) ^ shift(mask, 5) ^ shift(mask, 37)


class _Wanted:
    """A bitmap of fixed size of the wanted buckets, to leave most others out before a join."""

    BITS = 26

    def __init__(self, buckets: DataFrame):
        class Bits:
            """Spark columns with numpy's operator."""

            def __init__(self, c):
                self.c = c

            def __xor__(self, other):
                return Bits(self.c.bitwiseXOR(other.c))

        x = _folded(Bits(F.col("key")), Bits(F.col("mask")), lambda v, n: Bits(F.shiftrightunsigned(v.c, n)))
        self.bits = buckets.sparkSession.sparkContext.broadcast(shared.bitmap(buckets.select(x.c.alias("x")), "x", self.BITS))

    def variants(self, fps: DataFrame) -> DataFrame:
        """(fp, mask, key) of level 0 in the buckets that may be wanted."""
        bits, most = self.bits, self.BITS
        first = _cut(tuple(range(BITS)), 0)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                fp = np.asarray(batch.column("fp")).view(np.uint64)
                for m in first:
                    mask = U(m)
                    key = fp & mask
                    hit = shared.in_bitmap(bits.value, _folded(key, mask, lambda v, n: v >> U(n)), most)
                    if hit.any():
                        k = key[hit].view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(fp[hit].view(np.int64)), pa.array(np.full(len(k), _signed(m))), pa.array(k)], ["fp", "mask", "key"])

        return fps.select("fp").mapInArrow(run, "fp long, mask long, key long")


def _finer(df: DataFrame) -> DataFrame:
    """(fp, mask, key) one level finer than those given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            fp, mask = (np.asarray(batch.column(c)) for c in ("fp", "mask"))
            for m in np.unique(mask):
                if m not in known:
                    fixed = int(m) & ((1 << 64) - 1)
                    known[m] = np.array([_signed(x) for x in _cut(_open(fixed), fixed)], np.int64)
                own = fp[mask == m]
                for x in known[m]:
                    yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.full(len(own), x)), pa.array(own & x)], ["fp", "mask", "key"])

    return df.mapInArrow(run, "fp long, mask long, key long")


def _forest(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the pairs within ``radius`` among a bounded bucket; each front meets only those not yet reached."""
    x = fps.view(np.uint64)
    left = np.arange(len(fps))
    a, b = [], []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            reached = []
            for k in range(0, len(front), 64):
                some = front[k : k + 64]
                near = np.bitwise_count(x[some][:, None] ^ x[left][None, :]) <= radius
                hit = near.any(axis=0)
                if hit.any():
                    a.append(fps[some[near[:, hit].argmax(axis=0)]])
                    b.append(fps[left[hit]])
                    reached.append(left[hit])
                    left = left[~hit]
            front = np.concatenate(reached) if reached else front[:0]
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _verified(buckets: DataFrame, radius: int) -> DataFrame:
    """(a, b): links found within buckets (arrays of fingerprints of bounded size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column("fps")
            flat, off = np.asarray(col.flatten()), np.asarray(col.offsets) - col.offsets[0].as_py()
            size = np.diff(off)
            out = [np.zeros((2, 0), np.int64)]
            two = off[:-1][size == 2]
            x, y = flat[two], flat[two + 1]
            ok = np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)) <= radius
            out.append(np.stack([x[ok], y[ok]]))
            for i in np.flatnonzero(size > 2):
                out.append(np.stack(_forest(flat[off[i] : off[i + 1]], radius)))
            link = np.concatenate(out, axis=1)
            link.sort(axis=0)
            link = np.unique(link, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(link[0]), pa.array(link[1])], ["a", "b"])

    return buckets.mapInArrow(run, "a long, b long")


def links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links that connect what all pairs of distinct fingerprints within the radius connect.

    ``fps`` has one column fp of distinct values.  radius is at most 3, so that
    of two segments one differs by at most one bit, at each level.
    """
    if not 0 <= radius <= 3:
        raise ValueError("two segments with one wildcard reach 3 bits at most")
    level, found = _variants(fps), None
    for depth in range(4):
        # one map-side combined pass sizes the buckets and settles those of two
        sized = level.groupBy("mask", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        sized = shared.stored(sized.filter("n > 1"), "simhash-buckets")
        part = sized.filter((F.col("n") == 2) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).select("a", "b")
        # after three cuts at most 6 bits are open, so a bucket has at most 64 fingerprints
        most = bucket if depth < 3 else 1 << BITS
        some = sized.filter((F.col("n") > 2) & (F.col("n") <= F.lit(min(most, (1 << 63) - 1)))).select("mask", "key")
        hot = sized.filter(F.col("n") > F.lit(min(most, (1 << 63) - 1))).select("mask", "key")
        if some.head(1):
            rows = level if depth else _Wanted(some).variants(fps)
            grouped = rows.join(some, ["mask", "key"], "left_semi").groupBy("mask", "key").agg(F.collect_list("fp").alias("fps"))
            part = part.unionByName(_verified(grouped.select("fps"), radius))
        found = part if found is None else found.unionByName(part)
        if not hot.head(1):
            break
        rows = level if depth else _Wanted(hot).variants(fps)
        level = shared.stored(_finer(rows.join(hot, ["mask", "key"], "left_semi").select("fp", "mask").distinct()), "simhash-finer")
    return found.distinct()


def rooted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of links (a, b) that are not the smallest of their class, and that smallest."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    top = np.arange(len(nodes))
    while len(a):
        # only roots move, so what is in one tree stays together
        low = np.minimum(top[a], top[b])
        for x in (top[a], top[b]):
            np.minimum.at(top, x, low)
        while (top[top] != top).any():
            top = top[top]
        open_ = top[a] != top[b]
        a, b = a[open_], b[open_]
    moved = np.flatnonzero(top != np.arange(len(nodes)))
    return nodes[moved], nodes[top[moved]]


def _rooted(edges: DataFrame) -> DataFrame:
    """(node, root) of few enough edges, in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.asarray(x.column("a")), np.asarray(x.column("b"))) for x in batches]
        if held:
            node, root = rooted(*(np.concatenate(x) for x in zip(*held, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "root"])

    return shared.stored(edges.coalesce(1).mapInArrow(run, "node long, root long"), "rooted")


def components(edges: DataFrame, most: int = 200, few: int = FEW) -> DataFrame:
    """(node, root): the smallest node of each node's class, for the nodes of edges (a, b) that are not that smallest one.

    At most ``few`` edges are settled by one task.  More alternate large-star and small-star steps until they are
    that few or nothing changes; each round is written to the shared folder.  A star's centre is met by a join that
    adaptive execution can split, and its minimum is pre-aggregated, so hot centres stay spread out.
    Should ``most`` rounds not be enough, that is an error, never a split class.
    """
    edges = shared.stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "star")
    size, last = edges.count(), None
    for _ in range(most):
        if size <= few:
            return _rooted(edges)
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        # large star: each larger neighbour of u moves to the smallest neighbour of u (or u)
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = both.filter("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a <> b").distinct()
        # small star: u and its smaller neighbours move to the smallest of them
        low = big.groupBy("b").agg(F.min("a").alias("m"))
        moved = big.join(low, "b").select(F.col("m"), F.explode(F.array("a", "b")).alias("v")).filter("m <> v").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        edges = shared.stored(moved, "star")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        if state == last:
            break
        size, last = state[0], state
    else:
        raise RuntimeError(f"classes have not settled after {most} rounds")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def classes(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fp, component_id): the fingerprint and the smallest doc_id of the class of each document."""
    prints = shared.stored(fingerprints(docs, shingle), "simhash-fp")
    own = shared.stored(prints.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "simhash-distinct")
    tree = components(links(own.select("fp"), radius, bucket))
    named = own.join(tree, own["fp"] == tree["node"], "left").select("fp", "n", "low", F.coalesce("root", "fp").alias("root"))
    return shared.spread_join(prints, with_least(named, "fp"), ["fp"], ["_fp"], "n").select("doc_id", "fp", "component_id")


def with_least(named: DataFrame, key: str) -> DataFrame:
    """(_key, n, component_id) from (key, n, low, root): the smallest ``low`` of each root's class; hot keys and hot roots are split."""
    named = shared.stored(named, "classes-named")
    least = shared.stored(named.groupBy(F.col("root").alias("_root")).agg(F.min("low").alias("component_id"), F.count("*").alias("size")), "classes-least")
    found = shared.spread_join(named, least, ["root"], ["_root"], "size")
    return shared.stored(found.select(F.col(key).alias(f"_{key}"), "n", "component_id"), "classes")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """One document of each class, the one with the smallest doc_id; all columns.

    Rows that repeat that doc_id stay as they are.  Rows without a doc_id have
    no place in a class and stay.
    """
    return without(docs, classes(docs, shingle, radius, bucket).filter("doc_id > component_id"))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents whose doc_id is not among those of ``gone``; all columns."""
    name = shared.unused("_gone", docs)
    gone = gone.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone.hint("shuffle_hash"), docs["doc_id"].cast("long") == F.col(name), "left_anti")
