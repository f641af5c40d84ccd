"""Near copies by exact similarity on five-word shingles: the near-duplicate stage of the pipeline.

Two documents are near copies if the sets of their ``shingle``-word shingles (A-Z lower-cased,
compared by 64-bit hashes) have a Jaccard similarity of ``percent`` or more.  Fingerprints
that differ in 3 bits (operator 5) tie few such pairs, so candidates come from two sources: the classes
of operator 5, and ``BANDS`` keys of ``ROWS`` minimum hashes each, of which a pair with similarity s
shares at least one with probability 1 - (1 - s^ROWS)^BANDS (0.9998 at 0.8).  All that share a key
are one bucket, and every link is verified on the whole sets.

Equal sets are one row.  In a bucket only pairs of different classes are compared: first
all members are compared with one of them, which settles groups of copies in
linear time.  In buckets whose classes still differ, all pairs are tested inside tasks, block by block of members; only
links that connect different classes leave a task, so no pair is left out and none is emitted for being in a bucket.

Defined cases: fewer words than a shingle give one shingle of all words; texts without words are copies of each
other; repeated rows share a class; rows without a doc_id stay; an empty table gives an
empty result; all columns are carried, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, simhash
from .tokens import M1, Texts, grams, hash_spans, lowered, mix, pair, sliced, texts_of, words_of

SHINGLE, PERCENT, BANDS, ROWS, BLOCK = 5, 80, 16, 4, 512
U = np.uint64
#: One bijection of 64 bits for each minimum hash.
_FLIP = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * M1)
_TIMES = mix(_FLIP + U(1)) | U(1)


def shingle_sets(t: Texts, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text in order, and n + 1 offsets."""
    t = lowered(t)
    w = words_of(t)
    h, n = hash_spans(t, w.start, w.end), np.diff(w.first)
    whole = np.flatnonzero(w.doc[: max(len(w) - shingle + 1, 0)] == w.doc[shingle - 1 :])
    g, doc = grams(h, shingle)[whole], w.doc[whole]
    few = np.flatnonzero((n > 0) & (n < shingle))
    if len(few):
        own = h[w.first[few]]
        for k in range(1, shingle - 1):
            more = n[few] > k
            own[more] = pair(own[more], h[w.first[few[more]] + k])
        g, doc = np.concatenate([g, own]), np.concatenate([doc, few])
    order = np.lexsort((g, doc))
    g, doc = g[order], doc[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    g, doc = g[new], doc[new]
    return g, np.searchsorted(doc, np.arange(t.n + 1)).astype(np.int64)


def _names(g: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each set."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(g + U(1)), dtype=np.uint64)])
    return mix((total[first[1:]] - total[first[:-1]]) ^ (np.diff(first).astype(np.uint64) * M1)).view(np.int64)


def band_keys(g: np.ndarray, first: np.ndarray) -> np.ndarray:
    """BANDS keys of each set, one row a set; an empty set has keys of its own."""
    some = np.flatnonzero(np.diff(first))
    out = np.zeros((len(first) - 1, BANDS), np.uint64)
    for b in range(BANDS):
        key = np.zeros(len(some), np.uint64) + U(b)
        if len(some):
            for k in range(b * ROWS, b * ROWS + ROWS):
                key = pair(key, np.minimum.reduceat((g ^ _FLIP[k]) * _TIMES[k], first[some]))
        out[some, b] = key
    return out.view(np.int64)


def _slim(docs: DataFrame) -> DataFrame:
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tid"))


def _facts(slim: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, tid, sid, fp, bands): the hash of the shingle set, the fingerprint of operator 5 and the keys of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch):
                t = texts_of(part.column("text"))
                g, first = shingle_sets(t, shingle)
                keys = band_keys(g, first)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(t.n + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()))
                fp = pa.array(simhash.fingerprints_of(t).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("tid"), pa.array(_names(g, first)), fp, bands], ["doc_id", "tid", "sid", "fp", "bands"])

    return slim.mapInArrow(run, "doc_id long, tid long, sid long, fp long, bands array<long>")


def _sets(slim: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(sid, grams, small: 4 bytes of each) of the texts with a wanted tid; a bitmap of fixed size leaves most others out before the join."""
    bits = slim.sparkSession.sparkContext.broadcast(shared.bitmap(wanted, "tid"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tid = np.asarray(batch.column("tid")).view(np.uint64)
            _, once = np.unique(tid, return_index=True)
            once = once[shared.in_bitmap(bits.value, tid[once])]
            for part in sliced(batch.take(pa.array(np.sort(once)))):
                g, first = shingle_sets(texts_of(part.column("text")), shingle)
                sets = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(g.view(np.int64)))
                data, cut = g.astype("<u4").tobytes(), (4 * first).tolist()
                small = pa.array([data[a:b] for a, b in zip(cut, cut[1:], strict=False)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(_names(g, first)), sets, small], ["sid", "grams", "small"])

    found = slim.select("text", "tid").mapInArrow(run, "sid long, grams array<long>, small binary")
    return found.join(wanted.select("sid"), "sid", "left_semi").groupBy("sid").agg(F.first("grams").alias("grams"), F.first("small").alias("small"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    left = sets.select(F.col("sid").alias("a"), F.col("grams").alias("x"))
    right = sets.select(F.col("sid").alias("b"), F.col("grams").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("long")
    wide = pairs.join(left, "a").join(right, "b").select("a", "b", both.alias("both"), (F.size("x") + F.size("y")).cast("long").alias("n"))
    return wide.filter(100 * F.col("both") >= percent * (F.col("n") - F.col("both"))).select("a", "b")


def _ordered(a, b) -> list[F.Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def links(slim: DataFrame, own: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, rounds: int = 1) -> DataFrame:
    """(node, root): the classes that verified pairs make, from ``own`` (sid, tid, fp, bands), one row a set."""
    tree = simhash.components(simhash.links(own.select("fp").distinct())).select(F.col("node").alias("fp"), "root")
    shared.collected(slim.sparkSession)
    by_fp = own.select("sid", "fp").join(tree, "fp", "left").select("sid", F.xxhash64(F.lit("fp"), F.coalesce("root", "fp")).alias("key"))
    rows = own.select("sid", F.explode("bands").alias("key")).unionByName(by_fp)
    many = rows.groupBy(F.col("key").alias("_key")).agg(F.min("sid").alias("low"), F.max("sid").alias("high"), F.count("*").alias("n"))
    many = shared.stored(many.filter("low <> high").select("_key", "n"), "near-keys")
    rows = shared.stored(shared.spread_join(rows, many, ["key"], ["_key"], "n", "left_semi"), "near-rows")
    wanted = own.select("sid", "tid").join(rows.select("sid").distinct(), "sid", "left_semi")
    sets = shared.stored(_sets(slim, wanted, shingle), "near-sets")
    shared.collected(slim.sparkSession)
    tested = classes = None
    edges = own.select(F.col("sid").alias("a"), F.col("sid").alias("b")).limit(0)
    for turn in range(rounds + 1):
        named = rows.withColumn("root", F.col("sid")) if classes is None else rows.join(classes, F.col("sid") == F.col("node"), "left").select("sid", "key", F.coalesce("root", "sid").alias("root"))
        first = F.min(F.struct(F.xxhash64("sid", F.lit(turn)), "sid", "root"))
        mixed = named.groupBy(F.col("key").alias("_key")).agg(F.min("root").alias("r0"), F.max("root").alias("r1"), first.alias("c"), F.count("*").alias("n"))
        mixed = shared.stored(mixed.filter("r0 <> r1").select("_key", "n", "c"), "near-mixed")
        if not mixed.head(1):
            break
        if turn < rounds:
            found = shared.spread_join(named, mixed, ["key"], ["_key"], "n").filter(F.col("root") != F.col("c.root"))
            pairs = found.select(*_ordered("sid", "c.sid")).distinct()
            pairs = shared.stored(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "near-pairs")
            tested = pairs if tested is None else tested.unionByName(pairs)
        else:
            pairs = _settled(shared.spread_join(named, mixed.drop("c"), ["key"], ["_key"], "n"), sets, percent).distinct()
        edges = edges.unionByName(shared.stored(_verified(pairs, sets, percent), "near-edges"))
        classes = simhash.components(edges)
        shared.collected(slim.sparkSession)
    return simhash.components(edges) if classes is None else classes


def _settled(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between different roots that members (sid, key, root, n) of a bucket have beyond those that connect the same; tested in the task.

    A bucket is dealt into blocks of some BLOCK members, and each pair of blocks is a task's group, so a group is bounded whatever the
    bucket's size.  Sets are compared by 32 bits of each hash, which can only make them more similar; hits are verified on the whole sets.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("sid"), blocks).cast("int")
    parts = members.select("sid", "root", "key", own.alias("block"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    parts = parts.select("sid", "root", "block", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    parts = parts.join(sets.select("sid", "small"), "sid").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> Iterator[pa.RecordBatch]:
            if sum(x.num_rows for x in held) > 1:
                t = pa.Table.from_batches(held).combine_chunks()
                a, b = block_links(*(t.column(c).to_numpy() for c in ("sid", "root", "block")), t.column("small").to_pylist(), percent)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        last = None
        for batch in batches:
            name = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("key", "i", "j")])
            cut = [0, *(np.flatnonzero((name[:, 1:] != name[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for k, stop in zip(cut, cut[1:], strict=False):
                if stop > k:
                    if last != tuple(name[:, k]):
                        yield from done()
                        held, last = [], tuple(name[:, k])
                    held.append(batch.slice(k, stop - k))
        yield from done()

    return parts.mapInArrow(run, "a long, b long")


def block_links(sid: np.ndarray, root: np.ndarray, block: np.ndarray, small: list[bytes], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the similar pairs of different roots among two blocks' members (of one block: all), lesser sid first."""
    sizes = np.array([len(x) // 4 for x in small])
    hashes = np.frombuffer(b"".join(small), "<u4")
    who = np.repeat(np.arange(len(sid)), sizes)
    _, code, count = np.unique(hashes, return_inverse=True, return_counts=True)
    many = count[code] > 1
    number = np.cumsum(count > 1) - 1
    who, code = who[many], number[code[many]]
    both = np.zeros((len(sid), len(sid)), np.float32)
    order = np.argsort(code, kind="stable")
    who, code = who[order], code[order]
    for low in range(0, int(code[-1]) + 1 if len(code) else 0, 4096):
        f, l = np.searchsorted(code, (low, low + 4096))
        held = np.zeros((len(sid), 4096), np.float32)
        held[who[f:l], code[f:l] - low] = 1
        both += held @ held.T
    near = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    near &= root[:, None] != root[None, :]
    if (block != block[0]).any():
        near &= block[:, None] != block[None, :]
    a, b = np.nonzero(np.triu(near, 1))
    top = {int(r): int(r) for r in np.unique(root)}

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = x = top[top[x]]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(int(root[x])), find(int(root[y]))
        if p != q:
            top[p] = q
            out.append(sorted((int(sid[x]), int(sid[y]))))
    found = np.array(out, np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def classes(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, sid, component_id): the smallest doc_id of the class of each document."""
    slim = _slim(docs)
    facts = shared.stored(_facts(slim, shingle), "near-facts")
    own = facts.groupBy("sid").agg(F.min("doc_id").alias("low"), F.min("tid").alias("tid"), F.min("fp").alias("fp"), F.min("bands").alias("bands"), F.count("*").alias("n"))
    own = shared.stored(own, "near-distinct")
    shared.collected(docs.sparkSession)
    tree = links(slim, own, shingle, percent)
    named = own.join(tree, own["sid"] == tree["node"], "left").select("sid", "n", "low", F.coalesce("root", "sid").alias("root"))
    facts = facts.select("doc_id", "sid")
    return shared.spread_join(facts, simhash.with_least(named, "sid"), ["sid"], ["_sid"], "n").select("doc_id", "sid", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each class, the one with the smallest doc_id; all columns."""
    return simhash.without(docs, classes(docs, shingle, percent).filter("doc_id > component_id"))
