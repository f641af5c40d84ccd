"""Substring deduplication with FM-indexes (operator 1).

A window is 50 consecutive words of one document.  A window's anchor is the
leftmost smallest hash among its 8-word runs, so equal windows have equal
anchors, wherever they stand.  Anchors that only one document has are dropped
early (about one row for each 22 words is shuffled, not one for each word).  Around each shared
anchor a document has its *context*, the at most 92 words of all windows that
could have this anchor; equal contexts are one (the smallest doc_id stands for
them), so groups of copies cost one context.

Contexts are dealt by anchor into shards.  For each shard an FM-index is built over
10-word blocks (in their ten phases); all windows of the shard's contexts are streamed
through it by backward search over the wavelet matrix, five blocks a window.  Windows
whose matching statistic reaches 50 words are reported with the smallest
doc_id among their suffix interval, and those intervals go back to all documents
that have the context.  The contexts of an anchor with more of them than a shard may hold are halved: one half has the
windows with few words left of the anchor, the other those with many.  The words that all windows of a half share (its core)
are its new key, so equal windows stay together; halves whose core only one document has are dropped, equal halves
of one key are one, and keys that still have too many are halved again, down to single windows.  So each halving makes at most two rows
of a row, and what was found goes back from halves to contexts.

Defined cases: null and empty texts have no words; a text with fewer than 50 words
loses nothing; matches within one document don't count; rows that repeat a doc_id are
the same document and don't dedupe each other; a null doc_id is above all others; an
empty table gives an empty result; extra columns are ignored by ``window_dedup``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .fm_index import FMIndex
from .tokens import M1, Texts, grams, hash_spans, mix, sliced, texts_of, words_of

WINDOW, RUN, BLOCK, SHARD = 50, 8, 10, 1024
LAST_ID = (1 << 63) - 1
_ODD = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, at least n of each."""
    if len(_powers.get("up", ())) < n:
        for name, x in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
            base = np.full(max(n, 1 << 16), np.uint64(x))
            base[0] = 1
            _powers[name] = np.cumprod(base)
    return _powers["up"], _powers["down"]


def _leftmost_smallest(g: np.ndarray, span: int) -> np.ndarray:
    """For each place the index of the leftmost smallest value among ``span`` values from there on."""
    at, width = np.arange(len(g)), 1

    def better(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(g[a] <= g[b], a, b)

    while 2 * width <= span:
        at, width = better(at[:-width], at[width:]), 2 * width
    return better(at[: len(at) - (span - width)], at[span - width :]) if span > width else at


def contexts_of(t: Texts) -> tuple:
    """Of each anchor: text, context start and end (words from the text's first), anchor hash, context hash, words of the context before it."""
    w = words_of(t)
    h = hash_spans(t, w.start, w.end, 5)
    n = len(w)
    if n < WINDOW:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64), none
    g = grams(h, RUN)
    at = _leftmost_smallest(g, WINDOW - RUN + 1)
    at = np.unique(at[w.doc[: n - WINDOW + 1] == w.doc[WINDOW - 1 :]])
    doc = w.doc[at]
    start = np.maximum(w.first[doc], at - (WINDOW - RUN))
    end = np.minimum(w.first[doc + 1], at + WINDOW)
    up, down = _power(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(h * up[:n], out=total[1:])
    c = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * M1 + (at - start).astype(np.uint64))
    return doc, start - w.first[doc], end - w.first[doc], g[at], c, at - start


def _narrow(docs: DataFrame) -> DataFrame:
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST_ID)).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tid"))


def _occurrences(slim: DataFrame) -> DataFrame:
    """(a, c, doc_id, tid, pos, size, mid): each anchor of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch):
                doc, start, end, a, c, mid = contexts_of(texts_of(part.column("text")))
                own = pa.array(doc)
                cols = [pa.array(a.view(np.int64)), pa.array(c.view(np.int64)), part.column("doc_id").take(own), part.column("tid").take(own), pa.array(start.astype(np.int32)), pa.array((end - start).astype(np.int32)), pa.array(mid.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, ["a", "c", "doc_id", "tid", "pos", "size", "mid"])

    return slim.mapInArrow(run, "a long, c long, doc_id long, tid long, pos int, size int, mid int")


CONTEXT = "a long, c long, low long, high long, n long, mid int, words binary"


def _with_words(slim: DataFrame, contexts: DataFrame) -> DataFrame:
    """CONTEXT rows: the word hashes (4 bytes each) of each context, cut from the document that stands for it."""
    rep = contexts.select("rep.*", F.struct("a", "c", "low", "high", "n", "rep.pos", "rep.size", "rep.mid").alias("x"))
    wanted = rep.groupBy(F.col("doc_id").alias("_d"), F.col("tid").alias("_t")).agg(F.collect_list("x").alias("wanted"))
    both = slim.join(wanted.hint("shuffle_hash"), (F.col("doc_id") == F.col("_d")) & (F.col("tid") == F.col("_t")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch):
                t = texts_of(part.column("text"))
                w = words_of(t)
                h = hash_spans(t, w.start, w.end, 5).astype(np.uint32)
                x = part.column("wanted")
                doc = np.repeat(np.arange(t.n), np.asarray(pc.list_value_length(x)))
                flat = x.flatten()
                start = np.asarray(flat.field("pos")) + w.first[doc]
                yield _cut(flat, start, h)

    return both.select("text", "wanted").mapInArrow(run, CONTEXT)


def _cut(flat: pa.StructArray, start: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
    size = np.asarray(flat.field("size")).astype(np.int64)
    place = np.concatenate([[0], np.cumsum(size)])
    index = np.arange(place[-1]) - np.repeat(place[:-1] - start, size)
    data = h[index].astype("<u4").tobytes()
    off = (4 * place).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(data)])
    return pa.RecordBatch.from_arrays([*(flat.field(x) for x in ("a", "c", "low", "high", "n", "mid")), words], ["a", "c", "low", "high", "n", "mid", "words"])


def matches_of(words: np.ndarray, off: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of a shard's contexts that the FM-index finds elsewhere: context, start in it, smallest ``low`` of all contexts that have the window.

    A context of several documents (``low`` below ``high``) is elsewhere too, so its windows may be found in itself.
    """
    none = np.zeros(0, np.int64)
    n = len(words)
    if n < WINDOW:
        return none, none, none
    own = np.repeat(np.arange(len(low)), np.diff(off))
    g = grams(words.astype(np.uint64), BLOCK)
    whole = np.flatnonzero(own[: len(g)] == own[BLOCK - 1 :])
    _, symbol_of, count = np.unique(g[whole], return_inverse=True, return_counts=True)
    count[symbol_of[(high > low)[own[whole]]]] += 1
    number = np.where(count > 1, np.cumsum(count > 1), 0)  # blocks of one document and place only can't match: symbol 0
    symbol = np.zeros(n, np.int64)
    symbol[whole] = number[symbol_of]
    rel = np.arange(n) - off[own]
    slots = -(-int(np.diff(off).max()) // BLOCK) + 1
    place = (own * BLOCK + rel % BLOCK) * slots + rel // BLOCK
    dense = np.zeros(len(low) * BLOCK * slots + 1, np.int64)
    dense[place] = symbol
    keep = np.ones(len(dense), bool)
    keep[1:] = (dense[1:] != 0) | (dense[:-1] != 0)
    context = np.repeat(np.arange(len(low)), BLOCK * slots)
    context = np.append(context, len(low) - 1)[keep]
    by_low = np.argsort(low, kind="stable")
    place_of = np.empty(len(low), np.int32)
    place_of[by_low] = np.arange(len(low), dtype=np.int32)
    index = FMIndex(dense[keep], place_of[context])
    at = np.flatnonzero(own[: n - WINDOW + 1] == own[WINDOW - 1 :])
    blocks = WINDOW // BLOCK
    at = at[np.logical_and.reduce([symbol[at + BLOCK * k] > 0 for k in range(blocks)])]
    found, lo, hi = index.match([symbol[at + BLOCK * k] for k in range(blocks)])
    hit = found == blocks
    at, lo, hi = at[hit], lo[hit], hi[hit]
    if not len(at):
        return none, none, none
    return own[at], rel[at], low[by_low[index.least(lo, hi)]]


FOUND = "k long, c long, n long, runs array<struct<start:int,stop:int,low:long>>"


def _by_shard(rows: DataFrame, shard: int, of: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``of`` over shards: rows of whole keys ``k``, together while they are no more than ``shard``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n, last = 0, None
        for batch in batches:
            k = np.asarray(batch.column("k"))
            if not len(k):
                continue
            begin = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
            at = 0
            for b, e in zip(begin.tolist(), [*begin[1:].tolist(), len(k)], strict=True):
                if (b or k[0] != last) and n + e - at > shard and n + b - at:
                    yield from of(pa.Table.from_batches([*held, batch.slice(at, b - at)]))
                    held, n, at = [], 0, b
            held.append(batch.slice(at))
            n, last = n + len(k) - at, k[-1]
        if n:
            yield from of(pa.Table.from_batches(held))

    return rows.repartition("k").sortWithinPartitions("k", "c").mapInArrow(run, schema)


def _words(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The words of all rows, and where each row's begin."""
    col = rows.column("words").combine_chunks()
    size = np.asarray(pc.binary_length(col)).astype(np.int64) // 4
    return np.frombuffer(b"".join(col.to_pylist()), "<u4"), np.concatenate([[0], np.cumsum(size)])


def _searched(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """FOUND: for each context its runs of windows (first and last start) that a document below ``high`` has, with the smallest such; one row a context."""
    words, off = _words(rows)
    low, high = (np.asarray(rows.column(x)) for x in ("low", "high"))
    own, start, least = matches_of(words, off, low, high)
    one = least < high[own]
    own, start, least = own[one], start[one], least[one]
    if not len(own):
        return
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1) | (least[1:] != least[:-1])
    lead = np.flatnonzero(new)
    last = np.append(lead[1:], len(own)) - 1
    context, n = np.unique(own[lead], return_counts=True)
    parts = [pa.array(start[lead].astype(np.int32)), pa.array(start[last].astype(np.int32)), pa.array(least[lead])]
    runs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.StructArray.from_arrays(parts, ["start", "stop", "low"]))
    yield pa.RecordBatch.from_arrays([*(rows.column(x).combine_chunks().take(pa.array(context)) for x in ("k", "c", "n")), runs], ["k", "c", "n", "runs"])


def _halves(contexts: DataFrame) -> DataFrame:
    """Both halves of contexts (k, c, low, high, n, mid, lo, hi, words), with the key and name of the whole as pk and pc, its n as pn, and where in it they begin as off.

    lo and hi are the fewest and most words that the windows of a key have before the anchor; a context at an edge of its text lacks some of them.
    """
    middle = ((F.col("lo") + F.col("hi")) / 2).cast("int")
    ranges = F.explode(F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct((middle + 1).alias("lo"), F.col("hi").alias("hi"))))
    fewest = F.greatest(F.col("r.lo"), F.lit(WINDOW) - (F.octet_length("words") / 4).cast("int") + F.col("mid"))
    each = contexts.withColumn("r", ranges).withColumns({"l": fewest, "h": F.least(F.col("r.hi"), F.col("mid"))}).filter("l <= h")

    def words(before: str, short: str) -> F.Column:
        return F.expr(f"substring(words, 4 * (mid - {before}) + 1, 4 * ({WINDOW} + {short}))")

    key = F.xxhash64("k", "r.lo", "r.hi", words("r.lo", "r.lo - r.hi"))
    own = words("h", "h - l")
    return each.select(
        F.col("k").alias("pk"), F.col("c").alias("pc"), F.col("n").alias("pn"), (F.col("mid") - F.col("h")).alias("off"),
        key.alias("k"), F.xxhash64("h", own).alias("c"), "low", "high", F.col("h").alias("mid"), "r.lo", "r.hi", own.alias("words"),
    )


def _found(contexts: DataFrame, shard: int) -> DataFrame:
    """FOUND of contexts (k, c, low, high, n, mid, lo, hi, words), one row each at most; keys with more than ``shard`` are halved until none has."""
    levels: list[tuple[DataFrame, DataFrame]] = []
    while True:
        hot = contexts.groupBy(F.col("k").alias("_k")).agg(F.count("*").alias("size")).filter(F.col("size") > shard)
        hot = shared.stored(hot, "contexts-hot")
        if not hot.head(1):
            found = shared.stored(_by_shard(contexts, shard, _searched, FOUND), "contexts-found")
            break
        rest = shared.spread_join(contexts, hot, ["k"], ["_k"], "size", "left_anti")
        found = shared.stored(_by_shard(rest, shard, _searched, FOUND), "contexts-found")
        parts = shared.stored(shared.spread_join(contexts, hot, ["k"], ["_k"], "size", "left_semi"), "halves-parts" if levels else "contexts-parts")
        halves = shared.stored(_halves(parts), "contexts-between")
        common = halves.groupBy(F.col("k").alias("_k")).agg(F.min("low").alias("least"), F.max("high").alias("most"), F.count("*").alias("size")).filter("least < most")
        common = shared.stored(common.select("_k", "size"), "halves-common")
        kept = shared.spread_join(halves, common, ["k"], ["_k"], "size", "left_semi")
        firsts = [F.first(x).alias(x) for x in ("mid", "lo", "hi", "words")]
        contexts = kept.groupBy("k", "c").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count("*").alias("n"), *firsts)
        contexts = shared.stored(contexts, "halves")
        levels.append((found, halves.select("pk", "pc", "pn", "off", "k", "c")))
    for own, halves in reversed(levels):
        hits = shared.spread_join(halves, found.withColumnsRenamed({"k": "_k", "c": "_c"}), ["k", "c"], ["_k", "_c"], "n")
        moved = F.transform("runs", lambda x: F.struct((x["start"] + F.col("off")).alias("start"), (x["stop"] + F.col("off")).alias("stop"), x["low"].alias("low")))
        whole = hits.select(F.col("pk").alias("k"), F.col("pc").alias("c"), F.col("pn").alias("n"), moved.alias("runs"))
        whole = whole.groupBy("k", "c").agg(F.first("n").alias("n"), F.flatten(F.collect_list("runs")).alias("runs"))
        found = shared.stored(own.unionByName(whole), "contexts-found")
    return found


def repeated_windows(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """(doc_id, tid, runs): the runs of windows (first and last start word) of a document that a smaller doc_id has too; tid is xxhash64 of the text."""
    slim = _narrow(docs)
    every = shared.stored(_occurrences(slim), "anchors")
    common = every.groupBy(F.col("a").alias("_a")).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"))
    common = shared.stored(common.filter("low < high").select("_a", "n"), "anchors-common")
    own = shared.stored(shared.spread_join(every, common, ["a"], ["_a"], "n", "left_semi"), "anchors-shared")
    contexts = own.groupBy("a", "c").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"), F.min(F.struct("doc_id", "tid", "pos", "size", "mid")).alias("rep"))
    contexts = shared.stored(_with_words(slim, contexts), "contexts")
    whole = contexts.withColumnRenamed("a", "k").withColumns({"lo": F.lit(0), "hi": F.lit(WINDOW - RUN)})
    found = _found(whole, shard).withColumnsRenamed({"k": "_a", "c": "_c"})
    hits = shared.spread_join(own, found, ["a", "c"], ["_a", "_c"], "n")
    earlier = F.filter("runs", lambda x: x["low"] < F.col("doc_id"))
    moved = F.transform(earlier, lambda x: F.struct((x["start"] + F.col("pos")).alias("start"), (x["stop"] + F.col("pos")).alias("stop")))
    hits = hits.select("doc_id", "tid", moved.alias("runs")).filter(F.size("runs") > 0)
    return hits.groupBy("doc_id", "tid").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def window_dedup(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text): each document without the words of repeated windows."""
    return _removed(docs, shard, True).drop("kept_sha256")


def window_digests(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256)."""
    return _removed(docs, shard, False).drop("kept_text")


def _removed(docs: DataFrame, shard: int, texts: bool) -> DataFrame:
    runs = repeated_windows(docs, shard).withColumnsRenamed({"doc_id": "_d", "tid": "_t"})
    slim = _narrow(docs)
    both = slim.join(runs.hint("shuffle_hash"), (F.col("doc_id") == F.col("_d")) & (F.col("tid") == F.col("_t")), "left").select("doc_id", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            runs_of = batch.column("runs")
            for i, text in enumerate(batch.column("text")):
                w = text.as_buffer().to_pybytes().split()  # bytes are split at the six separators
                n = len(w)
                x = runs_of[i].values
                if x is not None:
                    mark = np.zeros(n + 1, np.int64)
                    np.add.at(mark, np.asarray(x.field("start")), 1)
                    np.add.at(mark, np.asarray(x.field("stop")) + WINDOW, -1)
                    w = [w[k] for k in np.flatnonzero(np.cumsum(mark[:-1]) == 0)]
                kept = b" ".join(w)
                out.append((n, n - len(w), hashlib.sha256(kept).hexdigest(), kept.decode() if texts else None))
            a, b, c, d = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string()), pa.array(d, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    out = both.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(LAST_ID)))
