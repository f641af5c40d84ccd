"""Benchmark decontamination by spaced-seed hashing (operator 6).

A window is 13 consecutive words (lower-cased, without punctuation at their ends).  A
spaced seed is a fixed mask over the places of a window; places outside it are ignored,
so two windows that differ only there have equal hashes.  The masks leave out different
places, so changed words in regular or wide steps fall into the places that some mask leaves out.  The hashes of
all windows of the benchmark and of the training documents are joined by equality; each hit is
verified by words around it: the item's tokens are laid beside the document's at the hit's offset, and the
longest run of the alignment in which at most one in ``spacing`` words differs is measured.  A document is
contaminated by an item if such a run covers ``min_words`` words, or the whole item where the item is shorter.

The benchmark's hashes go into a bitmap of fixed size that leaves most document windows out
before the join, so the document side of the join has little more than true hits.  Only documents with
hits are read again; a hot passage is split by the join, and hits of one (document, item, offset) are one row.

Defined cases: null and empty texts have no windows; items with fewer words than a window are matched whole by
a window of their own length, if they have ``min_item`` words, and are left out below that; rows that repeat a document get equal
results; equal items are each reported; a null doc_id or item_id stays null; an empty table on either side gives
no overlaps; ``drop_contaminated`` carries all columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .pii import _terms
from .tokens import M1, M2, Texts, hash_spans, lowered, mix, sliced, texts_of

WINDOW, MIN_ITEM, MIN_WORDS, SPACING = 13, 8, 13, 4
#: Places of a window that each mask leaves out: none, and every step-th from each offset on, so that words changed every 3, 4, 5 (or 7 and more) places apart fall into one of them.
IGNORED = ((), *(tuple(range(offset, WINDOW, step)) for step in (3, 4, 5) for offset in range(step)))


def _hashes(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts (words of punctuation only are left out) and the index of each text's first (n + 1)."""
    t = lowered(t)
    w = _terms(t)
    full = w.end > w.start
    first = np.concatenate([[0], np.cumsum(full)])[w.first]
    return hash_spans(t, w.start[full], w.end[full], 7), first


def _seeds(h: np.ndarray, first: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each mask: hashes of the windows of ``size`` words, and their starts; windows across texts are left out."""
    n = len(h) - size + 1
    if n <= 0:
        return
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(doc[:n] == doc[size - 1 :])
    total = [np.full(len(at), np.uint64((m * 64 + size) * int(M2) & (1 << 64) - 1)) for m in range(len(IGNORED))]
    for k in range(size):
        own = mix(h + np.uint64((k + 1) * int(M1) & (1 << 64) - 1))[at + k]
        for m, ignored in enumerate(IGNORED):
            if k not in ignored:
                total[m] += own
    for x in total:
        yield mix(x), at


def _slim(df: DataFrame, key: str) -> DataFrame:
    text = F.coalesce(df["text"].cast("string"), F.lit(""))
    return df.select(df[key].cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("tid"))


SEEDS = "id long, tid long, h long, pos int"


def _benchmark_seeds(items: DataFrame, min_item: int) -> DataFrame:
    """SEEDS of the items, with ``size`` of the window and the item's word hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch):
                h, first = _hashes(texts_of(part.column("text")))
                for i in range(part.num_rows):
                    own = h[first[i] : first[i + 1]]
                    size = min(WINDOW, len(own))
                    if size < min_item:
                        continue
                    words = own.view(np.int64).tolist()
                    for seeds, at in _seeds(own, np.array([0, len(own)]), size):
                        n = len(at)
                        yield pa.RecordBatch.from_arrays(
                            [part.column(c).take(pa.array(np.full(n, i))) for c in ("id", "tid")]
                            + [pa.array(seeds.view(np.int64)), pa.array(at.astype(np.int32)), pa.array(np.full(n, size, np.int32)), pa.array([words] * n, pa.list_(pa.int64()))],
                            ["id", "tid", "h", "pos", "size", "words"],
                        )

    return items.mapInArrow(run, SEEDS + ", size int, words array<long>")


def _document_seeds(docs: DataFrame, sizes: list[int], bits) -> DataFrame:
    """SEEDS of the documents whose hash the bitmap has; with the hash of the window's place so that repeats can be told."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch):
                h, first = _hashes(texts_of(part.column("text")))
                doc = np.repeat(np.arange(part.num_rows), np.diff(first))
                for size in sizes:
                    for seeds, at in _seeds(h, first, size):
                        hit = shared.in_bitmap(bits.value, seeds)
                        own = at[hit]
                        d = pa.array(doc[own])
                        yield pa.RecordBatch.from_arrays([part.column("id").take(d), part.column("tid").take(d), pa.array(seeds[hit].view(np.int64)), pa.array((own - first[doc[own]]).astype(np.int32))], ["id", "tid", "h", "pos"])

    return docs.mapInArrow(run, SEEDS)


def best_run(same: np.ndarray, spacing: int) -> tuple[int, int]:
    """(length, mismatches) of the longest run that ends with an equal word, in which any two mismatches are at least ``spacing`` places apart."""
    bad = np.flatnonzero(~same).tolist()
    best, n = (0, 0), len(same)
    for k, start in enumerate([0, *(x + 1 for x in bad)]):
        # bad[k:] lie at or after start; the run ends at the second of the next close pair
        stop = next((bad[j] for j in range(k + 1, len(bad)) if bad[j] - bad[j - 1] < spacing), n)
        inner = [x for x in bad[k:] if x < stop]
        while inner and inner[-1] == stop - 1:
            stop = inner.pop()
        if stop - start > best[0]:
            best = (stop - start, len(inner))
    return best


def overlaps(docs: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, spacing: int = SPACING, min_item: int = MIN_ITEM, key: str = "doc_id", item_key: str = "item_id") -> DataFrame:
    """(doc_id, tid, item_id, n_words, n_different, start): verified overlaps, the longest of each document and item; start is a word number of the document."""
    spark = docs.sparkSession
    slim = _slim(docs, key)
    bench = shared.stored(_benchmark_seeds(_slim(items, item_key), min_item), "benchmark-seeds")
    sizes = sorted(r["size"] for r in bench.select("size").distinct().collect())  # at most WINDOW values
    bits = spark.sparkContext.broadcast(shared.bitmap(bench, "h"))
    place = bench.select("h", F.col("id").alias("item_id"), F.col("tid").alias("item_tid"), F.col("pos").alias("item_pos")).distinct()
    hits = _document_seeds(slim, sizes, bits).join(place, "h")
    hits = hits.groupBy("id", "tid", "item_id", "item_tid").agg(F.collect_set(F.col("pos") - F.col("item_pos")).alias("offsets"))
    words = bench.select(F.col("id").alias("_i"), F.col("tid").alias("_t"), "words").dropDuplicates(["_i", "_t"])
    hits = hits.join(words, F.col("item_id").eqNullSafe(F.col("_i")) & (F.col("item_tid") == F.col("_t")))
    mine = hits.groupBy(F.col("id").alias("_d"), F.col("tid").alias("_k")).agg(F.collect_list(F.struct("item_id", "offsets", "words")).alias("hits"))
    both = slim.join(mine.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("_d")) & (F.col("tid") == F.col("_k")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch):
                h, first = _hashes(texts_of(part.column("text")))
                rows = []
                for i in range(part.num_rows):
                    own = h[first[i] : first[i + 1]].view(np.int64)
                    x = part.column("hits")[i].values
                    best: dict = {}
                    lists, offsets = x.field("words"), x.field("offsets")
                    for k, item in enumerate(x.field("item_id").to_pylist()):
                        w = np.asarray(lists[k].values)
                        for off in sorted(offsets[k].as_py()):
                            a, b = max(0, off), min(len(own), off + len(w))
                            n, different = best_run(own[a:b] == w[a - off : b - off], spacing)
                            if n >= min(min_words, len(w)) and (n, -different) > best.get(item, (0, 0))[:2]:
                                best[item] = (n, -different, a)
                    rows += [(part.column("id")[i].as_py(), part.column("tid")[i].as_py(), item, n, -d, a) for item, (n, d, a) in best.items()]
                cols = list(zip(*rows, strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "tid", "item_id", "n_words", "n_different", "start"])

    return both.select("id", "tid", "text", "hits").mapInArrow(run, "doc_id long, tid long, item_id long, n_words long, n_different long, start long")


def drop_contaminated(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """The documents without a verified overlap, with all their columns."""
    d, k = shared.unused("_d", docs), shared.unused("_k", docs)
    gone = overlaps(docs, items, **how).select(F.col("doc_id").alias(d), F.col("tid").alias(k)).distinct()
    key = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(gone.hint("shuffle_hash"), docs["doc_id"].cast("long").eqNullSafe(F.col(d)) & (key == F.col(k)), "left_anti")
