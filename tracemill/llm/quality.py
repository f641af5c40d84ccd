"""Quality rules from compression bands (operator 3).

Zstandard ratios (compressed / raw UTF-8 bytes) of the whole document and of
fixed chunks tell repetitive text (low) from noise (high).  Short texts compress
worse than long ones, so the limits depend on the length: ``BANDS`` has, for each
largest length in bytes, the lowest and highest ratio of a whole document that is
kept; chunks all have the same length and one band, the last is anchored at the text's end so that every byte is
in a chunk, and a document is rejected if more than ``chunk_share`` of its chunks lie outside the band.

Defined cases: null and empty texts have no words and fail the base rules; a
ratio of an empty text is 0; texts shorter than a chunk have no chunks but are judged whole; rows are
judged one by one, so repeated rows get equal verdicts; an empty table gives an
empty result; ``keep_good`` carries all columns whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .tokens import Texts, chars, grams, hash_spans, lines_of, mix, sliced, texts_of, words_of

#: (largest bytes, lowest ratio, highest ratio) of whole documents.  The lowest ratios lie below natural prose of each length
#: (licences, documentation: 0.58 at 300 bytes, 0.39 at 5 KB, 0.33 at 20 KB at the least) and above texts of which half repeats one sentence.
BANDS = (
    (300, 0.42, 0.95), (600, 0.40, 0.85), (1200, 0.37, 0.80), (2500, 0.34, 0.72), (5000, 0.30, 0.66),
    (10_000, 0.27, 0.62), (20_000, 0.25, 0.60), (50_000, 0.25, 0.60), (1 << 62, 0.25, 0.60),
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, ratio double, n_chunks long, n_chunks_out long"


@dataclass(frozen=True)
class Rules:
    """The limits; all documented above."""

    bands: tuple = BANDS
    chunk: int = 1024
    chunk_low: float = 0.35
    chunk_high: float = 0.75
    chunk_share: float = 0.3
    level: int = 3
    min_words: int = 50
    repeat_percent: int = 50


def _sum(x: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def _base(t: Texts) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    w = words_of(t)
    at = chars(t)
    own = mix(np.arange(t.n, dtype=np.uint64) + np.uint64(1))
    repeat = np.zeros(len(w), bool)
    if len(w) > 2:
        whole = np.flatnonzero(w.doc[:-2] == w.doc[2:])
        g = grams(hash_spans(t, w.start, w.end), 3)[whole] ^ own[w.doc[whole]]
        order = np.argsort(g)
        s = g[order]
        same = np.zeros(len(s) + 1, bool)
        same[1:-1] = s[1:] == s[:-1]
        many = whole[order[same[1:] | same[:-1]]]
        for k in range(3):
            repeat[many + k] = True
    lines = lines_of(t)
    full = np.flatnonzero(np.searchsorted(w.start, lines.start) < np.searchsorted(w.start, lines.end))
    h = hash_spans(t, lines.start[full], lines.end[full]) ^ own[lines.doc[full]]
    _, once = np.unique(h, return_index=True)
    n_lines = np.bincount(lines.doc[full], minlength=t.n) - np.bincount(lines.doc[full[once]], minlength=t.n)
    return [np.diff(w.first), _sum(at[w.end] - at[w.start], w.first), _sum(_SYMBOL[t.buf[: t.size]], t.off), n_lines, _sum(repeat, w.first)]


def _bands(t: Texts, r: Rules) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ratio, chunks, chunks outside their band, and whether the document is within all limits."""
    z = zstandard.ZstdCompressor(level=r.level)
    ratio, n, outside = np.zeros(t.n), np.zeros(t.n, np.int64), np.zeros(t.n, np.int64)
    for i in range(t.n):
        raw = t.raw(i)
        if not raw:
            continue
        ratio[i] = len(z.compress(raw)) / len(raw)
        starts = [*range(0, len(raw) - r.chunk + 1, r.chunk)]
        if starts and len(raw) % r.chunk:
            starts.append(len(raw) - r.chunk)
        for k in starts:
            x = len(z.compress(raw[k : k + r.chunk])) / r.chunk
            n[i] += 1
            outside[i] += not r.chunk_low <= x <= r.chunk_high
    limits = np.array(r.bands)
    row = np.searchsorted(limits[:, 0], np.diff(t.off))
    good = (ratio >= limits[row, 1]) & (ratio <= limits[row, 2]) & (outside <= r.chunk_share * n)
    return ratio, n, outside, good


def _verdicts(part: pa.RecordBatch, r: Rules) -> list[np.ndarray]:
    t = texts_of(part.column("text"))
    base = _base(t)
    failed = (base[0] < r.min_words) | (100 * base[4] > r.repeat_percent * base[0])
    ratio, n, outside, good = _bands(t, r)
    return [*base, failed, ~failed & good, ratio, n, outside]


def judge(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """SCHEMA: the base counts, the verdict and the ratios of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch):
                cols = [part.column("doc_id"), *map(pa.array, _verdicts(part, rules))]
                yield pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that are kept, with all their columns."""
    schema = docs.schema
    names = docs.columns
    at = next(i for i, c in enumerate(names) if c == "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slim = pa.RecordBatch.from_arrays([batch.column(at).cast(pa.string()), pa.array(np.arange(batch.num_rows))], ["text", "row"])
            for part in sliced(slim):
                kept = np.flatnonzero(_verdicts(part, rules)[6])
                if len(kept):
                    yield batch.take(part.column("row").take(pa.array(kept)))

    return docs.mapInArrow(run, schema)
