"""Vectorised word and line kernels over Arrow string batches.

All text operators read whole texts.  A word is a run of characters outside
``[\x20\x09-\x0D]``; because these six separators are ASCII, words can be cut on
the UTF-8 bytes of a whole Arrow batch at once, without building a Python
object for each word.  Batches are worked off in slices of bounded size, so the
memory of a worker follows the slice (or one single longer document), never
the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
PAD = 16
U = np.uint64
M1, M2, M3 = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0xD6E8FEB86659FD93)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEEP = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits; works in place on a fresh array."""
    x = x ^ (x >> U(32))
    x *= M3
    x ^= x >> U(29)
    x *= M2
    x ^= x >> U(32)
    return x


def load8(buf: np.ndarray) -> np.ndarray:
    """A view of the little-endian 8 bytes that start at each byte."""
    return np.ndarray((len(buf) - 7,), np.dtype("<u8"), buf.data, 0, (1,))


@dataclass
class Texts:
    """The bytes of some texts one after the other; ``off`` has n + 1 offsets.  ``buf`` ends in PAD zero bytes."""

    buf: np.ndarray
    off: np.ndarray

    @property
    def n(self) -> int:
        return len(self.off) - 1

    @property
    def size(self) -> int:
        return int(self.off[-1])

    def raw(self, i: int) -> bytes:
        return self.buf[self.off[i] : self.off[i + 1]].tobytes()


def texts_of(column: pa.Array) -> Texts:
    """Bytes and offsets of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offs, data = column.buffers()
    off = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    size = int(off[-1] - off[0])
    buf = np.zeros(size + PAD, np.uint8)
    if size:
        buf[:size] = np.frombuffer(data, np.uint8)[off[0] : off[-1]]
    return Texts(buf, off - off[0])


def sliced(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with at most ``most`` bytes of text each, or one row."""
    if not batch.num_rows:
        return
    lens = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    part = np.cumsum(lens) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


@dataclass
class Spans:
    """Byte spans (words, lines) in order; ``doc`` is each span's text, ``first`` the index of each text's first span (n + 1 long)."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)


def _spans(t: Texts, start: np.ndarray, end: np.ndarray) -> Spans:
    first = np.searchsorted(start, t.off).astype(np.int64)
    first[-1] = len(start)
    doc = np.repeat(np.arange(t.n), np.diff(first))
    return Spans(start, end, doc, first)


def words_of(t: Texts) -> Spans:
    """Maximal runs of bytes outside the six separators, cut at the ends of texts."""
    size = t.size
    word = ~_SPACE[t.buf[:size]]
    edge = np.empty(size + 1, bool)
    edge[0], edge[size] = size > 0 and word[0], size > 0 and word[-1]
    if size:
        np.not_equal(word[1:], word[:-1], out=edge[1:size])
    inner = t.off[1:-1]
    inner = inner[(inner > 0) & (inner < size)]
    inner = np.unique(inner[word[inner] & word[inner - 1]]) if len(inner) else inner
    at = np.flatnonzero(edge)
    start, end = at[::2], at[1::2]
    if len(inner):  # a word never runs on into the next text
        start, end = np.sort(np.concatenate([start, inner])), np.sort(np.concatenate([end, inner]))
    return _spans(t, start, end)


def lines_of(t: Texts) -> Spans:
    """The texts split at \\n; an empty text has one empty line."""
    nl = np.flatnonzero(t.buf[: t.size] == 10)
    doc = np.concatenate([np.arange(t.n), np.searchsorted(t.off, nl, "right") - 1])
    start = np.concatenate([t.off[:-1], nl + 1])
    order = np.lexsort((start, doc))
    start, doc = start[order], doc[order]
    first = np.searchsorted(doc, np.arange(t.n + 1)).astype(np.int64)
    end = np.empty(len(start), np.int64)
    end[:-1] = start[1:] - 1
    last = first[1:] - 1
    end[last] = t.off[1:]
    return Spans(start, end, doc, first)


def stripped(t: Texts, s: Spans) -> Spans:
    """The spans without separators at either end."""
    start, end = s.start.copy(), s.end.copy()
    left = np.flatnonzero((start < end) & _SPACE[t.buf[start]])
    right = np.flatnonzero((start < end) & _SPACE[t.buf[end - 1]])
    for _ in range(16):  # few spans have more
        start[left] += 1
        left = left[(start[left] < end[left]) & _SPACE[t.buf[start[left]]]]
        end[right] -= 1
        right = right[(start[right] < end[right]) & _SPACE[t.buf[end[right] - 1]]]
        if not len(left) and not len(right):
            break
    else:
        word = np.flatnonzero(~_SPACE[t.buf[: t.size]])
        word = np.append(word, t.size)
        start[left] = np.minimum(word[np.searchsorted(word, start[left])], end[left])
        before = np.searchsorted(word, end[right]) - 1
        end[right] = np.where(before >= 0, word[before] + 1, 0)
    return Spans(start, np.maximum(start, end), s.doc, s.first)


def lowered(t: Texts) -> Texts:
    """A-Z as a-z; all other characters unchanged."""
    return Texts(_LOWER[t.buf], t.off)


def hash_spans(t: Texts, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, 8 bytes a round."""
    lane, length = load8(t.buf), end - start
    h = mix(length.astype(np.uint64) * M1 + U(seed))
    if not len(h):
        return h
    h = mix(h * M1 + (lane[start] & _KEEP[np.minimum(length, 8)]))
    live, k = np.flatnonzero(length > 8), 8
    while len(live):
        left = length[live] - k
        h[live] = mix(h[live] * M1 + (lane[start[live] + k] & _KEEP[np.minimum(left, 8)]))
        live, k = live[left > 8], k + 8
    return h


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """An ordered combination of two hashes."""
    return mix(a * M1 + b * M2 + M3)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive word hashes (len(h) - n + 1 of them), by doubling; runs across texts are not left out."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    power, width, done, have = h, 1, None, 0
    while True:
        if n & width:
            done, have = (power, width) if done is None else (pair(done[: len(h) - have - width + 1], power[have:]), have + width)
        width *= 2
        if width > n:
            return done
        power = pair(power[: len(power) - width // 2], power[width // 2 :])


def chars(t: Texts) -> np.ndarray:
    """The number of code points before each byte (size + 1 long)."""
    out = np.zeros(t.size + 1, np.int64)
    np.cumsum((t.buf[: t.size] & 0xC0) != 0x80, out=out[1:])
    return out


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
