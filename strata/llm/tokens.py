"""Whole texts as flat numpy arrays: word spans, 64-bit word names and k-word shingle names.

A text column arrives as Arrow buffers (UTF-8 bytes and offsets) and is never turned into Python strings.  Words are
``[^\\x20\\x09-\\x0D]+``; separators are ASCII, so working on bytes is exact.  A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEPARATORS = np.zeros(256, bool)
SEPARATORS[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
U = np.uint64
PIECE = 1 << 16                                 # words named at a time: what lies between stays small
K1, K2, K3 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)   # odd mixing constants


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    h = (h ^ (h >> U(30))) * K2
    h = (h ^ (h >> U(27))) * K3
    return h ^ (h >> U(31))


def buffers(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n + 1 offsets of a string column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        col = col.chunk(0) if isinstance(col, pa.ChunkedArray) else col
    if col.null_count:
        col = col.fill_null("")
    large = pa.types.is_large_string(col.type)
    _, offsets, data = col.buffers()
    if offsets is None or len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if large else np.int32, len(col) + 1, col.offset * (8 if large else 4))
    off = off.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, text: str, target: int, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of about ``target`` bytes of text; one text is never cut."""
    _, off = buffers(batch.column(text))
    i, n = 0, batch.num_rows
    while i < n:
        j = int(np.searchsorted(off, off[i] + target, "right")) - 1
        j = min(max(j, i + 1), i + rows, n)
        yield batch.slice(i, j - i)
        i = j


class Words:
    """Words of a slice of texts: byte spans, text number and the span of words of each text."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, lower: bool = False):
        self.buf = LOWER[buf] if lower else buf
        self.off = off
        inside = ~SEPARATORS[self.buf] if len(buf) else np.zeros(0, bool)
        before = np.zeros(len(buf) + 1, bool)
        before[1:] = inside
        cuts = off[(off < len(buf))]
        before[cuts] = False
        self.start = np.flatnonzero(inside & ~before[:-1])
        after = np.zeros(len(buf) + 1, bool)
        after[:-1] = inside
        after[off] = False
        self.end = np.flatnonzero(inside & ~after[1:]) + 1
        self.doc = np.searchsorted(off, self.start, "right") - 1
        self.first = np.searchsorted(self.start, off)          # first word of each text, and the total

    def __len__(self) -> int:
        return len(self.start)

    def names(self) -> np.ndarray:
        """A 64-bit name of each word, the same wherever the word stands (eight bytes are read at a time)."""
        return span_names(self.buf, self.start, self.end)


def span_names(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[:len(buf)] = buf
    eight = np.ndarray((len(buf) + 1,), "<u8", padded.data, 0, (1,))
    out = np.empty(len(start), U)
    for i in range(0, len(start), PIECE):
        first, last = start[i:i + PIECE].astype(np.int64), end[i:i + PIECE].astype(np.int64)
        h = mix((last - first).astype(U) * K1 + U(1))
        todo, at = np.arange(len(h)), first
        while len(todo):
            left = last[todo] - at
            block = eight[at]
            short = left < 8
            block[short] &= (U(1) << (left[short].astype(U) * U(8))) - U(1)
            h[todo] = mix((h[todo] ^ block) * K1)
            more = left > 8
            todo, at = todo[more], at[more] + 8
        out[i:i + PIECE] = h
    return out


def shingles(names: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the k-word shingles of each text and the n + 1 offsets of the texts among them.

    A text of fewer than k words, but at least one, has its whole sequence as one shingle.
    """
    count = np.diff(first)
    per = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    off = np.zeros(len(count) + 1, np.int64)
    np.cumsum(per, out=off[1:])
    doc = np.repeat(np.arange(len(count)), per)
    at = first[:-1][doc] + (np.arange(off[-1]) - off[:-1][doc])
    size = np.minimum(count, k)[doc]
    h = mix(size.astype(U) + U(77))
    for i in range(k):
        if (size > i).all():
            h = mix((h ^ names[at + i]) * K1)
        else:
            on = size > i
            h[on] = mix((h[on] ^ names[at[on] + i]) * K1)
    return h, off
