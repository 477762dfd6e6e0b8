"""Substring dedup by recompression: remove repeated passages of ``window`` or more words, keep the first.

A window is ``window`` consecutive words of one document; every word covered by a window whose word sequence also starts
earlier (smaller id, or same document and earlier start) is removed.  Windows are judged on the input.

1. *Recompression.*  Each round names runs of equal tokens, then pairs: a hash bit splits all symbols into left and right
   ones, and every left symbol followed by a right one becomes the symbol of the pair.  Names are hashes of the parts, so
   they are global without a dictionary.  ``ROUNDS`` rounds leave symbols of a few words.  Each symbol also carries the
   span of words that decided it (itself, and the neighbours that let it pair or not): two equal windows that hold this
   span whole hold the same symbol there.
2. *Reveal.*  Of the symbols whose span lies inside a window, the one with the smallest name stands for the window; only
   these anchors (one in several words) are sent, one entry per chunk and name, to find the names that occur twice in the
   corpus.  A window with no such symbol stands for itself.
3. *Verify.*  The windows of a repeated anchor, and those alone, are sent under a name of their whole 20 words; each
   bucket picks the earliest start of every name and answers which chunk entries come later.
4. Covered words are marked in the chunk.

A passage that a third of all rows holds costs one entry per chunk and name in steps 2 and 3, so no bucket grows with a
group of copies; buckets follow the size of the input; texts move only inside compressed chunks.

Defined results: a null or blank text has no words and stays as it is; of repeated rows with one id the first in the
chunk numbering counts as earlier; rows with a null id come last; ids are integers; texts shorter than a window lose
nothing.  Names are 64 bits (two unequal windows of a corpus meet with a chance of about n^2 / 2^65).
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import chunks as C
from strata.llm import tokens as T

WINDOW = 20
ROUNDS = 4
FAR = np.iinfo(np.int64).max
EDGE = np.iinfo(np.int32).max                        # of places in a chunk, which fit 32 bits
BASE = 0xD1342543DE82EF95                            # odd, so it has an inverse modulo 2^64
BASE_INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 20), base, np.uint64)
        out[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(out)
    return have[:n]


class Spans:
    """Names of word spans [a, b) in constant time, from prefix sums of a polynomial in word names."""

    def __init__(self, names: np.ndarray):
        self.sums = np.zeros(len(names) + 1, np.uint64)
        np.cumsum(names * powers(BASE, len(names)), out=self.sums[1:])

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        raw = (self.sums[b] - self.sums[a]) * powers(BASE_INVERSE, len(self.sums))[a]
        return T.mix(raw ^ ((b - a).astype(np.uint64) * T.K3))


def recompress(names: np.ndarray, first: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbol names, lo, hi): the deciding span of words of every last-round symbol.

    lo = -1 or hi = EDGE where the edge of the text took part in the decision.
    """
    n = len(names)
    doc = np.repeat(np.arange(len(first) - 1, dtype=np.int32), np.diff(first))
    lo = np.arange(n, dtype=np.int32)
    sym, hi = names, lo + np.int32(1)
    for r in range(rounds):
        if len(sym) < 2:
            break
        if r == 0:                                   # runs: maximal, so both neighbours decide
            new = np.r_[True, (sym[1:] != sym[:-1]) | (doc[1:] != doc[:-1])]
            at = np.flatnonzero(new).astype(np.int32)
            size = np.diff(at, append=np.int32(len(sym)))
            end = at + size - np.int32(1)
            edge_a = np.r_[True, doc[at[1:]] != doc[at[1:] - 1]]
            edge_b = np.r_[doc[end[:-1]] != doc[end[:-1] + 1], True]
            left = np.where(edge_a, np.int32(-1), at - np.int32(1))
            right = np.where(edge_b, np.int32(EDGE), end + np.int32(2))
            sym = np.where(size > 1, T.mix(sym[at] ^ (size.astype(np.uint64) * T.K2)), sym[at])
            lo, hi, doc = left, right, doc[at]
            del new, at, size, end, edge_a, edge_b, left, right
        kind = (T.mix(sym ^ T.U(r * 2 + 1)) & T.U(1)).astype(bool)          # False: left, True: right
        same = doc[1:] == doc[:-1]
        pair = np.r_[~kind[:-1] & kind[1:] & same, False]
        taken = np.r_[False, pair[:-1]]
        # who stays single was decided by the neighbour it could have paired with
        lo2, hi2 = np.where(kind, np.int32(-1), lo), np.where(kind, hi, np.int32(EDGE))
        np.copyto(lo2[1:], lo[:-1], where=kind[1:] & same)
        np.copyto(hi2[1:], hi[:-1], where=kind[1:] & same)
        np.copyto(lo2[:-1], lo[1:], where=~kind[:-1] & same)
        np.copyto(hi2[:-1], hi[1:], where=~kind[:-1] & same)
        np.minimum(lo, lo2, out=lo2)
        np.maximum(hi, hi2, out=hi2)
        p = np.flatnonzero(pair)
        sym2 = sym.copy()
        sym2[p] = T.mix(T.mix(sym[p] * T.K1) + sym[p + 1])
        lo2[p] = np.minimum(lo[p], lo[p + 1])
        hi2[p] = np.maximum(hi[p], hi[p + 1])
        stay = ~taken
        sym, lo, hi, doc = sym2[stay], lo2[stay], hi2[stay], doc[stay]
        del sym2, lo2, hi2
    return sym, lo, hi


def anchors(names: np.ndarray, first: np.ndarray, spans: Spans, window: int, rounds: int):
    """(anchor names, lo, hi, alone): chosen symbols, and starts of the windows that hold no whole symbol."""
    n = len(names)
    starts = window_starts(first, window)
    sym, lo, hi = recompress(names, first, rounds)
    ok = (lo >= 0) & (hi < EDGE)
    sym, lo, hi = sym[ok], lo[ok], hi[ok]
    fit = hi - lo <= window
    sym, lo, hi = sym[fit], lo[fit], hi[fit]
    name = T.mix(spans(lo, hi) ^ sym)
    best = np.full(n + 1, np.iinfo(np.uint64).max, np.uint64)
    for d in range(window):                          # the windows that begin d words before the span
        on = (lo - d >= 0) & (hi - (lo - d) <= window)
        if not on.any():
            break
        np.minimum.at(best, lo[on] - d, name[on])
    has = best != np.iinfo(np.uint64).max
    is_start = np.zeros(n + 1, bool)
    is_start[starts] = True
    chosen = np.zeros(len(name), bool)
    for d in range(window):
        on = np.flatnonzero((lo - d >= 0) & (hi - (lo - d) <= window))
        if not len(on):
            break
        at = lo[on] - d
        chosen[on[is_start[at] & (best[at] == name[on])]] = True
    return name[chosen], lo[chosen], hi[chosen], starts[~has[starts]]


def window_starts(first: np.ndarray, window: int) -> np.ndarray:
    count = np.maximum(np.diff(first) - window + 1, 0)
    return np.repeat(first[:-1] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())


class Texts:
    """Words, names and span names of a chunk."""

    def __init__(self, rows: pa.RecordBatch, text: str):
        self.words = T.Words(*T.buffers(rows.column(text)))
        self.names = self.words.names()
        self.spans = Spans(self.names)


def row_order(rows: pa.RecordBatch, id_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids as integers (nulls last) and the rank of each row among the chunk's rows by (id, place)."""
    ids = rows.column(id_col).cast(pa.int64()).fill_null(FAR).to_numpy(zero_copy_only=False)
    rank = np.empty(len(ids), np.int64)
    rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
    return ids, rank


def window_keys(t: Texts, at: np.ndarray, rank: np.ndarray, window: int):
    """Sorted distinct names of the windows at ``at``, each occurrence's name number, and its earliest occurrence."""
    key, which = np.unique(t.spans(at, at + window), return_inverse=True)
    order = (rank[t.words.doc[at]] << 32) | at
    first = np.full(len(key), FAR)
    np.minimum.at(first, which, order)
    return key, which, order, first


def marks(docs: DataFrame, finish, schema, window: int = WINDOW, rounds: int = ROUNDS, id_col: str = "doc_id",
          text: str = "text") -> DataFrame:
    """``finish(rows, words, removed)`` of every chunk; ``removed`` is a boolean per word."""
    chunks = C.pack(docs, text)
    n_buckets = C.buckets_for(chunks)

    def reveal(chunk, rows):
        t = Texts(rows, text)
        name, *_ = anchors(t.names, t.words.first, t.spans, window, rounds)
        key, count = np.unique(name, return_counts=True)
        if len(key):
            yield C.deal(chunk, n_buckets, key, np.minimum(count, 2).astype(np.uint8))

    def repeated(key, got):
        parts = [C.spread(b) for _, b in got]
        name = np.concatenate([p[0] for p in parts])
        count = np.concatenate([p[1] for p in parts]).astype(np.int64)
        owner = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        order = np.argsort(name, kind="stable")
        cut = np.flatnonzero(np.r_[True, name[order][1:] != name[order][:-1]])
        total = np.add.reduceat(count[order], cut)
        twice = np.zeros(len(name), bool)
        twice[order] = np.repeat(total > 1, np.diff(np.r_[cut, len(name)]))
        yield C.send([key] * len(parts), [c for c, _ in got], [C.squeeze(name[(owner == i) & twice]) for i in range(len(parts))])

    def windows(chunk, rows, got):
        t = Texts(rows, text)
        name, lo, hi, alone = anchors(t.names, t.words.first, t.spans, window, rounds)
        known = [C.spread(b)[0] for _, b in got]
        known = np.sort(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        on = np.zeros(len(name), bool)
        if len(known):
            at = np.minimum(np.searchsorted(known, name), len(known) - 1)
            on = known[at] == name
        cover = np.zeros(len(t.names) + 2, np.int32)  # starts hi - window .. lo of each repeated anchor
        np.add.at(cover, np.maximum(hi[on] - window, 0), 1)
        np.add.at(cover, lo[on] + 1, -1)
        take = np.cumsum(cover)[:len(t.names) + 1] > 0
        take[alone] = True
        del name, lo, hi, on, known, cover, alone    # the anchors' arrays go before the names of windows are sorted
        C.give_back()
        starts = window_starts(t.words.first, window)
        at = starts[take[starts]]
        if len(at):
            ids, rank = row_order(rows, id_col)
            key, which, order, first = window_keys(t, at, rank, window)
            doc = t.words.doc[first & 0xFFFFFFFF]
            yield C.send([-1], [chunk], [C.squeeze(np.diff(at, prepend=0).astype(np.int32))])
            yield C.deal(chunk, n_buckets, key, ids[doc], doc.astype(np.int32))

    def earliest(key, got):
        parts = [C.spread(b) for _, b in got]
        name, ids, doc = (np.concatenate([p[i] for p in parts]) for i in range(3))
        chunk = np.repeat(np.array([c for c, _ in got]), [len(p[0]) for p in parts])
        order = np.lexsort((doc, chunk, ids, name))
        later = np.ones(len(name), bool)
        later[order] = np.r_[False, name[order][1:] == name[order][:-1]]
        ends = np.cumsum([len(p[0]) for p in parts])
        yield C.send([key] * len(parts), [c for c, _ in got],
                     [C.squeeze(x.astype(np.uint8)) for x in np.split(later, ends[:-1])])

    def verdict_of(rows, got):
        """The chunk's words and which of them go; names and windows are let go of before the texts are written."""
        t = Texts(rows, text)
        removed = np.zeros(len(t.words), bool)
        got = sorted(got, key=lambda x: x[0])
        if got and got[0][0] == -1:
            at = np.cumsum(C.spread(got[0][1])[0].astype(np.int64))
            _, rank = row_order(rows, id_col)
            key, which, order, first = window_keys(t, at, rank, window)
            later = np.concatenate([C.spread(b)[0] for _, b in got[1:]]).astype(bool)
            gone = at[later[which] | (order != first[which])]
            edge = np.zeros(len(removed) + 1, np.int64)
            np.add.at(edge, gone, 1)
            np.add.at(edge, gone + window, -1)
            removed = np.cumsum(edge)[:-1] > 0
        return t.words, removed

    def remove(chunk, rows, got):
        words, removed = verdict_of(rows, got)
        C.give_back()
        yield from finish(rows, words, removed)

    answers = C.by_key(C.over_chunks(chunks, reveal, C.SEND), repeated, C.SEND)
    sent = C.write_table(C.back(chunks, answers, windows, C.SEND), "windows")
    verdict = C.by_key(sent.where("key >= 0"), earliest, C.SEND)
    return C.back(chunks, sent.where("key < 0").unionByName(verdict), remove, schema)


def digests(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256): the kept words joined by one space, hashed."""
    kind = docs.schema[id_col].dataType.simpleString()

    def finish(rows, words, removed):
        first = words.first
        n = np.diff(first)
        total = np.r_[0, np.cumsum(removed)]
        gone = total[first[1:]] - total[first[:-1]]
        raw, sha = words.buf.tobytes(), []
        for i in range(rows.num_rows):
            w = raw[words.off[i]:words.off[i + 1]].split()
            if gone[i]:
                w = compress(w, (~removed[first[i]:first[i + 1]]).tolist())
            sha.append(hashlib.sha256(b" ".join(w)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [rows.column(id_col), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())],
            names=[id_col, "n_words", "n_removed", "kept_sha256"])

    return marks(docs.select(id_col, text), finish, f"`{id_col}` {kind}, n_words long, n_removed long, kept_sha256 string",
                 window, id_col=id_col, text=text)


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text: str = "text",
                   chars: str | None = None) -> DataFrame:
    """``docs`` with the removed words (and the space after them) cut from the text; ``chars`` is set to its length."""

    def finish(rows, words, removed):
        if removed.any():
            buf, off, n = words.buf, words.off, rows.num_rows
            at = np.flatnonzero(removed)                 # each goes with what follows it up to the next word or the end
            start, doc = words.start[at], words.doc[at]
            stop = np.minimum(np.append(words.start, len(buf))[at + 1], off[doc + 1])
            cut = np.zeros(len(buf) + 1, np.int8)        # adjoining words cancel, so the running sum is 0 or 1
            np.add.at(cut, start, 1)
            np.add.at(cut, stop, -1)
            np.cumsum(cut, out=cut)
            kept = buf[cut[:-1] == 0]
            ends = off - np.r_[0, np.cumsum(np.bincount(doc, stop - start, n).astype(np.int64))]
            old = rows.column(text)
            valid = old.is_valid() if old.null_count else None
            texts = pa.LargeStringArray.from_buffers(n, pa.py_buffer(ends), pa.py_buffer(kept))
            if valid is not None:
                texts = pc.if_else(valid, texts, None)
            del cut, at, start, stop, doc
            place = rows.schema.get_field_index(text)
            rows = rows.set_column(place, rows.schema.field(text), texts.cast(rows.schema.field(text).type))
            if chars is not None:
                place = rows.schema.get_field_index(chars)
                rows = rows.set_column(place, rows.schema.field(chars), pc.utf8_length(texts).cast(rows.schema.field(chars).type))
        yield rows

    return marks(docs, finish, docs.schema, window, id_col=id_col, text=text)


# DuckDB: every window as text, in order of (doc_id, start); all but the first of equal ones cover their words
ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
o AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS j, unnest(w) AS x, len(w) AS n FROM w),
t AS (SELECT doc_id, j AS i, n, string_agg(x, ' ') OVER (PARTITION BY doc_id ORDER BY j ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS x FROM o),
v AS (SELECT doc_id, i, row_number() OVER (PARTITION BY x ORDER BY doc_id, i) AS k FROM t WHERE i <= n - 19),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM v WHERE k > 1),
g AS (SELECT doc_id, list(j) AS gone FROM c GROUP BY doc_id),
q AS (SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS kept FROM o ANTI JOIN c ON c.doc_id = o.doc_id AND c.j = o.j GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id) LEFT JOIN q USING (doc_id)"""
