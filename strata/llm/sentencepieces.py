"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The model file gives pieces and scores; encoding is done here on flat numpy arrays.  A batch of texts is cut at the
places no piece can span (before a space that follows a non-space, and around characters found in no longer piece), and
equal segments are encoded once.  All segments of a batch are then merged together: each round takes, per segment, the
best-scored adjacent pair (leftmost on ties), merges it, drops the swallowed symbols and looks up only the two pairs that
changed; segments without a mergeable pair leave the arrays.  Taking one pair per segment and round is what makes the
result exact for any scores.  Symbols outside the vocabulary become byte pieces.  ``decode_ids`` undoes it: pieces to
bytes, meta symbol to space, the first space dropped, bytes that aren't UTF-8 replaced.

Rows never leave their partition, so there is nothing to skew; the model (bounded by its vocabulary) is read once per
Python worker, from the path on the executors or, for a path only Spark can read, from the bytes the driver loaded.

Defined results: a null text is encoded as an empty one; an empty text has the end id only and decodes to an empty text;
each repeated row is encoded; ids of documents may be null or repeated; other columns are not touched.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm import tokens as T
from strata.session import small_batches

META = "▁"
SLICE = 1 << 20                                     # of text; its symbols take some 130 bytes a byte while they are merged
NONE = np.iinfo(np.int32).max
LONG = 512                                          # symbols; longer segments are merged with a heap instead


class Model:
    """Tables of a BPE model with byte fallback, identity normaliser and dummy prefix (others are refused)."""

    def __init__(self, data: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb
        m = pb.ModelProto()
        m.ParseFromString(data)
        spec = m.normalizer_spec
        if m.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces \
                or not spec.add_dummy_prefix or not m.trainer_spec.byte_fallback:
            raise ValueError("only BPE models with identity normaliser, dummy prefix and byte fallback")
        self.eos = m.trainer_spec.eos_id
        self.unk = m.trainer_spec.unk_id
        normal = {p.piece: i for i, p in enumerate(m.pieces) if p.type in (1, 4, 5)}
        if any(p.type == 4 for p in m.pieces):
            raise ValueError("user-defined pieces are not supported")
        self.byte_id = np.zeros(256, np.int64)
        self.bytes_of: list[bytes] = []
        for i, p in enumerate(m.pieces):
            if p.type == 6:
                self.byte_id[int(p.piece[3:5], 16)] = i
            self.bytes_of.append(bytes([int(p.piece[3:5], 16)]) if p.type == 6 else
                                 b"" if p.type == 3 else " ⁇ ".encode() if p.type == 2 else
                                 p.piece.replace(META, " ").encode())
        self.is_byte = np.array([p.type == 6 for p in m.pieces])
        n = len(m.pieces)
        score = np.array([p.score for p in m.pieces])
        levels = {s: r for r, s in enumerate(sorted(set(score.tolist()), reverse=True))}
        rank = np.array([levels[s] for s in score.tolist()])
        # symbols: pieces, then single characters inside pieces that are no pieces themselves
        self.symbol = {p: i for p, i in normal.items() if len(p) == 1}
        inner = set()
        for p in normal:
            if len(p) > 1:
                inner.update(p)
                if any(b == META and a != META for a, b in zip(p, p[1:])):
                    raise ValueError("pieces that span a word start are not supported")
        for c in sorted(inner - set(self.symbol)):
            self.symbol[c] = n
            n += 1
        self.n = n
        rows = []
        for p, i in normal.items():
            for k in range(1, len(p)):
                a = self.symbol.get(p[:k]) if k == 1 else normal.get(p[:k])
                b = self.symbol.get(p[k:]) if len(p) - k == 1 else normal.get(p[k:])
                if a is not None and b is not None:
                    rows.append((a * (1 << 20) + b, i))
        rows.sort()
        self.pair = np.array([r[0] for r in rows], np.int64)
        self.made = np.array([r[1] for r in rows], np.int64)
        self.rank = rank[self.made].astype(np.int32)
        # a first filter for lookups: one bit per hash of a pair
        self.bloom = np.zeros(1 << 22, bool)
        self.bloom[self._hash(self.pair)] = True
        self.sym_of_char = np.full(0x110000, -1, np.int32)
        self.lone = np.ones(0x110000, bool)         # found in no longer piece
        for c, i in self.symbol.items():
            self.sym_of_char[ord(c)] = i
        for c in inner:
            self.lone[ord(c)] = False
        self.sym_of_char[32] = self.sym_of_char[ord(META)]
        self.lone[32] = self.lone[ord(META)]

    @staticmethod
    def _hash(pair):
        return ((pair.astype(np.uint64) * T.K1) >> np.uint64(42)).astype(np.int64)

    def look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece made by adjacent symbols; rank NONE where nothing is."""
        rank, made = np.full(len(a), NONE, np.int32), np.full(len(a), -1, np.int32)
        pair = a.astype(np.int64) * (1 << 20) + b
        may = np.flatnonzero((a >= 0) & (b >= 0) & self.bloom[self._hash(pair)])
        at = np.searchsorted(self.pair, pair[may])
        at[at == len(self.pair)] = 0
        hit = self.pair[at] == pair[may]
        rank[may[hit]], made[may[hit]] = self.rank[at[hit]], self.made[at[hit]]
        return rank, made

    def merge(self, sym: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over segments (``first``: n + 1 offsets).  Returns the start of each final symbol among the
        input symbols and the final symbols, in order."""
        n = len(sym)
        seg = np.repeat(np.arange(len(first) - 1, dtype=np.int32), np.diff(first))
        done_at, done_sym = [], []
        long_ = np.flatnonzero(np.diff(first) > LONG)
        for s in long_:
            at, out = self._merge_one(sym[first[s]:first[s + 1]])
            done_at.append(at + first[s])
            done_sym.append(out)
        live = ~np.isin(seg, long_) if len(long_) else np.ones(n, bool)
        at, cur, seg = np.flatnonzero(live).astype(np.int32), sym[live].astype(np.int32), seg[live]
        del live
        rank = np.full(len(cur), NONE, np.int32)
        made = np.full(len(cur), -1, np.int32)
        if len(cur):
            inside = np.flatnonzero(seg[1:] == seg[:-1])
            rank[inside], made[inside] = self.look(cur[inside], cur[inside + 1])
        while len(cur):
            cut = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
            best = np.minimum.reduceat(rank, cut)
            size = np.diff(np.r_[cut, len(cur)])
            open_ = best < NONE
            if not open_.all():                      # finished segments leave
                out = np.repeat(~open_, size)
                done_at.append(at[out])
                done_sym.append(cur[out])
                at, cur, seg, rank, made = at[~out], cur[~out], seg[~out], rank[~out], made[~out]
                if not len(cur):
                    break
                best, size = best[open_], size[open_]
            hit = np.flatnonzero(rank == np.repeat(best, size))
            hit = hit[np.r_[True, seg[hit[1:]] != seg[hit[:-1]]]]
            cur[hit] = made[hit]
            gone = np.zeros(len(cur), bool)
            gone[hit + 1] = True
            stay = ~gone
            moved = np.cumsum(stay, dtype=np.int32) - np.int32(1)
            at, cur, seg, rank, made = at[stay], cur[stay], seg[stay], rank[stay], made[stay]
            spot = moved[hit]
            rank[spot], made[spot] = NONE, -1
            for p in (spot[spot + 1 < len(cur)], spot[spot > 0] - 1):
                p = p[seg[p] == seg[p + 1]]
                rank[p], made[p] = self.look(cur[p], cur[p + 1])
        if not done_at:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        at, out = np.concatenate(done_at), np.concatenate(done_sym)
        order = np.argsort(at, kind="stable")
        return at[order], out[order]

    def _merge_one(self, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One long segment: the same order of merges from a heap over a linked list."""
        import heapq
        cur, n = sym.tolist(), len(sym)
        left, right = list(range(-1, n - 1)), list(range(1, n)) + [-1]
        rank, made = self.look(sym[:-1], sym[1:])
        heap = [(int(rank[i]), i, int(made[i]), cur[i], cur[i + 1]) for i in np.flatnonzero(rank < NONE)]
        heapq.heapify(heap)
        alive = [True] * n

        def offer(i):
            j = right[i]
            r, m = self.look(np.array([cur[i]]), np.array([cur[j]]))
            if r[0] < NONE:
                heapq.heappush(heap, (int(r[0]), i, int(m[0]), cur[i], cur[j]))

        while heap:
            _, i, m, a, b = heapq.heappop(heap)
            j = right[i] if alive[i] else -1
            if j < 0 or cur[i] != a or cur[j] != b:
                continue
            cur[i], alive[j], right[i] = m, False, right[j]
            if right[j] >= 0:
                left[right[j]] = i
                offer(i)
            if left[i] >= 0:
                offer(left[i])
        at = np.flatnonzero(alive)
        return at, np.array(cur)[at]

    def segments(self, code: np.ndarray, off: np.ndarray) -> np.ndarray:
        """First characters of segments; ``code`` has the code points of all texts, dummy spaces included."""
        space = (code == 32) | (code == ord(META))
        lone = self.lone[code]
        cut = np.ones(len(code), bool)
        cut[1:] = lone[1:] | lone[:-1] | (space[1:] & ~space[:-1])
        cut[off[off < len(code)]] = True
        return np.flatnonzero(cut)

    def encode_unique(self, code: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the segments [start, end) of ``code``, flat, and the n + 1 offsets."""
        size = end - start
        first = np.r_[0, np.cumsum(size)]
        place = np.repeat((start - first[:-1]).astype(np.int32), size)
        place += np.arange(first[-1], dtype=np.int32)
        chars = code[place]
        del place
        at, sym = self.merge(self.sym_of_char[chars], first)
        known = (sym >= 0) & (sym < len(self.bytes_of))
        seg = np.searchsorted(first, at, "right") - 1
        if known.all():
            return sym.astype(np.int64), np.searchsorted(seg, np.arange(len(start) + 1))
        count, spelled = np.ones(len(sym), np.int64), {}
        for i in np.flatnonzero(~known):
            c = int(chars[at[i]])
            spelled[i] = self.byte_id[np.frombuffer(chr(32 if c == 32 else c).encode(), np.uint8)]
            count[i] = len(spelled[i])
        to = np.r_[0, np.cumsum(count)]
        ids = np.zeros(to[-1], np.int64)
        ids[to[:-1][known]] = sym[known]
        for i, b in spelled.items():
            ids[to[i]:to[i] + len(b)] = b
        return ids, to[np.searchsorted(seg, np.arange(len(start) + 1))]

    def decode_bytes(self, ids) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def decode_ids(self, ids) -> str:
        """The text of ids: the first space of the first piece is the dummy prefix."""
        ids = [i for i in ids if i != self.eos]
        raw = self.decode_bytes(ids)
        if ids and raw[:1] == b" " and not self.is_byte[ids[0]]:
            raw = raw[1:]
        return utf8(raw)


def utf8(raw: bytes) -> str:
    """Each byte that isn't part of a valid UTF-8 sequence becomes one replacement character."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return "".join("\ufffd" if 0xDC80 <= ord(c) <= 0xDCFF else c for c in raw.decode("utf-8", "surrogateescape"))


_MODELS: dict[str, Model] = {}


def model(path: str, data: bytes | None = None) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model(open(path, "rb").read() if data is None else data)
    return _MODELS[path]


def code_points(rows: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each non-empty one after a dummy space, and the offsets of the texts."""
    texts = [" " + t if t else "" for t in rows.column(text).to_pylist()]
    off = np.r_[0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))]
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), off


def encoded(m: Model, rows: pa.RecordBatch, text: str):
    """Distinct segments' ids and, per text, the numbers of its segments: (ids, id offsets, segment numbers, text offsets)."""
    code, off = code_points(rows, text)
    start = m.segments(code, off)
    end = np.r_[start[1:], len(code)] if len(start) else start
    names = T.span_names(code.view(np.uint8), start * 4, end * 4)
    _, first, which = np.unique(names, return_index=True, return_inverse=True)
    del names
    ids, id_off = m.encode_unique(code, start[first], end[first])
    return ids, id_off, which, np.searchsorted(start, off)


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``ids`` (array<int>, the end id last) of every row."""

    def run(batches):
        for batch in batches:
            for rows in T.slices(batch, text, SLICE):
                m = model(path)
                ids, id_off, which, off = encoded(m, rows, text)
                size = np.diff(id_off)[which]
                total = np.r_[0, np.cumsum(size)]
                flat = ids[np.repeat(id_off[which] - total[:-1], size) + np.arange(total[-1])]
                ends = total[off[1:]] + np.arange(1, len(off))
                out = np.full(len(flat) + rows.num_rows, m.eos, np.int32)
                stay = np.ones(len(out), bool)
                stay[ends - 1] = False
                out[stay] = flat
                col = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(out, pa.int32()))
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in keep], col], names=[*keep, "ids"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, *([text] if text not in keep else [])).mapInArrow(run, f"{fields}, ids array<int>")


def decode(encoded_docs: DataFrame, path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",),
           out: str = "text") -> DataFrame:
    """``keep`` columns and the decoded text of every row; a null list gives an empty text."""

    def run(batches):
        for batch in batches:
            m = model(path)
            texts = [m.decode_ids(x or []) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(texts, pa.string())],
                                             names=[*keep, out])

    fields = ", ".join(f"`{c}` {encoded_docs.schema[c].dataType.simpleString()}" for c in keep)
    return encoded_docs.select(*keep, ids).mapInArrow(run, f"{fields}, `{out}` string")


def digests(docs: DataFrame, path: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row: encode and decode without building the lists as rows.

    The ids of a distinct segment are spelled and decoded once per slice, then joined per text.
    """

    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for rows in T.slices(batch, text, SLICE):
                m = model(path)
                ids, id_off, which, off = encoded(m, rows, text)
                flat, cuts = ids.tolist(), id_off.tolist()
                names = list(map(str, flat))
                spelled, plain = [], []
                for a, b in zip(cuts[:-1], cuts[1:]):
                    spelled.append(" ".join(names[a:b]).encode())
                    plain.append(m.decode_bytes(flat[a:b]))
                size = np.diff(id_off)[which]
                total = np.r_[0, np.cumsum(size)]
                n, h1, h2 = [], [], []
                end = str(m.eos).encode()
                for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
                    w = which[a:b].tolist()
                    n.append(int(total[b] - total[a]) + 1)
                    h1.append(hashlib.sha256(b" ".join([*map(spelled.__getitem__, w), end])).hexdigest())
                    raw = b"".join(map(plain.__getitem__, w))
                    if raw[:1] == b" " and not m.is_byte[flat[cuts[w[0]]]]:
                        raw = raw[1:]
                    h2.append(hashlib.sha256(utf8(raw).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(id_col), pa.array(n, pa.int64()), pa.array(h1, pa.string()), pa.array(h2, pa.string())],
                    names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
