"""Toxicity by compression distance between a toxic and an ordinary zstandard dictionary.

Fitting uses a bounded sample: at most ``SAMPLE`` labelled documents of each class, those of the lowest id hash, read
whole.  Stretches of bytes that are much more frequent (by documents) in one class than in the other are that class's
samples: n-grams of at least ``LEAST`` documents whose log-likelihood ratio is ``SURE`` or more, so that a mark of a small
language or a rare kind counts however small its share of the toxic documents is.  A zstandard dictionary is trained on them, and both get the same second part, trained on ordinary text.  Each
window of ``WORDS`` words is compressed with both, after a run of filler that both dictionaries hold (so short windows
aren't stored raw); the gain is how many bytes shorter the toxic dictionary makes it.  A document's score is a logistic
function of its share of windows with a gain of ``HIT`` bytes or more, of their number and of the best gain, fitted on
features that dictionaries of the other half of the sample gave, and scaled so that the cut with the best F1 on those
features becomes 0.7; ``predict`` compares it with 0.7.

Scoring takes every window of every whole text.  A typical stretch has at least ``GRAM`` bytes; a window that
shares no ``GRAM`` bytes in a row with the class part of the toxic dictionary holds none, and its gain is 0 without
compressing it.  Rows stay in their partitions; the model (two dictionaries of some kB and four numbers) has a fixed size.

Defined results: a null or blank text scores as a text without windows; repeated rows are scored each; null ids are
scored and never learned from; without labels of both classes every score is the share of toxic labels (0 without any);
labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import tokens as T

SAMPLE = 1500
WORDS = 3
GRAM, LEAST, SURE, RATIO = 6, 3, 10.83, 3.0         # SURE: 1 in 1,000 of chi-squared with one degree of freedom
CLASS_BYTES, BASE_BYTES = 16384, 8192
FILLER = b"\x01" * 1000
HIT = 2
LOOK = GRAM                                          # bytes in a row
BITS = 1 << 20
THRESHOLD = 0.7
PLAIN = T.LOWER.copy()
PLAIN[[9, 10, 11, 12, 13]] = 32


def plain(text: str) -> bytes:
    return b" " + b" ".join(PLAIN[np.frombuffer((text or "").encode(), np.uint8)].tobytes().split()) + b" "


def grams(data, k: int) -> np.ndarray:
    a = np.frombuffer(bytes(data) + b"\0" * 8, np.uint8)
    n = max(len(a) - 8 - k + 1, 0)
    return np.ndarray((n,), "<u8", a.data, 0, (1,)) & np.uint64((1 << (8 * k)) - 1)


def frequencies(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct byte n-grams and how many texts have each."""
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.unique(np.concatenate([np.unique(grams(t, GRAM)) for t in texts]), return_counts=True)


def count(table, x: np.ndarray) -> np.ndarray:
    names, n = table
    if not len(names):
        return np.zeros(len(x))
    at = np.minimum(np.searchsorted(names, x), len(names) - 1)
    return np.where(names[at] == x, n[at], 0)


def likelihood_ratio(a: np.ndarray, b: np.ndarray, n: int, m: int) -> np.ndarray:
    """Dunning's G of a of n documents against b of m."""
    def part(k, share, size):
        expect = share * size
        return k * np.log(np.where(k > 0, k, 1) / np.where(k > 0, expect, 1))

    share = (a + b) / (n + m)
    return 2 * (part(a, share, n) + part(n - a, 1 - share, n) + part(b, share, m) + part(m - b, 1 - share, m))


def stretches(texts: list[bytes], own, other, n_own: int, n_other: int, ratio: float) -> list[bytes]:
    """Parts of texts covered by n-grams that are typical of their class."""
    out = []
    for t in texts:
        g = grams(t, GRAM)
        a, b = count(own, g), count(other, g)
        on = ((a >= LEAST) & ((a + 0.5) / (n_own + 1) > ratio * (b + 0.5) / (n_other + 1))
              & (likelihood_ratio(a, b, n_own, n_other) >= SURE))
        at = np.flatnonzero(on)
        if len(at):
            edge = np.zeros(len(t) + 1, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + GRAM, -1)
            inside = np.r_[0, (np.cumsum(edge)[:-1] > 0).astype(np.int8), 0]
            cuts = np.flatnonzero(np.diff(inside))
            out += [t[a:b] for a, b in zip(cuts[::2], cuts[1::2])]
    return out


def dictionary(parts: list[bytes], size: int, k: int) -> bytes:
    """A trained dictionary's bytes; a sample too small to train on is used as it is."""
    random.Random(7).shuffle(parts)
    samples = [b"".join(parts[i:i + 6]) for i in range(0, len(parts), 6)]
    while samples and len(samples) < 3000:
        samples = samples * 2
    try:
        return zs.train_dictionary(size, samples[:60_000], k=k, d=6).as_bytes()
    except zs.ZstdError:
        return b"".join(dict.fromkeys(parts))[:size]


class Compressors:
    """The two compressors and the bitmap of what the toxic class part holds."""

    def __init__(self, parts: tuple[bytes, bytes], base: bytes):
        params = zs.ZstdCompressionParameters(
            window_log=17, min_match=3, strategy=zs.STRATEGY_BTOPT, search_log=7, target_length=64, hash_log=15,
            chain_log=15, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.both = []
        self.holds = np.zeros(BITS, bool)
        self.holds[self.cell(grams(parts[1], LOOK))] = True
        for part in parts:
            d = zs.ZstdCompressionDict(FILLER + part + base, dict_type=zs.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            self.both.append(zs.ZstdCompressor(dict_data=d, compression_params=params))

    @staticmethod
    def cell(g: np.ndarray) -> np.ndarray:
        return ((g * T.K1) >> np.uint64(44)).astype(np.int64)

    def gain(self, window: bytes) -> int:
        ordinary, toxic = self.both
        return len(ordinary.compress(FILLER + window)) - len(toxic.compress(FILLER + window))

    def features(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """(share of hits, log of their number, best gain) of each text."""
        n = len(off) - 1
        w = T.Words(PLAIN[buf] if len(buf) else buf, off)
        out = np.zeros((n, 3))
        if not len(w):
            return out
        words = np.diff(w.first)
        per = -(-words // WORDS)
        doc = np.repeat(np.arange(n), per)
        a = w.first[:-1][doc] + WORDS * (np.arange(len(doc)) - (np.cumsum(per) - per)[doc])
        b = np.minimum(a + WORDS, w.first[1:][doc])
        start, end = w.start[a], w.end[b - 1]
        spaced = np.full(len(buf) + 2, 32, np.uint8)
        spaced[1:-1] = w.buf
        hit = np.r_[0, np.cumsum(self.holds[self.cell(grams(spaced.tobytes(), LOOK))])]
        top = len(hit) - 1                           # the window with a space on each side: spaced[start : end + 2]
        may = hit[np.minimum(np.maximum(end + 2 - LOOK + 1, start), top)] > hit[np.minimum(start, top)]
        raw = w.buf.tobytes()
        gains = np.zeros(len(doc))
        for i in np.flatnonzero(may).tolist():
            gains[i] = self.gain(b" " + raw[start[i]:end[i]] + b" ")
        hits = np.bincount(doc, gains >= HIT, n)
        best = np.zeros(n)
        np.maximum.at(best, doc, gains)
        out[:, 0] = 10 * hits / np.maximum(per, 1)
        out[:, 1] = np.log1p(np.minimum(hits, 20))
        out[:, 2] = np.minimum(best, 12) / 4
        return out

    def of(self, texts: list[str]) -> np.ndarray:
        return self.features(*T.buffers(pa.array(texts, pa.string())))


class Model:
    def __init__(self, parts, base, weight, bias, cut=THRESHOLD):
        self.parts, self.base, self.weight, self.bias, self.cut = parts, base, weight, bias, cut
        self.made = None

    def __getstate__(self):                          # compressors are made anew in each worker
        return {**self.__dict__, "made": None}

    def scores(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        if self.parts is None:
            return np.full(len(off) - 1, self.bias)
        if self.made is None:
            self.made = Compressors(self.parts, self.base)
        p = 1 / (1 + np.exp(-np.clip(self.made.features(buf, off) @ self.weight + self.bias, -30, 30)))
        # the calibrated cut becomes THRESHOLD, the order stays
        return np.where(p < self.cut, THRESHOLD * p / self.cut, THRESHOLD + (1 - THRESHOLD) * (p - self.cut) / (1 - self.cut))


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Newton steps with a small ridge."""
    x1 = np.c_[x, np.ones(len(x))]
    w = np.zeros(x1.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        g = x1.T @ (y - p) - 1e-2 * np.r_[w[:-1], 0]
        h = (x1 * (p * (1 - p))[:, None]).T @ x1 + np.diag(np.r_[np.full(len(w) - 1, 1e-2), 1e-6])
        w = w + np.linalg.solve(h, g)
    return w[:-1], float(w[-1])


def fit(toxic: list[str], ordinary: list[str]) -> Model:
    toxic, ordinary = sorted(set(toxic)), sorted(set(ordinary))
    if len(toxic) < 4 or len(ordinary) < 4:
        n = len(toxic) + len(ordinary)
        return Model(None, None, None, len(toxic) / n if n else 0.0)
    rng = random.Random(11)
    rng.shuffle(toxic)
    rng.shuffle(ordinary)

    def parts_of(tox, ord_):
        t, o = [plain(x) for x in tox], [plain(x) for x in ord_]
        ft, fo = frequencies(t), frequencies(o)
        return (dictionary(stretches(o, fo, ft, len(o), len(t), RATIO / 2), CLASS_BYTES, 16),
                dictionary(stretches(t, ft, fo, len(t), len(o), RATIO), CLASS_BYTES, 16),
                dictionary([x[i:i + 64] for x in o for i in range(0, len(x), 64)][:300_000], BASE_BYTES, 48))

    x, y = [], []
    for k in (0, 1):                                 # dictionaries of one half, features of the other
        *parts, base = parts_of(toxic[k::2], ordinary[k::2])
        made = Compressors(tuple(parts), base)
        x += [made.of(toxic[1 - k::2]), made.of(ordinary[1 - k::2])]
        y += [np.ones(len(x[-2])), np.zeros(len(x[-1]))]
    x, y = np.concatenate(x), np.concatenate(y)
    weight, bias = logistic(x, y)
    *parts, base = parts_of(toxic, ordinary)
    return Model(tuple(parts), base, weight, bias, best_cut(1 / (1 + np.exp(-np.clip(x @ weight + bias, -30, 30))), y))


def best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """The probability from which on F1 is best, half way to the next lower one."""
    order = np.argsort(-p, kind="stable")
    p, hit = p[order], np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(p) + 1) + y.sum())
    f1[:-1][p[1:] == p[:-1]] = -1                    # equal probabilities are on one side
    k = int(f1.argmax())
    return float(np.clip((p[k] + (p[k + 1] if k + 1 < len(p) else p[k])) / 2, 1e-6, 1 - 1e-6))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
          sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents of each class; ``labels`` has the rows to learn from."""
    named = labels.select(F.col(id_col).alias("i"), F.col(label).cast("int").alias("y")).where("i is not null and y in (0, 1)")
    picked = None
    for y in (0, 1):
        one = named.where(F.col("y") == y).distinct().orderBy(F.xxhash64("i"), "i").limit(sample)
        picked = one if picked is None else picked.unionByName(one)
    rows = (docs.select(F.col(id_col).alias("i"), F.col(text).alias("t")).where("t is not null")
            .join(F.broadcast(picked), "i").groupBy("i", "y").agg(F.min("t").alias("t")).collect())
    return fit([r["t"] for r in rows if r["y"] == 1], [r["t"] for r in rows if r["y"] == 0])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text",
            threshold: float = THRESHOLD) -> DataFrame:
    """(id, score, predicted) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for rows in T.slices(batch, text, 2 << 20):
                s = held.value.scores(*T.buffers(rows.column(text)))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(id_col), pa.array(s.astype(float)), pa.array((s >= threshold).astype(np.int32), pa.int32())],
                    names=[id_col, "score", "predicted"])

    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, score double, predicted int")
