"""Language identification with a string kernel.

The blended-spectrum presence kernel of two texts is the mean, over orders n = 1..``ORDERS``, of the number of character
n-grams both have, divided by the geometric mean of their numbers of distinct n-grams.  ``LANDMARKS`` texts per language
span a Nyström feature space; one kernel ridge regression per language (one against the rest) is solved in it.

Fitting uses a bounded sample: per language the ``SAMPLE`` labelled documents of the lowest id hash, read whole.  Scoring
covers every document: a batch's n-gram presence is one matrix, and because the kernel is a scalar product of presence
vectors, the products with the landmarks and with the regression fold into one matrix (buckets x languages) per order,
so a batch is scored by one matrix product per order.  N-grams are hashed to ``BUCKETS`` buckets.  Rows stay in their
partition; the model has a fixed size of ``ORDERS * BUCKETS`` rows; nothing depends on sources or copies.

Defined results: a null text, or one without a letter, is ``und`` with score 0; score is the softmax share of the winning
language, ties go to the language first in order; repeated rows are scored each; null ids are scored and count as not
held out; without any labelled text every result is ``und`` with score 0; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import tokens as T

ORDERS = 3
BUCKETS = 1 << 14
LANDMARKS = 60
SAMPLE = 200
RIDGE = 1e-2
SHARP = 8.0
UND = "und"

_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Of every code point: whether it is a letter, and its lower-case form's class (0 for all others)."""
    if not _LETTER:
        kind = np.zeros(0x110000, bool)
        low = np.zeros(0x110000, np.int64)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                kind[c] = True
                one = ch.lower()
                low[c] = ord(one) if len(one) == 1 else c
        _LETTER.extend([kind, low])
    return _LETTER


def grams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Per order the flat (text, bucket) presence cells as text * BUCKETS + bucket, and whether texts have a letter."""
    kind, low = letters()
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), size)
    is_letter = kind[code]
    c = low[code]                                    # everything that is no letter is one class: a gap
    gap = (c == 0)
    stay = ~(gap & np.r_[False, gap[:-1]] & np.r_[False, doc[1:] == doc[:-1]]) if len(c) else gap
    c, doc = c[stay], doc[stay]
    has = np.bincount(doc[c > 0], minlength=len(texts)) > 0
    out, h = [], c.astype(np.uint64)
    for n in range(1, ORDERS + 1):
        if n > 1:
            h = h[:-1] * T.K1 + c[n - 1:].astype(np.uint64) if len(h) > 1 else h[:0]
        m = len(h)
        inside = doc[:m] == doc[n - 1:n - 1 + m]
        bucket = (T.mix(h[inside] + T.U(n)) & T.U(BUCKETS - 1)).astype(np.int64)
        out.append(doc[:m][inside] * BUCKETS + bucket)
    return out, has, is_letter


def presence(cells: np.ndarray, n: int) -> np.ndarray:
    x = np.zeros(n * BUCKETS, np.float32)
    x[cells] = 1
    return x.reshape(n, BUCKETS)


def unit(x: np.ndarray) -> np.ndarray:
    """Scaled so that a scalar product is the number of shared n-grams over the geometric mean of their numbers."""
    return x / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))


class Kernel:
    def __init__(self, langs: list[str], weight: list[np.ndarray], bias: np.ndarray):
        self.langs, self.weight, self.bias = langs, weight, bias

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cells, has, _ = grams(texts)
        out = np.tile(self.bias, (len(texts), 1))
        for c, w in zip(cells, self.weight):
            out += unit(presence(c, len(texts))) @ w
        return out, has


def fit(texts: list[str], langs: list[str], landmarks: int = LANDMARKS) -> Kernel | None:
    """Nyström features of the first ``landmarks`` texts of each language, then ridge regression one against the rest."""
    names = sorted(set(langs))
    lang = np.array([names.index(x) for x in langs])
    cells, has, _ = grams(texts)
    use = np.flatnonzero(has)
    if len(use) == 0:
        return None
    x = [unit(presence(c, len(texts)))[use] for c in cells]
    lang = lang[use]
    mark = np.concatenate([np.flatnonzero(lang == k)[:landmarks] for k in range(len(names))])
    kernel = sum(a @ a[mark].T for a in x).astype(np.float64) / ORDERS          # texts x landmarks
    values, vectors = np.linalg.eigh(kernel[mark])
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])                              # K_mm^(-1/2)
    z = kernel @ root
    y = np.where(lang[:, None] == np.arange(len(names)), 1.0, -1.0)
    weight = np.array([1.0 / max((lang == k).sum(), 1) for k in range(len(names))])[lang][:, None]
    mean, bias = (z * weight).sum(0) / weight.sum(), (y * weight).sum(0) / weight.sum()
    zc, yc = z - mean, y - bias
    beta = np.linalg.solve((zc * weight).T @ zc + RIDGE * np.eye(z.shape[1]) * weight.sum() / len(z), (zc * weight).T @ yc)
    alpha = root @ beta / ORDERS                                                 # landmarks x languages
    return Kernel(names, [(a[mark].T @ alpha).astype(np.float32) for a in x], bias - mean @ beta)


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
          sample: int = SAMPLE) -> Kernel | None:
    """Fit on at most ``sample`` documents per language, the lowest by hash of the id."""
    from pyspark.sql import Window
    named = docs.select(F.col(id_col).alias("i"), F.col(lang).alias("l")).where("l is not null and i is not null").distinct()
    rank = F.row_number().over(Window.partitionBy("l").orderBy(F.xxhash64("i"), "i"))
    ids = named.withColumn("r", rank).where(F.col("r") <= sample).select("i", "l")
    rows = (docs.select(F.col(id_col).alias("i"), F.col(lang).alias("l"), F.col(text).alias("t")).where("t is not null")
            .join(F.broadcast(ids), ["i", "l"]).groupBy("i", "l").agg(F.min("t").alias("t")))
    got = sorted(rows.collect(), key=lambda r: (r["l"], r["i"]))
    return fit([r["t"] for r in got], [r["l"] for r in got]) if got else None


def predict(docs: DataFrame, model: Kernel | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for batch in batches:
            for rows in T.slices(batch, text, 2 << 20, 256):
                texts = [t or "" for t in rows.column(text).to_pylist()]
                pred, score = [UND] * len(texts), np.zeros(len(texts))
                if m is not None:
                    s, has = m.scores(texts)
                    e = np.exp(SHARP * (s - s.max(1, keepdims=True)))
                    best = s.argmax(1)
                    share = (e / e.sum(1, keepdims=True))[np.arange(len(texts)), best]
                    pred = [m.langs[b] if h else UND for b, h in zip(best, has)]
                    score = np.where(has, share, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(id_col), pa.array(pred, pa.string()), pa.array(score.astype(float))],
                    names=[id_col, "lang_pred", "score"])

    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")


def remainder(id_col, n: int):
    """crc32 of the id's decimal text, modulo n."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))
