"""LM scoring with a hierarchical Pitman-Yor bigram model.

Each context word has a restaurant; its customers are the words that follow it and its tables are customers of the one
parent restaurant, whose base is uniform over the vocabulary and one unseen word.  Given the parent's probabilities, a
Gibbs sweep seats all customers of a restaurant anew by the Chinese-restaurant rule; the last ``SAMPLES`` of ``SWEEPS``
sweeps are kept, the parent is seated once for each, and the predictive probabilities are averaged over the samples.

Spark does it in packed exchanges (see ``chunks``): words to word buckets (counts, numbers), distinct bigrams to
restaurant buckets (seating), tables back to word buckets (parent), answers back to the chunks (scores).  Everything
gathered is per distinct word or bigram and so grows with the corpus; only totals reach the driver.  A context with more
than ``SPLIT`` customers (a third of all rows may share one) is split by the following word, its tables in the seating
rule are then the part's times the number of parts; the totals used for scores are exact.  Seating more than 64
customers of one dish goes in blocks of a sixteenth of the seated ones with a constant chance per block.

Defined results: a null or blank text is its end token alone; repeated rows are learned and scored each; null ids are
scored and learned from; words never learned get the parent's share for one unseen word; without any training text the
model is that share alone; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import chunks as C
from strata.llm import tokens as T

CHUNK = 6 << 20
SWEEPS, SAMPLES = 4, 2
SPLIT = 1 << 17
DISCOUNT, STRENGTH = 0.75, 1.0                       # context restaurants
TOP_DISCOUNT, TOP_STRENGTH = 0.6, 10.0               # parent
END = T.mix(np.array([0xE0D], np.uint64))[0]


def tokens_of(rows: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Names of all tokens (lower-cased words, then one end per text) and the offsets of the texts."""
    w = T.Words(*T.buffers(rows.column(text)), lower=True)
    n = rows.num_rows
    first = w.first + np.arange(n + 1)
    out = np.full(len(w) + n, END, np.uint64)
    out[np.arange(len(w)) + w.doc] = w.names()
    return out, first


class Chunk:
    """Distinct words and bigrams of a chunk, in the order in which they are sent."""

    def __init__(self, rows: pa.RecordBatch, text: str, held: str):
        names, self.first = tokens_of(rows, text)
        self.key, self.word = np.unique(names, return_inverse=True)
        learn = ~rows.column(held).fill_null(False).to_numpy(zero_copy_only=False)
        self.doc = np.repeat(np.arange(rows.num_rows), np.diff(self.first))
        self.learn = learn[self.doc]
        self.count = np.bincount(self.word[self.learn], minlength=len(self.key))

    def bigrams(self):
        """(context, word) as places in ``key``, training counts, and each token's bigram; texts start after an end."""
        end = int(np.searchsorted(self.key, END))
        before = np.r_[end, self.word[:-1]]
        before[self.first[:-1]] = end
        pair, which = np.unique(before * len(self.key) + self.word, return_inverse=True)
        count = np.bincount(which[self.learn], minlength=len(pair))
        return pair // len(self.key), pair % len(self.key), count, which


def small(x: np.ndarray) -> np.ndarray:
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 256 else np.uint32 if top < 1 << 32 else np.int64)


def restaurant_key(ctx: np.ndarray, word: np.ndarray, ctx_count: np.ndarray) -> np.ndarray:
    parts = -(-ctx_count // SPLIT)
    part = np.where(parts > 1, (T.mix(word.astype(np.uint64)) % np.maximum(parts, 1).astype(np.uint64)).astype(np.int64), 0)
    return T.mix(T.mix(ctx.astype(np.uint64)) + part.astype(np.uint64))


def seat(rng, count: np.ndarray, new: np.ndarray, discount: float) -> np.ndarray:
    """Tables after seating ``count`` customers of a dish one by one.

    ``new`` is (strength + discount * tables in the restaurant) * the parent's probability of the dish.
    """
    t = np.minimum(count, 1).astype(np.int64)
    live = np.flatnonzero(count > 1)
    seated = 1
    while len(live):
        step = 1 if seated < 64 else seated // 16
        n = np.minimum(step, count[live] - seated)
        chance = new[live] / (np.maximum(seated - discount * t[live], 1e-12) + new[live])
        t[live] += rng.binomial(n, np.clip(chance, 0, 1))
        seated += step
        live = live[count[live] > seated]
    return t


def score(docs: DataFrame, held: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score); ``held`` marks rows not to learn from."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    chunks = C.pack(docs.select(F.col(id_col).alias("id"), F.col(text).alias("t"),
                                F.coalesce(held, F.lit(False)).alias("held")), "t", CHUNK)
    nb = C.buckets_for(chunks)

    def send_words(chunk, rows):
        c = Chunk(rows, "t", "held")
        if len(c.key):
            yield C.deal(chunk, nb, c.key, small(c.count))

    def number(key, got):
        parts = [C.spread(b) for _, b in got]
        names, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        ends = np.cumsum([len(p[0]) for p in parts])[:-1]
        total = np.bincount(which, np.concatenate([p[1] for p in parts]), len(names)).astype(np.int64)
        yield C.send([-1], [-1], [np.array([(total > 0).sum(), total.sum()], np.int64).tobytes()])
        yield C.send([key] * len(parts), [c for c, _ in got],
                     [C.squeeze(small(total[w]), np.diff(w, prepend=0).astype(np.int32)) for w in np.split(which, ends)])

    def totals(table, n, width=2):
        """Sums of the int64 pairs in the blobs of rows with key ``n``."""
        def run(batches):
            for b in batches:
                for x in b.column("blob").to_pylist():
                    yield pa.RecordBatch.from_arrays([pa.array([list(np.frombuffer(x, np.int64))], pa.list_(pa.int64()))], names=["x"])
        rows = table.where(F.col("key") == n).select("blob").mapInArrow(run, "x array<long>")
        got = rows.agg(*[F.sum(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(width)]).first()
        return [int(v or 0) for v in got]

    def numbered(c, got):
        """Counts and numbers of a chunk's words from the answers of the word buckets."""
        count, ids = [], []
        for key, blob in got:
            n, step = C.spread(blob)
            count.append(n.astype(np.int64))
            ids.append(np.cumsum(step.astype(np.int64)) * nb + key)
        return np.concatenate(count), np.concatenate(ids)

    def restaurants_of(c, count, ids):
        """Bigrams in sending order: place order, bucket keys and columns."""
        ctx, word, n, which = c.bigrams()
        key = restaurant_key(ids[ctx], ids[word], count[ctx])
        bucket = C.bucket_of(key, nb)
        order = np.lexsort((ids[word], ids[ctx], bucket))
        return ctx, word, n, which, key, order

    def send_bigrams(chunk, rows, got):
        c = Chunk(rows, "t", "held")
        if not len(c.key):
            return
        count, ids = numbered(c, sorted(got, key=lambda x: x[0]))
        ctx, word, n, _, key, order = restaurants_of(c, count, ids)
        ctx, word, n = ctx[order], word[order], n[order]
        bucket = C.bucket_of(key[order], nb)
        cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        ends = np.r_[cut[1:], len(bucket)]
        yield C.send([int(bucket[a]) for a in cut], [chunk] * len(cut),
                     [C.squeeze(np.diff(ids[ctx[a:b]], prepend=0), small(ids[word[a:b]]), small(n[a:b]),
                                small(count[word[a:b]]), small(count[ctx[a:b]])) for a, b in zip(cut, ends)])

    def seating(key, got):
        parts = [C.spread(b) for _, b in got]
        ends = np.cumsum([len(p[0]) for p in parts])[:-1]
        ctx = np.concatenate([np.cumsum(p[0]) for p in parts])
        word, n, cw, cc = (np.concatenate([p[i].astype(np.int64) for p in parts]) for i in range(1, 5))
        del parts
        order = np.lexsort((word, ctx))
        new = np.r_[True, (ctx[order][1:] != ctx[order][:-1]) | (word[order][1:] != word[order][:-1])]
        at = order[new]
        dish = np.empty(len(ctx), np.int64)
        dish[order] = np.cumsum(new) - 1
        n = np.bincount(dish, n, len(at)).astype(np.int64)
        ctx, word, base, split = ctx[at], word[at], cw[at] / max(n_train, 1), np.maximum(-(-cc[at] // SPLIT), 1)
        del order, new, at, cw, cc
        C.give_back()
        _, room = np.unique(ctx, return_inverse=True)
        rng = np.random.default_rng([key, 20])
        t, kept = np.minimum(n, 1), []
        for sweep in range(SWEEPS):
            tables = np.bincount(room, t)[room] * split
            t = seat(rng, n, (STRENGTH + DISCOUNT * tables) * base, DISCOUNT)
            if sweep >= SWEEPS - SAMPLES:
                kept.append(t)
        cols = [np.split(small(x)[dish], ends) for x in (n, *kept)]
        yield C.send([nb + key] * len(got), [c for c, _ in got],
                     [C.squeeze(*[small(x[i]) for x in cols]) for i in range(len(got))])
        del cols, dish
        # tables by dish and by context, to the word buckets
        who = np.concatenate([word, ctx])
        names, which = np.unique(who, return_inverse=True)
        sums = [np.bincount(which[:len(word)], x, len(names)).astype(np.int64) for x in kept]
        sums += [np.bincount(which[len(word):], x, len(names)).astype(np.int64) for x in kept]
        to = names % nb
        order = np.argsort(to, kind="stable")
        cut = np.flatnonzero(np.r_[True, to[order][1:] != to[order][:-1]])
        ends = np.r_[cut[1:], len(to)]
        yield C.send([int(to[order[a]]) for a in cut], [-1] * len(cut),
                     [C.squeeze(np.diff(names[order[a:b]] // nb, prepend=0).astype(np.int32),
                                *[small(x[order[a:b]]) for x in sums]) for a, b in zip(cut, ends)])

    def parent(key, got):
        sent = [g for g in got if g[0] >= 0]
        if not sent:
            return
        which = [np.cumsum(C.spread(b)[1].astype(np.int64)) for _, b in sent]       # the numbers this bucket gave out
        ends = np.cumsum([len(w) for w in which])[:-1]
        n = max(int(w[-1]) for w in which) + 1
        which = np.concatenate(which)
        sums = np.zeros((2 * SAMPLES, n), np.int64)
        for c, blob in got:
            if c < 0:
                step, *cols = C.spread(blob)
                at = np.cumsum(step.astype(np.int64))
                for s, col in zip(sums, cols):
                    s[at] += col.astype(np.int64)
        rng = np.random.default_rng([key, 21])
        tops = []
        for s in range(SAMPLES):
            t = np.minimum(sums[s], 1)
            for _ in range(SWEEPS):                  # the bucket is an even share of all words
                t = seat(rng, sums[s], np.full(n, (TOP_STRENGTH + TOP_DISCOUNT * t.sum() * nb) / (n_words + 1)),
                         TOP_DISCOUNT)
            tops.append(t)
        yield C.send([-2], [-1], [np.array([x.sum() for s in range(SAMPLES) for x in (sums[s], tops[s])], np.int64).tobytes()])
        cols = [np.split(x[which], ends) for x in (*sums, *tops)]
        yield C.send([2 * nb + key] * len(sent), [c for c, _ in sent],
                     [C.squeeze(*[small(x[i]) for x in cols]) for i in range(len(sent))])

    counted = C.write_table(C.by_key(C.over_chunks(chunks, send_words, C.SEND), number, C.SEND), "counted")
    n_words, n_train = totals(counted, -1)
    counts = counted.where("key >= 0")
    seated = C.write_table(C.by_key(C.back(chunks, counts, send_bigrams, C.SEND), seating, C.SEND), "seated")
    tops = C.write_table(C.by_key(counts.unionByName(seated.where("chunk < 0")), parent, C.SEND), "parent")
    top = totals(tops, -2, 2 * SAMPLES)

    def finish(chunk, rows, got):
        c = Chunk(rows, "t", "held")
        got = sorted(got, key=lambda x: x[0])
        count, ids = numbered(c, [g for g in got if g[0] < nb])
        ctx, word, _, which, _, order = restaurants_of(c, count, ids)
        pair = [np.concatenate(x).astype(np.float64) for x in zip(*[C.spread(b) for k, b in got if nb <= k < 2 * nb])]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        pair = [x[place] for x in pair]
        each = [np.concatenate(x).astype(np.float64) for x in zip(*[C.spread(b) for k, b in got if k >= 2 * nb])]
        p = np.zeros(len(ctx))
        customers = count[ctx].astype(np.float64)
        for s in range(SAMPLES):
            dish, room, tab = each[s], each[SAMPLES + s], each[2 * SAMPLES + s]
            all_c, all_t = top[2 * s], top[2 * s + 1]
            p0 = (np.maximum(dish - TOP_DISCOUNT * tab, 0)
                  + (TOP_STRENGTH + TOP_DISCOUNT * all_t) / (n_words + 1)) / (TOP_STRENGTH + all_c)
            own = np.maximum(pair[0] - DISCOUNT * pair[1 + s], 0) + (STRENGTH + DISCOUNT * room[ctx]) * p0[word]
            p += own / (STRENGTH + customers)
        logs = np.log10(p / SAMPLES)
        base = np.log10((count + 1) / (n_train + n_words + 1))
        n = rows.num_rows
        yield pa.RecordBatch.from_arrays(
            [rows.column("id"), rows.column("held"), pa.array(np.diff(c.first), pa.int64()),
             pa.array(np.bincount(c.doc, count[c.word] > 0, n).astype(np.int64)), pa.array(np.full(n, n_train), pa.int64()),
             pa.array(np.bincount(c.doc, base[c.word], n)), pa.array(np.bincount(c.doc, logs[which], n))],
            names=[id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    answers = counts.unionByName(seated.where("chunk >= 0")).unionByName(tops.where("key >= 0"))
    return C.back(chunks, answers, finish, f"`{id_col}` {kind}, held_out boolean, n_tokens long, n_known long, "
                                           "train_tokens long, base_score double, score double")
