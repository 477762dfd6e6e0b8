"""Source divergence audit: how far the term distributions of a language's sources lie apart, exactly.

A term is joined with its document's language first: a document has one language, so these keys give every language its own
vocabulary and document counts, without a job per language.  Document counts are added up per task while the terms are
taken, and over all tasks by key; keys in ``min_df`` documents or more are kept, all of them.  ``CountVectorizer``, fitted
on the kept keys with the largest integer as ``vocabSize``, turns every document into sparse vectors.  The kept keys pass
the driver, as CountVectorizer works; they are therefore dealt by hash into as many fits as keep each at about
``FIT_TERMS``.  Vectors are summed per (lang, source) with weights like Summarizer does, but as integers over their stored
entries only, added up in the task that makes them, so a source with a third of all rows is one row per term and task.

Pairs: a group is its terms with a count, all others have one and the same probability.  Sources of a language are dealt
into blocks of about ``BLOCK`` and their terms into buckets of about ``BUCKET``; a task compares two blocks over one bucket
as integer matrices of the terms that occur there, and terms that occur in neither block are added in closed form.  Term
rows are sent once per block, never once per pair of sources.

Defined results: null text, lang and source read as ''; a text without terms counts nowhere but makes its group occur;
without kept terms every pair is 0; ties are ranked by the item's bytes; repeated rows are documents of their own; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import tokens as T
from strata.llm.chunks import write_table
from strata.session import small_batches

MIN_DF = 10
FIT_TERMS = 1 << 19                             # kept terms in one fit, about: what the driver and a broadcast hold
PROBE = 1 << 18                                 # document counts that a task holds before it passes them on
SUMS = 1 << 19                                  # and entries of group sums
PART = 1 << 10                                  # entries of a group's vector that go to one bucket
MOST_TERMS = 2**31 - 1
BLOCK, BUCKET = 64, 4096                        # sources in a block, terms in a bucket, about
SLICE = 2 << 20
UNIT = 1_000_000_000
INSIDE = np.zeros(256, bool)                    # bytes of a term: letters, and every byte of a code point from U+0080 on
INSIDE[65:91] = INSIDE[97:123] = INSIDE[128:] = True
SEP = "\x00"                                    # stands in no term
ROWS = ["lang", "source", "n", "keys", "key", "df"]


def terms(buf: np.ndarray, off: np.ndarray) -> pa.ListArray:
    """The terms of each text (UTF-8 bytes and offsets), A-Z lower-cased."""
    inside = INSIDE[buf]
    first = np.zeros(len(buf) + 1, bool)
    first[1:] = inside
    first[off] = False                          # a text's first byte starts anew
    start = np.flatnonzero(inside & ~first[:-1])
    place = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(inside, out=place[1:])
    ends = np.append(place[start], place[-1]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(T.LOWER[buf[inside]]))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(start, off), pa.int32()), words)


def weighted(part: pa.RecordBatch) -> tuple[pa.RecordBatch, pa.Table]:
    """Of a slice: rows (lang, source, n, keys), of each text the terms that occur n times, one row per n; and (key, df), in
    how many of the slice's texts each key is.

    A document's vector is the sum of its rows, each taken n times; a term is in one row of a document.  A text without
    terms is one row without keys.
    """
    found = terms(*T.buffers(part.column("text")))
    coded = found.values.dictionary_encode()
    words, n_words = coded.dictionary, max(len(coded.dictionary), 1)
    doc = pc.list_parent_indices(found).to_numpy().astype(np.int64)
    pair, n = np.unique(doc * n_words + coded.indices.to_numpy().astype(np.int64), return_counts=True)
    doc, word = pair // n_words, pair % n_words
    order = np.argsort(doc * (n.max(initial=0) + 1) + n)
    doc, word, n = doc[order], word[order], n[order]
    start = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (n[1:] != n[:-1])]) if len(doc) else np.zeros(0, np.int64)
    blank = np.setdiff1d(np.arange(part.num_rows), doc)
    row_doc = np.r_[doc[start], blank]
    ends = np.r_[start, np.full(len(blank) + 1, len(doc))]
    langs = part.column("lang").dictionary_encode()
    own, which, df = np.unique(langs.indices.to_numpy().astype(np.int64)[doc] * n_words + word, return_inverse=True,
                               return_counts=True)
    keys = pc.binary_join_element_wise(words.take(pa.array(own % n_words)), langs.dictionary.take(pa.array(own // n_words)), SEP)
    rows = pa.RecordBatch.from_arrays(
        [part.column("lang").take(pa.array(row_doc)), part.column("source").take(pa.array(row_doc)),
         pa.array(np.r_[n[start], np.zeros(len(blank))].astype(np.int64)),
         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), keys.take(pa.array(which))),
         pa.nulls(len(row_doc), pa.string()), pa.nulls(len(row_doc), pa.int64())], names=ROWS)
    return rows, pa.table({"key": keys, "value": pa.array(df, pa.int64())})


class Sums:
    """(key, value) rows added up by key; of about ``limit`` distinct keys a task holds, it lets go."""

    def __init__(self, limit: int):
        self.limit, self.held, self.size = limit, [], 0

    def fold(self) -> pa.Table:
        return pa.concat_tables(self.held).group_by("key", use_threads=False).aggregate([("value", "sum")]).select(
            ["key", "value_sum"])

    def add(self, part: pa.Table) -> Iterator[pa.Table]:
        self.held.append(part)
        self.size += part.num_rows
        if self.size > 2 * self.limit:
            some = self.fold()
            self.held, self.size = [some.rename_columns(["key", "value"])], some.num_rows
            if self.size > self.limit:
                self.held, self.size = [], 0
                yield some

    def rest(self) -> Iterator[pa.Table]:
        if self.held:
            yield self.fold()


def key_rows(sums: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
    for got in sums:
        k = got.num_rows
        none = [pa.nulls(k, t) for t in (pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()))]
        yield from pa.table([*none, *got.columns], names=ROWS).to_batches(1 << 16)


def keyed(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """A written table of two kinds of rows, with nulls in each other's columns: (lang, source, n, keys), every document's
    terms, each with its language, see ``weighted``; and (key, df), document counts of keys, added up per task."""
    limit = PROBE

    def run(batches):
        sums = Sums(limit)
        for batch in batches:
            for part in T.slices(batch, "text", SLICE):
                rows, df = weighted(part)
                yield rows
                yield from key_rows(sums.add(df))
        yield from key_rows(sums.rest())

    small_batches(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                         for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    return write_table(rows.mapInArrow(run, "lang string, source string, n long, keys array<string>, key string, df long"), "terms")


def group_sums(buckets: int):
    """Rows (lang, source, n, v) -> a row per bucket: the vectors taken n times and added up per group, over a task's stored
    entries; ``PART`` entries of a group's vector go to one bucket.  A row lists its groups, and per entry the group's place
    in that list, the index and the count."""

    def run(batches):
        place, names, seeds, sums = {}, [], [], Sums(SUMS)

        def out(tables):
            for got in tables:
                key, count = got.column("key").to_numpy(), got.column("value_sum").to_numpy()
                cell = np.array(seeds, np.uint64)[key >> 32] << T.U(32) | ((key & 0xFFFFFFFF) // PART).astype(np.uint64)
                bucket = (T.mix(cell) % T.U(buckets)).astype(np.int64)
                order = np.argsort(bucket)
                key, count, bucket = key[order], count[order], bucket[order]
                here, first = np.unique(bucket, return_index=True)
                own, which = np.unique(bucket * len(names) + (key >> 32), return_inverse=True)
                cut = np.searchsorted(own // len(names), here)
                at, to = pa.array(np.r_[first, len(key)], pa.int32()), pa.array(np.r_[cut, len(own)], pa.int32())
                lists = lambda off, values: pa.ListArray.from_arrays(off, values)
                group = pa.array(own % len(names))
                yield from pa.table({
                    "bucket": pa.array(here, pa.int32()),
                    "lang": lists(to, pa.array([x for x, _ in names], pa.string()).take(group)),
                    "source": lists(to, pa.array([x for _, x in names], pa.string()).take(group)),
                    "g": lists(at, pa.array(which - np.repeat(cut, np.diff(np.r_[first, len(key)])), pa.int32())),
                    "i": lists(at, pa.array((key & 0xFFFFFFFF).astype(np.int32))),
                    "count": lists(at, pa.array(count))}).to_batches(1 << 8)

        for batch in batches:
            lang, source = batch.column("lang").dictionary_encode(), batch.column("source").dictionary_encode()
            wide = max(len(source.dictionary), 1)
            pair, which = np.unique(lang.indices.to_numpy().astype(np.int64) * wide + source.indices.to_numpy(), return_inverse=True)
            group = np.zeros(len(pair), np.int64)
            for k, x in enumerate(pair.tolist()):
                name = lang.dictionary[x // wide].as_py(), source.dictionary[x % wide].as_py()
                if name not in place:
                    place[name] = len(names)
                    names.append(name)
                    seeds.append(zlib.crc32(SEP.join(name).encode()))
                group[k] = place[name]
            v = batch.column("v")
            indices, values = v.field("indices"), v.field("values")
            row = pc.list_parent_indices(indices).to_numpy()
            count = batch.column("n").to_numpy()[row] * values.flatten().to_numpy().astype(np.int64)
            key = (group[which][row] << 32) | indices.flatten().to_numpy().astype(np.int64)
            yield from out(sums.add(pa.table({"key": key, "value": count})))
        yield from out(sums.rest())

    return run


def bucket_sums(table: pa.Table) -> pa.Table:
    """(lang, source, i, count) of a bucket from the rows of all tasks."""
    column = {c: table.column(c).combine_chunks() for c in ("lang", "source", "g", "i", "count")}
    flat = {c: x.flatten() for c, x in column.items()}
    lang, source = flat["lang"].dictionary_encode(), flat["source"].dictionary_encode()
    wide = len(source.dictionary)
    own, which = np.unique(lang.indices.to_numpy().astype(np.int64) * wide + source.indices.to_numpy(), return_inverse=True)
    names_of = np.r_[0, np.cumsum(pc.list_value_length(column["lang"]).to_numpy())]
    group = which[names_of[pc.list_parent_indices(column["i"]).to_numpy()] + flat["g"].to_numpy()]
    entries = pa.table({"key": (group << 32) | flat["i"].to_numpy(), "value": flat["count"]})
    got = entries.group_by("key", use_threads=False).aggregate([("value", "sum")])
    key = got.column("key").to_numpy()
    pair = own[key >> 32]
    return pa.table({"lang": lang.dictionary.take(pa.array(pair // wide)), "source": source.dictionary.take(pa.array(pair % wide)),
                     "i": pa.array((key & 0xFFFFFFFF).astype(np.int32)), "count": got.column("value_sum")})


def count_vectors(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, term, count) of the ``kept`` keys in the documents' ``rows``."""
    model = CountVectorizer(inputCol="keys", outputCol="v", minDF=1.0, vocabSize=MOST_TERMS).fit(
        kept.select(F.array("key").alias("keys")))
    vectors = model.transform(rows).select("lang", "source", "n", "v")
    buckets = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = vectors.mapInArrow(group_sums(buckets), "bucket int, lang array<string>, source array<string>, g array<int>, "
                              "i array<int>, count array<long>").groupBy("bucket").applyInArrow(
        bucket_sums, "lang string, source string, i int, count long")
    words = pa.table({"i": pa.array(np.arange(len(model.vocabulary)), pa.int32()),
                      "key": pa.array(model.vocabulary, pa.string())})
    words = write_table(rows.sparkSession.createDataFrame(words), "vocabulary")
    return sums.join(words, "i").select("lang", "source", F.substring_index("key", SEP, 1).alias("term"), "count")


def documents(rows: DataFrame) -> DataFrame:
    return rows.where("lang is not null").select("lang", "source", "n", "keys")


def counts(rows: DataFrame, min_df: int = MIN_DF, fit_terms: int = FIT_TERMS) -> DataFrame:
    """(lang, source, term, count) with count > 0, of the terms in at least ``min_df`` documents of their language."""
    kept = write_table(rows.where("key is not null").groupBy("key").agg(F.sum("df").alias("df")).where(F.col("df") >= min_df)
                       .select("key"), "kept")
    fits, out = kept.count() // fit_terms + 1, None
    for i in range(fits):
        mine = lambda k: F.pmod(F.xxhash64(k), F.lit(fits)) == i
        part, some = documents(rows), kept
        if fits > 1:
            part, some = part.withColumn("keys", F.filter("keys", mine)), kept.where(mine(F.col("key")))
        if some.limit(1).count():
            got = count_vectors(part, some)
            out = got if out is None else out.unionByName(got)
    if out is None:
        return rows.sparkSession.createDataFrame([], "lang string, source string, term string, count long")
    return write_table(out, "term-counts")


def probability(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(UNIT * (count + 2) / (n + 2 * v)); where the product would leave a long, in decimals."""
    wide = F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)"),
                           (n + 2 * v).cast("decimal(20,0)"))
    return F.lit(1) + F.when(count < 2**63 // UNIT - 2, F.call_function("div", F.lit(UNIT).cast("long") * (count + 2), n + 2 * v)) \
        .otherwise(wide)


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def groups(rows: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, source, n, v, p0) of every group, and (lang, q_n, v) of every language."""
    kept = found.groupBy("lang", "term").agg(F.sum("count").alias("count"))
    langs = rows.select("lang").distinct().join(kept.groupBy("lang").agg(
        F.count(F.lit(1)).alias("v"), F.sum("count").alias("q_n")), "lang", "left").fillna(0, ["v", "q_n"])
    langs = write_table(langs.select("lang", "q_n", "v"), "langs")
    own = found.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    g = rows.select("lang", "source").distinct().join(own, ["lang", "source"], "left").fillna(0, ["n"]).join(langs, "lang")
    g = g.select("lang", "source", "n", "v", F.when(F.col("v") > 0, probability(F.lit(0).cast("long"), F.col("n"), F.col("v")))
                 .otherwise(F.lit(1).cast("long")).alias("p0"))
    return write_table(g, "groups"), langs


def compare(table: pa.Table) -> pa.Table:
    """Two blocks of sources over one bucket of terms: (lang, a, b, total, seen, p0a, p0b, v) for each pair."""
    one = lambda c: table.column(c)[0].as_py()
    is_head = pc.is_null(table.column("term"))
    head, body = table.filter(is_head), table.filter(pc.invert(is_head))
    names = head.column("source").combine_chunks()
    block, p0 = head.column("block").to_numpy(), head.column("p").to_numpy()
    words = body.column("term").combine_chunks().dictionary_encode()
    words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
    p = np.repeat(p0[:, None], len(words.dictionary), axis=1)
    at = pc.index_in(body.column("source"), value_set=names)
    p[at.to_numpy(), words.indices.to_numpy(zero_copy_only=False)] = body.column("p").to_numpy()
    low, high = one("low"), one("high")
    a, b, total = [], [], []
    for i in np.flatnonzero(block == low):
        j = np.flatnonzero(block == high)
        j = j[j > i] if low == high else j
        total.append((((p[j] - p[i]) ** 2) // (p[j] + p[i])).sum(axis=1))
        a.append(np.full(len(j), i))
        b.append(j)
    a, b = (np.concatenate(x) if x else np.zeros(0, int) for x in (a, b))
    n = len(a)
    return pa.table({"lang": pa.array([one("lang")] * n, pa.string()), "a": names.take(pa.array(a)), "b": names.take(pa.array(b)),
                     "total": pa.array(np.concatenate(total) if total else [], pa.int64()),
                     "seen": pa.array([p.shape[1]] * n, pa.int64()), "p0a": pa.array(p0[a], pa.int64()),
                     "p0b": pa.array(p0[b], pa.int64()), "v": pa.array([one("v")] * n, pa.int64())})


def pairs(found: DataFrame, g: DataFrame) -> DataFrame:
    """(lang, source, item, value): the divergence of every two sources of a language, both ways."""
    sizes = g.groupBy("lang").agg(F.floor(F.count(F.lit(1)) / BLOCK + 1).alias("blocks"))
    placed = g.join(sizes, "lang").withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks"))).withColumn(
        "buckets", F.floor(F.col("v") / BUCKET) + 1)
    head = placed.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1))).select(
        "lang", "source", "blocks", "block", "v", F.lit(None).cast("string").alias("term"), "bucket", F.col("p0").alias("p"))
    body = found.join(placed, ["lang", "source"]).select(
        "lang", "source", "blocks", "block", "v", "term", F.pmod(F.xxhash64("term"), F.col("buckets")).alias("bucket"),
        probability(F.col("count"), F.col("n"), F.col("v")).alias("p"))
    sent = head.unionByName(body).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    sent = sent.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", "blocks")
    part = sent.groupBy("lang", "low", "high", "bucket").applyInArrow(
        compare, "lang string, a string, b string, total long, seen long, p0a long, p0b long, v long")
    whole = part.groupBy("lang", "a", "b").agg(F.sum("total").alias("total"), F.sum("seen").alias("seen"),
                                               F.max("p0a").alias("p0a"), F.max("p0b").alias("p0b"), F.max("v").alias("v"))
    value = F.col("total") + (F.col("v") - F.col("seen")) * divergence(F.col("p0a"), F.col("p0b"))
    way = lambda x, y: F.struct(F.col(x).alias("source"), F.col(y).alias("item"))
    return whole.select("lang", value.alias("value"), F.explode(F.array(way("a", "b"), way("b", "a"))).alias("w")).select(
        "lang", "w.source", "w.item", "value")


def marks(found: DataFrame, g: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, source, item, value): the terms a source has more often than its language."""
    q = found.groupBy("lang", "term").agg(F.sum("count").alias("q_count")).join(langs, "lang").select(
        "lang", "term", probability(F.col("q_count"), F.col("q_n"), F.col("v")).alias("q"))
    p = found.join(g, ["lang", "source"]).select("lang", "source", "term", probability(
        F.col("count"), F.col("n"), F.col("v")).alias("p"))
    return p.join(q, ["lang", "term"]).where("p > q").select("lang", "source", F.col("term").alias("item"),
                                                             divergence(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, min_df: int = MIN_DF, top: int = 10, text: str = "text", lang: str = "lang",
          source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): all other sources of the language (``pair``) and the ``top`` terms
    (``term``) of every source, the farthest first."""
    rows = keyed(docs, text, lang, source)
    found = counts(rows, min_df)
    g, langs = groups(documents(rows), found)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pair = pairs(found, g).withColumn("rank", rank).withColumn("part", F.lit("pair"))
    term = marks(found, g, langs).withColumn("rank", rank).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    return pair.unionByName(term).select("lang", "source", "part", "item", "value", "rank")


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM documents),
w AS (SELECT id, lang, source, unnest(t) AS term FROM d),
k AS (SELECT lang, term, count(*) AS c FROM w GROUP BY 1, 2 HAVING count(DISTINCT id) >= {MIN_DF}),
l AS (SELECT g.lang, coalesce(sum(c), 0) AS n, count(term) AS v FROM (SELECT DISTINCT lang FROM d) g LEFT JOIN k USING (lang)
  GROUP BY 1),
c AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY 1, 2, 3),
g AS (SELECT s.lang, s.source, coalesce(any_value(x.n), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) s
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM c GROUP BY 1, 2) x USING (lang, source) GROUP BY 1, 2),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
  1 + ({UNIT}::HUGEINT * (coalesce(c.c, 0) + 2)) // (g.n + 2 * l.v) AS p, 1 + ({UNIT}::HUGEINT * (k.c + 2)) // (l.n + 2 * l.v) AS q
  FROM g JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS f
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.f, 0) AS value FROM g a
  JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE c > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r
WHERE part = 'pair' OR rank <= 10"""
