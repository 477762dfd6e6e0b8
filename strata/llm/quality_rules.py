"""Quality rules: word and line rules, then a hashed n-gram log-likelihood ratio.  DataFrame functions only.

``measure`` gives every document the figures of the rules and the ratio

    llr = mean over its word 1- and 2-grams g of  log p(b(g) | trusted) - log p(b(g) | corpus)

where b hashes an n-gram of lower-cased words to one of ``N_BUCKETS`` buckets, p(. | corpus) is the smoothed multinomial
of *all* documents and p(. | trusted) that of the trusted documents.  The mean makes it independent of length, and the
verdict is a fixed threshold on it, so it is the same in every run and for every document.

Scale: one pass counts buckets (map-side partial aggregation; at most ``N_BUCKETS`` rows leave a task), the weights are
one array of ``N_BUCKETS`` doubles (a scalar subquery, 128 kB at any input size), and a second pass scores rows without
any shuffle: a document never leaves its partition, so neither a hot source nor a group of copies matters.  The trusted
side is a bounded sample: ``TRUSTED_DOCS`` ids of the lowest hash, small enough to broadcast by construction.

Defined results: a null or empty text has no words, all figures 0, ``base_failed`` true and ``kept`` false; repeated rows
are scored (and counted) each; null ids are scored, never trusted; without trusted documents every weight and ratio is
0, so only the base rules decide; columns of the input are kept as one struct, so their names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
N_BUCKETS = 1 << 14
TRUSTED_DOCS = 20_000
SMOOTHING = 0.5
MIN_LLR = -0.045


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def line_repeats(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return lines


def buckets_of(words: str) -> Column:
    """Buckets of the word 1- and 2-grams of an array column of lower-cased words."""
    n = F.lit(N_BUCKETS)
    one = F.transform(words, lambda w: F.pmod(F.xxhash64(w), n).cast("int"))
    two = F.transform(F.slice(F.col(words), 1, F.greatest(F.size(words) - 1, F.lit(0))),
                      lambda w, i: F.pmod(F.xxhash64(w, F.get(F.col(words), i + 1)), n).cast("int"))
    return F.concat(one, two)


def weights(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text: str = "text",
            trusted_docs: int = TRUSTED_DOCS) -> DataFrame:
    """One row, one array: the log ratio of each bucket.  ``trusted`` has the ids of trusted documents."""
    ids = (trusted.select(F.col(id_col).alias("__id")).where("__id is not null").distinct()
           .orderBy(F.xxhash64("__id"), "__id").limit(trusted_docs).withColumn("__t", F.lit(1)))
    grams = (docs.select(F.col(id_col).alias("__id"), words_of(F.lower(F.col(text))).alias("__w"))
             .join(F.broadcast(ids), "__id", "left")
             .select(F.coalesce("__t", F.lit(0)).alias("t"), buckets_of("__w").alias("b"))
             # the outer form: a plain explode infers a filter that would compute the array twice
             .select("t", F.explode_outer("b").alias("bucket")).where("bucket is not null"))
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("r"), F.sum("t").alias("t"))
    every = docs.sparkSession.range(N_BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    full = (every.join(counts, "bucket", "left")
            .select("bucket", F.coalesce("r", F.lit(0)).alias("r"), F.coalesce("t", F.lit(0)).alias("t")))
    one = full.agg(F.sort_array(F.collect_list(F.struct("bucket", "r", "t"))).alias("c"),
                   F.sum("r").alias("rs"), F.sum("t").alias("ts"))
    a = SMOOTHING
    return one.select(F.transform("c", lambda x: F.when(F.col("ts") > 0,
        F.log((x["t"] + a) / (F.col("ts") + a * N_BUCKETS)) - F.log((x["r"] + a) / (F.col("rs") + a * N_BUCKETS)))
        .otherwise(F.lit(0.0))).alias("w"))


def measure(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text: str = "text",
            min_llr: float = MIN_LLR) -> DataFrame:
    """``row`` (the input row as a struct) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, llr,
    base_failed and kept."""
    w = weights(docs, trusted, id_col, text)
    t = F.coalesce(F.col("x"), F.lit(""))
    a = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("x"))
    a = a.select("row", words_of(F.col("x")).alias("words"), words_of(F.lower(F.col("x"))).alias("lowered"),
                 line_repeats(F.col("x")).alias("lines"),
                 F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
                 (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    a = a.select("row", "word_chars", "n_symbols", F.size("words").cast("long").alias("n_words"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.transform(F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0))),
                             lambda v, i: F.struct(F.xxhash64(v, F.get("words", i + 1), F.get("words", i + 2)).alias("h"),
                                                   i.alias("i"))).alias("tri"),
                 buckets_of("lowered").alias("b"))
    a = a.select("*", F.sort_array("tri").alias("s"))
    same = F.filter("s", lambda v, i: (F.get("s", i - 1)["h"] == v["h"]) | (F.get("s", i + 1)["h"] == v["h"]))
    a = a.select("row", "word_chars", "n_symbols", "n_words", "n_dup_lines", "b", same.alias("same"), w.scalar().alias("w"))
    covered = F.array_distinct(F.flatten(F.transform("same", lambda v: F.array(v["i"], v["i"] + 1, v["i"] + 2))))
    llr = F.aggregate("b", F.lit(0.0), lambda total, v: total + F.get(F.col("w"), v))
    a = a.select("row", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                 F.size(covered).cast("long").alias("n_repeat_words"),
                 F.when(F.size("b") > 0, llr / F.size("b")).otherwise(F.lit(0.0)).alias("llr"),
                 # a filter on the verdict stops here instead of being computed on its own inlined copy of the arrays
                 (F.monotonically_increasing_id() >= 0).alias("here"))
    bad = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    a = a.select("*", bad.alias("base_failed"))
    return a.select("*", (F.col("here") & ~F.col("base_failed") & (F.col("llr") >= min_llr)).alias("kept")).drop("here")


def keep(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that pass, with their own columns."""
    return measure(docs, trusted, id_col, text).where("kept").select("row.*")
