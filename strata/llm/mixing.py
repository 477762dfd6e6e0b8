"""Mixing sources to target weights by entropy balancing.

Each document gets a rate, the expected number of its copies, as near to one as the targets allow: the rates minimise the
relative entropy to "every document once" under one token constraint per source and no rate above ``MOST``.  The dual of
that has one variable per source, and its solution is an exponential tilt, ``rate = min(MOST, exp(lam * size / mean))``.
``solve`` finds all ``lam`` together by Newton's method: a round is one join and one aggregate over (source, size) strata
(rows of a stratum share a rate, so millions of documents are a few thousand strata), kept in a bracket so that it ends.
``apportion`` rounds: each stratum takes a whole number of copies, and what rounding left of a source's words is carried
from long documents to short ones, so a source ends within about half its shortest document of its target.  Which rows of a
stratum get the odd copy is decided by the hash of their id and text.

Scale: texts are read once.  Strata of a source are as many as it has different sizes (at most the square root of twice
its words), so a source with a third of all rows is still a few thousand rows in one task.  Rows of a stratum are ranked
without a window (``ranks.ranked``).  Sources are a table, never a list on the driver; the driver sees sums and counts.
Sums are taken in fixed point, which does not depend on the order of the rows, so reruns agree.

Defined results: a null text is empty; empty documents have size 0 and take 0; a null source is a source of its own and
the last in order; repeated rows are documents of their own, equal in all columns, so which of them takes the odd copy
can't be told; with no words at all every target is 0; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.chunks import write_table
from strata.llm.ranks import ranked

WEIGHTS = (3, 1, 2)                             # of the sources in order, repeating
PERCENT = 150                                   # of all words, shared by the sources
MOST = 2                                        # copies of a document
NEAR = 1e-6                                     # of the target: where Newton stops; rounding starts from the rest
ROUNDS = 200                                    # far more than a bracketed Newton needs; beyond them is an error
FIXED = 1 << 20                                 # fixed point of the sums
WORD = r"[^\x20\x09-\x0D]+"


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, most: int = MOST) -> DataFrame:
    """(source, source_size, target): ``percent`` of all words shared by weight, none above ``most`` times its source.

    ``sources``: source, source_size.  What a capped source can't take is shared again by weight, until none is above.
    """
    order = ranked(sources.withColumn("_last", F.col("source").isNull()).withColumn("_all", F.lit(0)),
                   ["_all"], ["_last", "source"])
    share = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    open_ = write_table(order.select("source", "source_size", share.alias("w")), "mix-sources")
    big = lambda c: F.col(c).cast("decimal(38,0)")
    total = int(open_.agg(F.sum(big("source_size"))).first()[0] or 0)
    state, full, level = open_.withColumn("full", F.lit(False)), -1, (0, 1)
    while True:
        s = state.agg(F.sum(F.col("full").cast("long")), F.sum(F.when(F.col("full"), big("source_size"))),
                      F.sum(F.when(~F.col("full"), big("w")))).first()
        if s[2] is None or (s[0] or 0) == full:
            break
        full, level = s[0] or 0, (total * percent - 100 * most * int(s[1] or 0), 100 * int(s[2]))
        num, den = (F.lit(str(v)).cast("decimal(38,0)") for v in level)
        above = F.col("w").cast("decimal(2,0)") * num > F.col("source_size").cast("decimal(20,0)") * most * den
        state = write_table(state.select("source", "source_size", "w", (F.col("full") | above).alias("full")), "mix-full")
    even = F.coalesce(*[F.when(F.col("w") == w, F.lit(w * level[0] / level[1])) for w in sorted(set(weights))])
    return state.select("source", "source_size", F.when(F.col("full"), F.col("source_size").cast("double") * most)
                        .otherwise(even).alias("target"))


def solve(strata: DataFrame, wanted: DataFrame, most: int = MOST) -> DataFrame:
    """(source, size, n, target, rate) of every stratum: the tilted rates that meet the targets.

    ``strata``: source, size, n, without size 0; ``wanted``: source, source_size, target.
    """
    docs = strata.groupBy(F.col("source").alias("_s")).agg(F.sum("n").alias("n_docs"), F.min("size").alias("least"))
    mean = F.col("source_size") / F.col("n_docs")
    near = F.col("least") / mean                # the smallest x; bounds of lam follow from it
    ratio = F.log(F.col("target") / F.col("source_size"))
    state = wanted.join(docs, F.col("source").eqNullSafe(F.col("_s"))).select(
        "source", "target", mean.alias("mean"), F.lit(0.0).alias("lam"),
        F.when(ratio < 0, ratio / near).otherwise(0.0).alias("lo"),
        F.when(ratio < 0, 0.0).otherwise(math.log(most) / near).alias("hi"),
        F.lit(float("inf")).alias("step"), (F.col("target") >= most * F.col("source_size")).alias("full"))
    state = write_table(state.withColumn("done", F.col("full")), "mix-state")
    lam_x = F.col("lam") * F.col("x")
    free = lam_x < math.log(most)
    for _ in range(ROUNDS):
        if state.where(~F.col("done")).isEmpty():
            break
        s = state.where(~F.col("done")).select(F.col("source").alias("_s"), "lam", "mean")
        part = strata.join(s, F.col("source").eqNullSafe(F.col("_s"))).withColumn("x", F.col("size") / F.col("mean"))
        words = F.col("n") * F.col("size") * F.when(free, F.exp(lam_x)).otherwise(float(most))
        fixed = lambda c: F.sum(F.round(c * FIXED).cast("decimal(38,0)")).cast("double") / FIXED
        sums = part.groupBy("_s").agg(fixed(words).alias("got"),
                                      fixed(F.when(free, words * F.col("x")).otherwise(0.0)).alias("slope"))
        new = state.join(sums, F.col("source").eqNullSafe(F.col("_s")), "left").withColumn("err", F.col("got") - F.col("target"))
        new = new.withColumns({"lo": F.when(F.col("err") < 0, F.col("lam")).otherwise(F.col("lo")),
                               "hi": F.when(F.col("err") > 0, F.col("lam")).otherwise(F.col("hi"))})
        newton = F.when(F.col("slope") > 0, F.col("lam") - F.col("err") / F.col("slope"))
        inside = (newton > F.col("lo")) & (newton < F.col("hi")) & (F.abs(newton - F.col("lam")) <= F.col("step") / 2)
        new = new.withColumn("to", F.when(inside, newton).otherwise((F.col("lo") + F.col("hi")) / 2))
        flat = F.col("hi") - F.col("lo") <= 1e-15 * (F.abs("lo") + F.abs("hi"))
        ready = F.coalesce(F.col("done") | (F.abs("err") <= NEAR * F.col("target")) | flat, F.lit(False))
        state = write_table(new.select(
            "source", "target", "mean", F.when(ready, F.col("lam")).otherwise(F.col("to")).alias("lam"), "lo", "hi",
            F.abs(F.col("to") - F.col("lam")).alias("step"), "full", ready.alias("done")), "mix-state")
    else:
        raise RuntimeError(f"entropy balancing: not solved in {ROUNDS} rounds")
    s = state.select(F.col("source").alias("_s"), "target", "lam", "mean", "full")
    rate = F.when(F.col("full") | ~free, F.lit(float(most))).otherwise(F.exp(lam_x))
    return strata.join(s, F.col("source").eqNullSafe(F.col("_s"))).withColumn("x", F.col("size") / F.col("mean")).select(
        "source", "size", "n", "target", rate.alias("rate"))


def apportion(rates: DataFrame, most: int = MOST) -> DataFrame:
    """(source, size, copies): whole copies of each stratum; one source's strata are bounded by its different sizes."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("size", ascending=False)
        want = (part["n"] * part["rate"] * part["size"]).to_numpy()
        over, copies = float(part["target"].iloc[0]) - math.fsum(want), []
        for w, size, n in zip(want, part["size"], part["n"]):
            c = min(max(math.floor((w + over) / size + 0.5), 0), most * int(n))
            over += w - c * int(size)
            copies.append(c)
        return pd.DataFrame({"source": part["source"], "size": part["size"], "copies": copies})

    return rates.groupBy("source").applyInPandas(run, "source string, size long, copies long")


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, most: int = MOST) -> DataFrame:
    """(id, size, source, source_size, target, rate, copies) of every document."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(source).alias("source"),
                       F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.xxhash64(F.col(id_col), F.col(text)).alias("odd"))
    rows = write_table(ranked(slim, ["source", "size"], ["odd", "id"]), "mix-rows")
    every = write_table(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-strata")
    strata = every.where("size > 0")
    wanted = write_table(targets(every.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")),
                                 weights, percent, most), "mix-targets")
    rates = write_table(solve(strata, wanted, most), "mix-rates")
    same = lambda *cols: [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in cols]
    plan = every.alias("a").join(wanted.alias("b"), same("source")).select("a.source", "size", "n", "source_size", "target")
    plan = plan.alias("a").join(rates.select("source", "size", "rate").alias("b"), same("source", "size"), "left").select(
        "a.*", "rate")
    plan = plan.alias("a").join(apportion(rates, most).alias("b"), same("source", "size"), "left").select(
        "a.*", F.coalesce("copies", F.lit(0)).alias("copies"))
    plan = write_table(plan, "mix-plan")
    out = rows.select("id", "source", "size", "rank").alias("a").join(plan.alias("b"), same("source", "size"))
    copies = F.floor(F.col("copies") / F.col("b.n")) + (F.col("rank") < F.col("copies") % F.col("b.n")).cast("long")
    return out.select("a.id", "a.size", "a.source", "source_size", "target", "rate", copies.alias("copies"))


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document; see the query's contract."""
    m = mix(docs)
    return m.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                    (F.col("size") * F.col("copies")).alias("taken"), "rate")
