"""Chat formatting: collapse logged snapshots of one conversation, then render.  DataFrame functions only.

Chat logs hold the same conversation many times, each snapshot a few turns longer.  ``collapse`` keeps the maximal ones:
a conversation goes when its turns are the first turns of a longer one, and of equal conversations the smallest id stays.
The prefix of length k is named by two 64-bit running XORs of hashes of (place, role, text); a XOR can be summed in parts,
so no conversation is ever collected whole.  Complete conversations are then anti-joined with the proper prefixes.

Scale: turns are gathered in parts of ``PART`` consecutive turn numbers, so one conversation with a third of all rows is
many parts (rows of bounded size); offsets of its parts come from a window over parts, not over turns.  Prefix names are
made distinct with map-side aggregation, so a first turn that a third of the conversations share is one row per task.
Joins are on unique keys or on (conversation, part).

Defined results: turns are ordered by (turn, role, text), nulls first; repeated rows of a turn count once; null roles and
texts are values of their own and render as empty; rows without a conversation id belong to none and are not rendered;
a null turn number stands first (part null); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.chunks import write_table

PART = 256


def parts(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """(conv, part, msgs, before, n, p1, p2): the messages of a part, how many come before, how many there are in all,
    and the running prefix names after each message."""
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                        F.col(text).alias("text")).where("conv is not null")
    made = rows.select("conv", F.floor(F.col("turn") / PART).alias("part"),
                       F.struct("turn", "role", "text").alias("m")).groupBy("conv", "part").agg(
        F.sort_array(F.collect_set("m")).alias("msgs"))
    made = write_table(made, "turns")
    by = Window.partitionBy("conv").orderBy(F.col("part").asc_nulls_first())
    earlier = by.rowsBetween(Window.unboundedPreceding, -1)
    sizes = made.select("conv", "part", F.size("msgs").cast("long").alias("c"))
    sizes = sizes.select("conv", "part", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("before"),
                         F.sum("c").over(Window.partitionBy("conv")).alias("n"))
    same = lambda a, b: a["conv"].eqNullSafe(b["conv"]) & a["part"].eqNullSafe(b["part"])

    def name(seed):
        return F.transform("msgs", lambda m, i: F.xxhash64(
            F.lit(seed), F.col("before") + i, m["role"].isNull(), m["role"], m["text"].isNull(), m["text"]))

    a, s = made.alias("a"), sizes.alias("s")
    named = a.join(s, (F.col("a.conv") == F.col("s.conv")) & F.col("a.part").eqNullSafe(F.col("s.part"))).select(
        "a.conv", "a.part", "msgs", "before", "n").select("*", name(1).alias("h1"), name(2).alias("h2"))
    named = write_table(named, "turns")

    def fold(h):
        return F.aggregate(h, F.lit(0).cast("long"), lambda x, y: x.bitwiseXOR(y))

    digest = named.select("conv", "part", fold("h1").alias("x1"), fold("h2").alias("x2"))
    base = digest.select("conv", "part", F.coalesce(F.bit_xor("x1").over(earlier), F.lit(0)).alias("o1"),
                         F.coalesce(F.bit_xor("x2").over(earlier), F.lit(0)).alias("o2"))

    def running(h, start):                           # at most PART elements, so building the list by appending is fine
        grown = F.aggregate(h, F.array(F.col(start)),
                            lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1).bitwiseXOR(x))))
        return F.slice(grown, 2, F.size(h))

    a, b = named.alias("a"), base.alias("b")
    return a.join(b, (F.col("a.conv") == F.col("b.conv")) & F.col("a.part").eqNullSafe(F.col("b.part"))).select(
        "a.conv", "a.part", "msgs", "before", "n", running("h1", "o1").alias("p1"), running("h2", "o2").alias("p2"))


def collapse(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(parts, kept): the prepared parts, and (conv, n_turns, n_copies) of the maximal conversations."""
    p = write_table(parts(turns, conv, turn, role, text), "parts")
    names = p.select("conv", "n", "before", F.posexplode_outer(F.arrays_zip("p1", "p2")).alias("i", "z")).select(
        "conv", "n", (F.col("before") + F.col("i") + 1).alias("k"), F.col("z.p1").alias("p1"), F.col("z.p2").alias("p2"))
    prefix = names.where("k < n").select("k", "p1", "p2").distinct()
    whole = names.where("k = n").groupBy("k", "p1", "p2").agg(F.min("conv").alias("conv"),
                                                              F.count(F.lit(1)).alias("n_copies"))
    kept = whole.join(prefix, ["k", "p1", "p2"], "left_anti")
    return p, kept.select("conv", F.col("k").alias("n_turns"), "n_copies")


def render(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """(conv, part, n_turns, n_copies, chat): the maximal conversations in a chat template, long ones in parts."""
    p, kept = collapse(turns, conv, turn, role, text)
    line = F.transform("msgs", lambda m: F.concat(F.lit("<|"), F.coalesce(m["role"], F.lit("")), F.lit("|>\n"),
                                                  F.coalesce(m["text"], F.lit("")), F.lit("<|end|>\n")))
    return p.select("conv", "part", F.array_join(line, "").alias("chat")).join(kept, "conv").select(
        F.col("conv").alias(conv), "part", "n_turns", "n_copies", "chat")


# DuckDB: prefixes compared as lists instead of hashes
ORACLE = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, list({{'r': role, 't': text}} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS m
      FROM t GROUP BY conv_id),
p AS (SELECT DISTINCT m[1:k] AS pre FROM (SELECT m, unnest(range(1, len(m))) AS k FROM l)),
w AS (SELECT min(conv_id) AS conv_id, count(*) AS n_copies, m FROM l GROUP BY m),
k AS (SELECT w.* FROM w ANTI JOIN p ON w.m = p.pre)
SELECT t.conv_id, CAST(floor(t.turn / {PART}) AS BIGINT) AS part, CAST(any_value(len(k.m)) AS BIGINT) AS n_turns,
       any_value(k.n_copies) AS n_copies,
       string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10), ''
                  ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS chat
FROM k JOIN t USING (conv_id) GROUP BY 1, 2"""
