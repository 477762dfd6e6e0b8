"""Merkle manifest of a dataset: checkpoint and recompute.

A leaf is the SHA-256 of a row; per tree (language) every ``ARITY`` consecutive nodes become one, up to a subroot, and the
subroots become the root.  ``build`` stores only every ``STRIDE``-th level (``ARITY ** STRIDE`` = 512 nodes of a stored
level become one of the next).  ``proofs`` goes from the root down: it takes the stored nodes of one aligned subtree at a
time, regenerates the levels between from them, emits each node's siblings and drops the regenerated nodes again.  A
subtree is one row of at most 512 digests, so no task holds a tree; a language with a third of all rows is just more
subtrees.  A proof is never shuffled: a leaf gets its path where its subtree is expanded, from the path of its stored
ancestor, and only digests of it are returned unless the caller asks for the path itself.

Everything runs as DataFrame expressions.  Leaves are written once, so texts are hashed once; positions come from
``ranks.ranked``.  Stored levels are written tables in the shared folder (or under ``path``), from which a lost executor's
work is repeated.

Defined results: a null column is ``-``; leaves of a tree ascend by (id, digest), null ids first, so repeated ids and
repeated rows have a defined order; a null tree comes first; a lone leaf is its subroot and a lone subroot the root; an
empty table has no rows and no root (None); columns that are not named take no part, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.chunks import write_table
from strata.llm.language_id import remainder
from strata.llm.ranks import ranked

ARITY = 8
STRIDE = 3                                      # levels between two stored ones
SPAN = ARITY ** STRIDE
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"


def row_digest(values: list[Column]) -> Column:
    """SHA-256 over the values, each ``-`` if null, else its length in UTF-8 bytes, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else; ``lower`` does just that, faster, where the text is all ASCII."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower()))


def steps(n: Column) -> Column:
    """How many levels a stored level of ``n`` nodes goes up to the next stored one, or to its tree's top."""
    out = F.lit(STRIDE)
    for t in reversed(range(STRIDE)):
        out = F.when(n <= ARITY ** t, F.lit(t)).otherwise(out)
    return out


def up(level: Column) -> Column:
    """The next level: one digest per run."""
    runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / ARITY).cast("int"))
    return F.transform(runs, lambda r: F.sha2(F.array_join(F.slice(level, r * ARITY + 1, F.lit(ARITY)), ""), 256))


def subtrees(nodes: DataFrame, carry: list[str]) -> DataFrame:
    """(tree, n, idx, t, level_0 .. level_STRIDE, kids): aligned subtrees with their regenerated levels.

    Levels above a tree's top (from ``t`` on) repeat the one below.
    """
    kid = F.struct((F.col("idx") % SPAN).alias("at"), "h", *carry)
    sub = nodes.where("n > 1").groupBy("tree", "n", F.floor(F.col("idx") / SPAN).alias("idx")).agg(
        F.sort_array(F.collect_list(kid)).alias("kids"))
    sub = sub.select("tree", "n", "idx", "kids", steps(F.col("n")).alias("t"),
                     F.transform("kids", lambda k: k["h"]).alias("level_0"))
    for a in range(STRIDE):
        below = F.col(f"level_{a}")
        sub = sub.withColumn(f"level_{a + 1}", F.when(F.col("t") > a, up(below)).otherwise(below))
    return sub


def build(leaves: DataFrame, path: str | None = None) -> list[DataFrame]:
    """The stored levels (tree, idx, n, h, further columns at level 0) of every tree, leaves first.

    ``leaves``: tree, idx, n, h.  ``n`` is the number of nodes of the tree on that level; a node with n = 1 is a subroot.
    """
    spark = leaves.sparkSession
    levels = [leaves]
    while levels[-1].agg(F.max("n")).first()[0] not in (None, 1):
        sub = subtrees(levels[-1].select("tree", "idx", "n", "h"), [])
        nodes = sub.select("tree", "idx", F.ceil(F.col("n") / SPAN).alias("n"),
                           F.element_at(F.col(f"level_{STRIDE}"), 1).alias("h"))
        if path is None:
            levels.append(write_table(nodes, "merkle"))
        else:
            nodes.write.parquet(f"{path}/level={STRIDE * len(levels)}")
            levels.append(spark.read.schema(nodes.schema).parquet(f"{path}/level={STRIDE * len(levels)}"))
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """(tree, h): the one node left of each tree."""
    out = None
    for nodes in levels:
        one = nodes.where("n = 1").select("tree", "h")
        out = one if out is None else out.unionByName(one)
    return out


def expand(nodes: DataFrame, above: DataFrame, carry: list[str]) -> DataFrame:
    """(tree, idx, carry, path): siblings from each node up to its subtree's top, then its ancestor's path.

    ``above``: (tree, idx, path) of the next stored level.
    """
    sub = subtrees(nodes, carry).alias("s")
    a = above.select("tree", "idx", F.col("path").alias("rest")).alias("a")
    sub = sub.join(a, F.col("s.tree").eqNullSafe(F.col("a.tree")) & (F.col("s.idx") == F.col("a.idx"))).select("s.*", "rest")

    def path(kid, p):
        out = []
        for level in range(STRIDE):
            pos = F.floor(p / ARITY ** level).cast("int")
            own, run = F.col(f"level_{level}"), pos - pos % ARITY
            out.append(F.when(F.col("t") > level, F.array(F.struct(
                F.array_join(F.slice(own, run + 1, pos % ARITY), "").alias("before"),
                F.array_join(F.slice(own, pos + 2, ARITY - 1 - pos % ARITY), "").alias("after"))))
                .otherwise(F.array().cast(PATH)))
        return F.struct((F.col("idx") * SPAN + kid["at"]).alias("idx"), *[kid[c].alias(c) for c in carry],
                        F.concat(*out, F.col("rest")).alias("path"))

    return sub.select("tree", F.explode(F.transform("kids", path)).alias("k")).select("tree", "k.*")


def paths(levels: list[DataFrame], top: DataFrame, carry: list[str]) -> DataFrame:
    """(tree, carry, path) of every leaf; ``top``: (tree, path) of the trees' tops."""
    at_top = top.select(F.col("tree").alias("_tree"), "path")
    above = None
    for j in reversed(range(len(levels))):
        keep = carry if j == 0 else []
        done = levels[j].where("n = 1").join(at_top, F.col("tree").eqNullSafe(F.col("_tree"))).select(
            "tree", "idx", *keep, "path")
        if above is not None:
            done = done.unionByName(expand(levels[j].select("tree", "idx", "n", "h", *keep), above, keep))
        above = done if j == 0 else write_table(done, "merkle-paths")
    return above.select("tree", *carry, "path")


def leaves(docs: DataFrame, tree: str = "lang", order: str = "doc_id", fields: tuple[str, ...] = FIELDS,
           **more: Column) -> DataFrame:
    """Level 0: (tree, id, h, further columns, idx, n).  ``more``: expressions over ``docs``, such as a claimed digest."""
    rows = docs.select(F.col(tree).alias("tree"), F.col(order).alias("id"),
                       row_digest([F.col(f) for f in fields]).alias("h"), *[c.alias(k) for k, c in more.items()])
    return ranked(rows, ["tree"], ["id", "h"]).withColumnRenamed("rank", "idx")


def siblings(path: Column) -> Column:
    """The digests of a proof, from the leaf's run to the root, left to right, as one text."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def prove(level_0: DataFrame, carry: list[str], path: str | None = None) -> DataFrame:
    """(tree, carry, path, subroot, root) of every leaf.

    ``path``: folder that keeps the stored levels, else the shared scratch folder does.
    """
    own = build(level_0, path)
    subroots = write_table(tops(own).withColumn("all", F.lit(0)), "merkle-subroots")
    ordered = ranked(subroots, ["all"], ["tree"]).select(F.col("all").alias("tree"), F.col("rank").alias("idx"), "n", "h",
                                                       F.col("tree").alias("member"), F.col("h").alias("subroot"))
    over = build(write_table(ordered, "merkle-subroots"), None if path is None else f"{path}/root")
    last = tops(over).first()
    root = last["h"] if last else None
    crown = write_table(level_0.sparkSession.range(1).select(F.lit(0).alias("tree"), F.array().cast(PATH).alias("path")),
                        "merkle-crown")           # written: a literal key would turn the join into a nested loop
    top = paths(over, crown, ["member", "subroot"]).select(F.col("member").alias("tree"), "subroot", "path")
    top = write_table(top, "merkle-top")
    found = paths(own, top, carry)
    named = top.select(F.col("tree").alias("_tree"), "subroot")
    return found.join(named, F.col("tree").eqNullSafe(F.col("_tree"))).select(
        "tree", *carry, "path", "subroot", F.lit(root).alias("root"))


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every document; see the query's contract.

    Every third document (by crc32 of its id) is checked with a text whose A-Z were lower-cased after the manifest was
    made.
    """
    changed = row_digest([ascii_lower(F.col(f)) if f == "text" else F.col(f) for f in FIELDS])
    probe = F.when(remainder("doc_id", 3) == 0, changed)
    level_0 = leaves(docs, probe=probe)
    proven = prove(level_0.withColumn("leaf", F.col("h")), ["id", "leaf", "probe"])
    out = proven.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
                        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
                        fold(F.col("path"), F.coalesce("probe", "leaf")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle(levels: int = 8) -> str:
    """DuckDB: every level built in full; proofs are strings added up level by level."""
    crc = ("list_reduce(list_transform(flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1])), lambda b: CAST(b AS BIGINT)), "
           "lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, "
           "CAST(4294967295 AS BIGINT))")

    def enc(text):
        parts = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return "sha256(" + " || ".join(
            f"CASE WHEN {p} IS NULL THEN '-' ELSE strlen({p}) || ':' || {p} END" for p in parts) + ")"

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    sql = [f"""WITH l AS (SELECT doc_id, lang, {enc('text')} AS leaf,
  CASE WHEN doc_id IS NOT NULL AND xor({crc}, 4294967295) % 3 = 0 THEN {enc(low)} END AS probe FROM documents),
d0 AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  coalesce(probe, leaf) AS f, '' AS pr FROM l),
n0 AS (SELECT lang, pos AS idx, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM d0)"""]

    def go(i, tree):
        same = f"n.{tree} IS NOT DISTINCT FROM d.{tree}"
        a, b = f"n{i}", f"d{i}"
        return f"""r{i} AS (SELECT {tree}, idx // 8 AS idx, list(h ORDER BY idx) AS run, any_value(n) AS n FROM {a} WHERE n > 1
  GROUP BY 1, 2),
n{i + 1} AS (SELECT {tree}, idx, sha256(array_to_string(run, '')) AS h, (n + 7) // 8 AS n FROM r{i}
  UNION ALL SELECT {tree}, idx, h, n FROM {a} WHERE n = 1),
d{i + 1} AS (SELECT d.* EXCLUDE (pos, f, pr), d.pos // 8 AS pos,
  CASE WHEN n.run IS NULL THEN f ELSE sha256(array_to_string(n.run[1:d.pos % 8], '') || f
    || array_to_string(n.run[d.pos % 8 + 2:], '')) END AS f,
  CASE WHEN n.run IS NULL THEN pr ELSE pr || array_to_string(n.run[1:d.pos % 8], '')
    || array_to_string(n.run[d.pos % 8 + 2:], '') END AS pr
  FROM {b} d LEFT JOIN r{i} n ON {same} AND n.idx = d.pos // 8)"""

    sql += [go(i, "lang") for i in range(levels)]
    k = levels
    sql.append(f"""s AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM n{k}),
n{k + 1} AS (SELECT 0 AS one, place AS idx, subroot AS h, count(*) OVER () AS n FROM s),
d{k + 1} AS (SELECT d.* EXCLUDE (pos), s.subroot, s.place AS pos, 0 AS one FROM d{k} d
  JOIN s ON s.lang IS NOT DISTINCT FROM d.lang)""")
    sql += [go(i, "one") for i in range(k + 1, k + 4)]
    return ",\n".join(sql) + f"""
SELECT doc_id, leaf, subroot, n.h AS root, sha256(pr) AS proof_sha256, f AS folded_root, f = n.h AS verified
FROM d{k + 4} JOIN n{k + 4} n ON true"""


ORACLE = oracle()
