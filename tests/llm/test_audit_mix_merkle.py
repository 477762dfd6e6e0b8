"""Source divergence, source mixing and the Merkle manifest against plain Python on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from strata.llm import divergence, merkle, mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, h string, tree string, rank int, size long"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows():
    r = random.Random(3)
    words = ["".join(r.choice("abcdéßñ") for _ in range(r.randint(1, 3))) for _ in range(60)]
    out = []
    for i in range(260):
        text = " ".join(r.choice(words[:20] if i % 3 else words) for _ in range(r.randint(0, 25)))
        text = text.title() if i % 4 == 0 else text
        lang = r.choice(["en", "en", "en", "de", None, ""])
        source = r.choice(["s1", "s1", "s2", "é", "z", None, ""])
        out.append((i * 7 % 300, text, lang, source, len(text)))
    out += [(900, None, "en", "s1", None), (901, "", "fr", "only", 0), (902, " \t\n", "en", "blank", 3), (None, "No Id", "en", "s1", 5),
            (None, "no id either", None, None, 5), (903, "Word-word_word1word\x7fword\x00x", "en", "s2", 1),
            (904, "x" * 30_000 + " " + "ab " * 9_000, "en", "s1", 57_000), (905, "lone", "xx", "s1", 4)]
    out += [(7, "Same Row", "en", "s1", 8)] * 30 + [(7, "same row", "en", "s1", 8)] * 3
    return [(*row, 5, "clash", "clash", 3, 4) for row in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- divergence --------------------------------------------------------------------------------------------------

def brute_audit(data, min_df):
    df, count = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in data:
        found = TERM.findall((text or "").translate(LOWER))
        count[lang or "", source or ""].update(found)
        df[lang or ""].update(set(found))
    out = []
    for lang in df:
        kept = [t for t, n in df[lang].items() if n >= min_df]
        v = len(kept)
        mine = {s: c for (l, s), c in count.items() if l == lang}
        all_ = Counter()
        for c in mine.values():
            all_.update(c)

        def p(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * v) for t in kept}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        probs, q = {s: p(c) for s, c in mine.items()}, p(all_)
        for s in mine:
            pair = [(o, sum(f(probs[s][t], probs[o][t]) for t in kept)) for o in mine if o != s]
            term = [(t, f(probs[s][t], q[t])) for t in kept if mine[s][t] and probs[s][t] > q[t]]
            for part, items, most in (("pair", pair, None), ("term", term, 10)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, x, k + 1) for k, (i, x) in enumerate(items[:most])]
    return sorted(out)


@pytest.mark.parametrize("fit_terms,block,bucket", [(1 << 19, 64, 4096), (20, 2, 7)])
def test_audit(docs, monkeypatch, fit_terms, block, bucket):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "BUCKET", bucket)
    monkeypatch.setattr(divergence.counts, "__defaults__", (10, fit_terms))
    monkeypatch.setattr(divergence, "PROBE", 1)
    got = sorted(tuple(r) for r in divergence.audit(docs).collect())
    assert got == brute_audit(rows(), 10)


def test_audit_without_kept_terms(docs, none):
    got = sorted(tuple(r) for r in divergence.audit(docs, min_df=10_000).collect())
    assert got == brute_audit(rows(), 10_000) and got and all(r[4] == 0 for r in got)
    assert divergence.audit(none).collect() == []


def test_rare_terms_reach_no_fit(spark, monkeypatch):
    """The fit meets each kept key once, however many documents have it, and no rarer one."""
    fitted = []

    class Counted(divergence.CountVectorizer):
        def _fit(self, dataset):
            fitted.extend(k for r in dataset.collect() for k in r[0])
            return super()._fit(dataset)

    monkeypatch.setattr(divergence, "CountVectorizer", Counted)
    data = [(i, f"often Often rare{chr(97 + i // 9)} {'x' * (i + 1)} tenth{chr(97 + i // 10)}", "en", f"s{i % 3}", 1) for i in range(90)] + [(99, "often", "de", "s1", 1)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    assert sorted(tuple(r) for r in divergence.audit(df).collect()) == brute_audit(data, 10)
    assert sorted(fitted) == ["often\0en", *(f"tenth{chr(97 + i)}\0en" for i in range(9))]


def test_probability_of_huge_counts(spark):
    c, n, v = 9 * 10**15, 10**16, 10**7
    df = spark.createDataFrame([(c, n, v)], "c long, n long, v long")
    assert df.select(divergence.probability(F.col("c"), F.col("n"), F.col("v"))).first()[0] == 1 + 10**9 * (c + 2) // (n + 2 * v)


# ---- mixing ------------------------------------------------------------------------------------------------------

def brute_targets(size):
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, capped = Fraction(3 * sum(size.values()), 2), set()
    while True:
        left = [s for s in order if s not in capped]
        share = total - sum(2 * size[s] for s in capped)
        got = {s: share * weight[s] / sum(weight[x] for x in left) for s in left}
        above = {s for s in left if got[s] > 2 * size[s]}
        if not above:
            return got | {s: Fraction(2 * size[s]) for s in capped}
        capped |= above


def brute_rates(sizes, target):
    total, mean = sum(sizes), sum(sizes) / len(sizes)
    if target >= 2 * total:
        return {s: 2.0 for s in sizes}
    lo, hi = -1e5, 1e5
    rate = lambda lam, s: 2.0 if lam * s / mean >= math.log(2) else math.exp(lam * s / mean)
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(s * rate(mid, s) for s in sizes) < target else (lo, mid)
    return {s: rate((lo + hi) / 2, s) for s in sizes}


def test_mixing(docs):
    m = mixing.mix(docs).collect()
    want = Counter((r[0], len(WORD.findall(r[1] or "")), r[3]) for r in rows())
    assert Counter((r["id"], r["size"], r["source"]) for r in m) == want
    sizes = defaultdict(list)
    for (_, s, src), c in want.items():
        sizes[src] += [s] * c
    target = brute_targets({src: sum(s) for src, s in sizes.items()})
    taken = Counter()
    for r in m:
        assert r["target"] == pytest.approx(float(target[r["source"]])) and 0 <= r["copies"] <= 2
        assert r["source_size"] == sum(sizes[r["source"]])
        taken[r["source"]] += r["size"] * r["copies"]
    for src, own in sizes.items():
        own = [s for s in own if s]
        assert abs(taken[src] - target[src]) <= max(own, default=0) / 2 + 1
        if own:
            rate = brute_rates(own, float(target[src]))
            for r in m:
                if r["source"] == src and r["size"]:
                    assert r["rate"] == pytest.approx(rate[r["size"]], rel=1e-3, abs=1e-6)


def test_mixing_reruns_agree(docs):
    a = sorted(map(tuple, mixing.digests(docs).collect()), key=str)
    assert a == sorted(map(tuple, mixing.digests(docs.repartition(2, "text")).collect()), key=str)


def test_mixing_without_words(spark, none):
    assert mixing.digests(none).collect() == []
    empty = spark.createDataFrame([(1, None, None), (2, " ", "s")], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"]) for r in mixing.digests(empty).collect()] == [(0.0, 0), (0.0, 0)]


def test_mixing_many_rounds_of_caps(spark):
    size = {f"s{i:02d}": 3 ** (i % 9) for i in range(20)}
    df = spark.createDataFrame(list(size.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx({s: float(t) for s, t in brute_targets(size).items()})


# ---- Merkle manifest ---------------------------------------------------------------------------------------------

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def brute_tree(nodes):
    """Top of the nodes, and for every node its (before, after) siblings on the way up."""
    at, proofs = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = nodes[a // 8 * 8:a // 8 * 8 + 8]
            proofs[i].append(("".join(run[:a % 8]), "".join(run[a % 8 + 1:])))
        at = [a // 8 for a in at]
        nodes = [sha("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], proofs


def brute_manifest(data):
    langs = defaultdict(list)
    for r in data:
        langs[r[2]].append((r[0] is not None, r[0] or 0, leaf(*r[:5]), r))
    order = sorted(langs, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in order:
        own = sorted(langs[lang], key=lambda x: x[:3])
        trees[lang] = (own, *brute_tree([x[2] for x in own]))
    root, over = brute_tree([trees[v][1] for v in order])
    out = []
    for lang, up in zip(order, over):
        own, subroot, proofs = trees[lang]
        for (_, _, h, r), way in zip(own, proofs):
            way, text = way + up, r[1]
            odd = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            f = leaf(r[0], text if text is None else text.translate(LOWER), *r[2:5]) if odd else h
            for before, after in way:
                f = sha(before + f + after)
            out.append((r[0], h, subroot, root, sha("".join(b + a for b, a in way)), f, f == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("stride", [1, 2, 3])
def test_manifest(docs, monkeypatch, stride):
    monkeypatch.setattr(merkle, "STRIDE", stride)
    monkeypatch.setattr(merkle, "SPAN", merkle.ARITY ** stride)
    got = sorted((tuple(r) for r in merkle.digests(docs).collect()), key=str)
    want = brute_manifest(rows())
    assert got == want and {r[6] for r in want} == {True, False}


def test_manifest_of_one_row_and_of_none(spark, docs, none, tmpdir_path):
    one = docs.where("doc_id = 905")
    (r,) = merkle.digests(one).collect()
    assert r["root"] == r["subroot"] == r["leaf"] and r["proof_sha256"] == sha("")
    assert merkle.digests(none).collect() == []
    proven = merkle.prove(merkle.leaves(docs).withColumn("leaf", F.col("h")), ["id", "leaf"], f"{tmpdir_path}/manifest")
    assert proven.where(merkle.fold(F.col("path"), F.col("leaf")) != F.col("root")).isEmpty()
    assert spark.read.parquet(f"{tmpdir_path}/manifest/level=3").count() > 0
