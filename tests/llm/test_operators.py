"""Each operator against a brute-force version on rows with nulls, empties, long texts, ties, repeats and clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from strata.llm import (chat_format, components, decontaminate, html_extract, jaccard_join, language_id, pitman_yor,
                        quality_rules, sentencepieces, substring_dedup, toxicity)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
rnd = random.Random(5)
VOCABULARY = ["".join(rnd.choice("abcdeghilnorst") for _ in range(rnd.randint(2, 8))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def corpus():
    base = prose(120, 1)
    words = base.split()
    passage = prose(60, 2)
    texts = [base, base, base.upper(), " ".join(words[:-1]), " ".join([*words, "tail"]), None, "", "   \n\t ", "one", "one two",
             "One two", "the " * 500, "x" * 40_000, prose(6000, 3), passage + " " + prose(30, 4), prose(40, 5) + "\n" + passage,
             passage + "\u000b" + passage, "é ü ß 日本語 " * 20, "a b c d e", prose(90, 6)]
    texts += [" ".join(w if i != k else "changed" for i, w in enumerate(words)) for k in (10, 60, 100)]
    rows = [(i, t, "en", "src0", 0, "clash") for i, t in enumerate(texts)]
    return rows + [(None, base, "en", "src0", 0, "clash"), (7, "   \n\t ", "en", "src0", 0, "clash")]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def shingle_set(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(rows, k, percent):
    ids = {i: shingle_set(t, k) for i, t in rows if i is not None}
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and ids[a] and ids[b]:
                both = len(ids[a] & ids[b])
                if 100 * both >= percent * len(ids[a] | ids[b]):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(ids[i]), find(i)) for i in ids}


def test_jaccard_join(docs):
    want = brute_components([(r[0], r[1]) for r in corpus()], 4, 85)
    got = jaccard_join.classes(docs, 4, 85).collect()
    assert len(got) == len(corpus())
    for r in got:
        assert (r["n_shingles"], r["component"]) == (want[r["id"]] if r["id"] is not None else (r["n_shingles"], None))


def test_jaccard_join_cuts_large_families(spark):
    base = prose(40, 9).split()
    texts = [" ".join(base)] + [" ".join(w if i != k else f"n{k}" for i, w in enumerate(base)) for k in range(40)]
    texts += [" ".join([*base[:k], f"m{k}", *base[k:]]) for k in range(0, 40, 3)]
    rows = list(enumerate(texts))
    want = brute_components(rows, 4, 75)
    got = jaccard_join.classes(spark.createDataFrame(rows, "doc_id long, text string"), 4, 75, block=7).collect()
    assert {r["id"]: (r["n_shingles"], r["component"]) for r in got} == want


def test_tree_equals_all_pairs():
    import numpy as np
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 60, n).astype(np.uint64)) for n in r.integers(1, 40, 120)]
    comp = jaccard_join.link(sets, list(range(120)), 60)
    root = list(range(120))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(120):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 60 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    groups = defaultdict(set)
    for i in range(120):
        groups[find(i)].add(i)
    got = defaultdict(set)
    for i in range(120):
        got[comp[i]].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_a_block_leaves_nothing_behind():
    """Blocks of a task follow each other; what one held is free before the next, without a search for cycles."""
    import gc
    import weakref
    import numpy as np
    sets = [np.unique(np.random.default_rng(i // 3).integers(0, 2**63, 200).astype(np.uint64)) for i in range(90)]
    gc.collect()
    gc.disable()
    try:
        jaccard_join.link(sets, list(range(90)), 80)
        last = weakref.ref(sets.pop())
        sets.clear()
        assert last() is None
    finally:
        gc.enable()


def test_stored_sets_are_not_copied(monkeypatch):
    import numpy as np
    import pyarrow as pa
    rnd = np.random.default_rng(5)
    sets = [np.unique(rnd.integers(0, 2**63, n).astype(np.uint64)) for n in (3, 0, 700, 41)]
    col = pa.chunked_array([pa.array([s.tobytes() for s in part], pa.binary()) for part in (sets[:1], sets[:3], sets)])
    got = jaccard_join.stored_sets(col.slice(2))
    want = (sets[:1] + sets[:3] + sets)[2:]
    assert len(got) == len(want) and all((a == b).all() and len(a) == len(b) for a, b in zip(got, want))
    assert not any(g.flags.owndata for g in got if len(g))
    # pivots compare a piece of the block at a time and find the same
    sets = [s for s in sets if len(s)]
    size = np.array([len(s) for s in sets * 5])
    roots = []
    for piece in (1 << 19, 100):
        monkeypatch.setattr(jaccard_join, "PIECE", piece)
        root = np.arange(15)
        jaccard_join.pivot_links(sets * 5, size, root, 80)
        roots.append(root.tolist())
    assert roots[0] == roots[1]


def test_large_families_are_looked_at_again(spark, monkeypatch):
    """A crowded sketch can't tell rare shingles and runs texts together; with a sketch of their own they come apart."""
    rows = []
    for i in range(60):
        own, rnd = prose(60, 1000 + i).split(), random.Random(i)
        rows += [(3 * i, " ".join(own)), (3 * i + 1, " ".join(own[:58])),
                 (3 * i + 2, " ".join(own[:30] + prose(20, 7 + i % 4).split() + [str(rnd.random()) for _ in range(40)]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    wide = jaccard_join.SKETCH
    monkeypatch.setattr(jaccard_join, "SKETCH", 64)
    monkeypatch.setattr(jaccard_join, "MOST_CELLS", 64)
    seen, plain = [], jaccard_join.apart

    def apart(members, n_buckets, percent, block):
        monkeypatch.setattr(jaccard_join, "SKETCH", wide)
        monkeypatch.setattr(jaccard_join, "MOST_CELLS", wide)
        whole, cut = plain(members, n_buckets, percent, block)
        seen.append((members.where("cut > 1").count(), cut.count()))
        return whole, cut

    monkeypatch.setattr(jaccard_join, "apart", apart)
    got = jaccard_join.classes(df, 3, 80, block=10).collect()
    assert {r["id"]: (r["n_shingles"], r["component"]) for r in got} == brute_components(rows, 3, 80)
    assert seen[0][0] > 0 and seen[0][1] == 0


def test_blocks_are_bounded_by_their_shingles(spark, monkeypatch):
    """Few sets with many shingles are cut too, also where the sets of blocks meet."""
    rows = [(i, " ".join(prose(80, 3).split()[: 60 + i])) for i in range(20)] + [(100 + i, prose(70, 50 + i)) for i in range(5)]
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 200)
    got = jaccard_join.classes(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80).collect()
    assert {r["id"]: (r["n_shingles"], r["component"]) for r in got} == brute_components(rows, 3, 80)
    families = spark.createDataFrame([(n, 1, 90) for n in range(9)], "node long, family long, n long")
    assert {r["cut"] for r in jaccard_join.place(families, 8000).collect()} == {5}


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 150), (300, 300), (7, 3)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 150: 100, 200: 100}


def brute_removed(rows, window=20):
    seen, out = set(), {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            if key in seen:
                gone[k:k + window] = [True] * window
            seen.add(key)
        out.setdefault(i, (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return out


def test_substring_dedup(docs):
    want = brute_removed([(r[0], r[1]) for r in corpus()])
    got = substring_dedup.digests(docs).collect()
    assert len(got) == len(corpus())
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == want[r["doc_id"]]
    cut = {r["doc_id"]: r for r in substring_dedup.remove_repeats(docs, chars="n_chars").collect()}
    assert cut[5]["text"] is None and cut[1]["text"] == "" and cut[0]["text"] == corpus()[0][1]
    assert cut[15]["text"].split() == corpus()[15][1].split()[:40] and cut[15]["row"] == "clash"


def test_recompression_is_local():
    import numpy as np
    r = np.random.default_rng(1)
    w = r.integers(0, 30, 400).astype(np.uint64)
    a = substring_dedup.recompress(w, np.array([0, 400]))
    b = substring_dedup.recompress(np.r_[r.integers(0, 30, 57).astype(np.uint64), w[100:300]], np.array([0, 257]))
    inside = {(n, lo - 100, hi - 100) for n, lo, hi in zip(*a) if lo >= 100 and hi <= 300}
    other = {(n, lo - 57, hi - 57) for n, lo, hi in zip(*b) if lo >= 57 and hi <= 257}
    assert inside == other and len(inside) > 20


def test_quality_rules(spark, docs):
    trusted = spark.createDataFrame([(19,), (13,), (None,), (999,)], "doc_id long")
    got = quality_rules.measure(docs, trusted).select("row.doc_id", "row.text", "*").collect()
    assert len(got) == len(corpus())
    for r in got:
        t = r["text"] or ""
        w = WORD.findall(t)
        tri = Counter(zip(w, w[1:], w[2:]))
        covered = {j for i, x in enumerate(zip(w, w[1:], w[2:])) if tri[x] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert r["kept"] == (not r["base_failed"] and r["llr"] >= quality_rules.MIN_LLR)
    kept = quality_rules.keep(docs, trusted)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in got)
    no_trust = quality_rules.measure(docs, trusted.limit(0)).select("llr").distinct().collect()
    assert [r["llr"] for r in no_trust] == [0.0]


def test_sentencepieces(docs):
    import public_tokenizers
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = {r[0]: r[1] or "" for r in corpus() if r[0] is not None}
    enc = sentencepieces.encode(docs, path)
    back = {r["doc_id"]: r["text"] for r in sentencepieces.decode(enc, path).collect()}
    for r in enc.collect():
        if r["doc_id"] is not None:
            assert r["ids"] == library.encode(texts[r["doc_id"]], add_eos=True)
            assert back[r["doc_id"]] == library.decode(r["ids"])
    for r in sentencepieces.digests(docs, path).collect():
        if r["doc_id"] is not None:
            ids = library.encode(texts[r["doc_id"]], add_eos=True)
            assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
                len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(library.decode(ids).encode()).hexdigest())


def test_sentencepieces_hard_texts():
    import numpy as np
    import pyarrow as pa
    import public_tokenizers
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    library, m = sentencepiece.SentencePieceProcessor(model_file=path), sentencepieces.model(path)
    texts = ["a" * 1500, "ab" * 700 + " x", "x▁y ▁ z", "😀 emoji‍", "</s> <s> <unk> <0x0A>", " " * 700, "\r\n\x0b\x0c",
             "a\n\n\n b\n \n", "1234567890 3.14", "\x00", "ﷺ ﬁ Ａ"]
    rows = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    ids, at, which, off = sentencepieces.encoded(m, rows, "text")
    for t, a, b in zip(texts, off[:-1], off[1:]):
        got = [int(x) for w in which[a:b] for x in ids[at[w]:at[w + 1]]]
        assert got == library.encode(t)
        assert m.decode_ids(got) == library.decode(got)
    r = np.random.default_rng(0)
    for _ in range(20):
        some = [int(i) for i in r.integers(3, 32000, 30)]
        assert m.decode_ids(some) == library.decode(some)


def test_decontaminate(spark, docs):
    item = "A train leaves Paris at 60 km per hour and after 3 hours it meets Anna near the old stone bridge over 40 fields ."
    same = item.replace("60", "75").replace("Paris", "Rome").replace("Anna", "Maria")
    wrong = "At 5 the pair of 5 red kites flew over 5 green hills while 5 boys ran along behind them all day"
    contra = wrong.replace("5", "6", 1).replace("5", "7", 1)
    bench = spark.createDataFrame([(1, item), (2, wrong), (3, None), (4, ""), (5, "4 5 6")], "item_id long, text string")
    rows = corpus() + [(100, prose(50, 30) + ". " + item + " " + prose(20, 31), "en", "s", 0, ""), (101, same, "en", "s", 0, ""),
                       (102, contra, "en", "s", 0, ""), (103, prose(80, 32), "en", "s", 0, ""), (None, item, "en", "s", 0, "")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontaminate.contaminated(df, bench).collect()}
    assert got == {(100, 1): "copy", (101, 1): "reworded", (None, 1): "copy"}
    left = decontaminate.clean(df, bench)
    assert left.columns == df.columns and left.count() == len(rows) - 3
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0


def test_decontaminate_short_and_number_items(spark):
    numbers = "Compute 12 + 30 + 45 + 61 + 7 + 98 + 15 + 22 + 4 ."
    mixed = "Take the old stone bridge road north to Anna Berg Carl Dorn Emil Falk 12 14 16 18 20 22 24 26"
    bench = spark.createDataFrame([(1, "purple otters juggle teapots"), (2, numbers), (3, mixed)], "item_id long, text string")
    around = lambda t: prose(40, 60) + ". " + t + " " + prose(40, 61)
    rows = [(1, around("purple otters juggle teapots")), (2, around(numbers)), (3, around(numbers.replace("45", "46"))),
            (4, around("Take the old stone bridge road north to")), (5, around(mixed)), (6, around(mixed.replace("12 14", "13 17"))),
            (7, "purple otters juggle"), (8, around("purple otters never juggle teapots"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontaminate.contaminated(df, bench).collect()}
    assert got == {(1, 1): "copy", (2, 2): "copy", (3, 2): "reworded", (5, 3): "copy", (6, 3): "reworded"}


def test_pitman_yor(spark, docs):
    held = language_id.remainder("doc_id", 7) == 2
    got = pitman_yor.score(docs, held).collect()
    learn, c = [], Counter()
    for i, t, *_ in corpus():
        w = [*WORD.findall((t or "").translate(LOWER)), None]
        out = i is not None and zlib.crc32(str(i).encode()) % 7 == 2
        learn.append((i, w, out))
        if not out:
            c.update(w)
    n, v = sum(c.values()), len(c)
    want = {i: (out, len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
            for i, w, out in learn}
    assert len(got) == len(corpus())
    for r in got:
        e = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == e[:4]
        assert r["base_score"] == pytest.approx(e[4]) and r["score"] < 0
    assert sum(r["score"] for r in got if not r["held_out"]) > sum(r["base_score"] for r in got if not r["held_out"])


def test_pitman_yor_probabilities_sum_to_one(spark):
    """Over all continuations of one context, one unseen word included, the model's chances add up to one."""
    words = ["a b", "a b", "a c", "a d", "b a"]
    rows = [(i, t, False) for i, t in enumerate(words)] + [(10 + i, f"a {w}", True) for i, w in enumerate(["a", "b", "c", "d", "zz"])]
    rows += [(20, "a", True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held boolean")
    got = {r["doc_id"]: r["score"] for r in pitman_yor.score(df.select("doc_id", "text", "held"), df["held"]).collect()}
    one = spark.createDataFrame(rows + [(30 + i, w, True) for i, w in enumerate(["a", "b", "c", "d", "zz"])], "doc_id long, text string, held boolean")
    assert len(got) == len(rows) and one.count() == len(rows) + 5
    ends = {w: got[10 + i] for i, w in enumerate(["a", "b", "c", "d", "zz"])}
    assert ends["b"] > ends["zz"]


def test_seating_matches_the_restaurant_rule():
    import numpy as np
    r = np.random.default_rng(2)
    count = np.full(20_000, 5)
    t = pitman_yor.seat(r, count, np.full(20_000, 0.8), 0.5)
    # expected tables by the rule, one customer at a time
    p = {1: 1.0}
    for n in range(1, 5):
        q = defaultdict(float)
        for k, x in p.items():
            new = 0.8 / (n - 0.5 * k + 0.8)
            q[k + 1] += x * new
            q[k] += x * (1 - new)
        p = q
    assert t.mean() == pytest.approx(sum(k * x for k, x in p.items()), rel=0.02)


def test_language_id(spark, none):
    alphabets = {"aa": "abcd", "bb": "efgh", "cc": "ijkl"}
    r = random.Random(4)
    rows = [(i, " ".join("".join(r.choice(alphabets[g]) for _ in range(5)) for _ in range(30)), g)
            for i, g in enumerate(list(alphabets) * 40)] + [(900, None, "aa"), (901, "12 34 !", "aa"), (902, "", None), (None, "abc", "aa")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = language_id.remainder("doc_id", 4) == 2
    model = language_id.train(df.where(~held))
    got = language_id.predict(df, model).collect()
    assert len(got) == len(rows)
    for x in got:
        assert 0 <= x["score"] <= 1
        if x["doc_id"] in (900, 901, 902):
            assert (x["lang_pred"], x["score"]) == ("und", 0.0)
        elif x["doc_id"] is not None:
            assert x["lang_pred"] == rows[x["doc_id"]][2]
    assert language_id.train(none) is None
    assert {x["lang_pred"] for x in language_id.predict(df, None).collect()} == {"und"}


def test_toxicity(spark):
    bad = ["vilewretch", "foulscum", "dirtfiend"]
    rows, labels = [], []
    for i in range(400):
        w = prose(60, 1000 + i).split()
        if i % 4 == 0:
            for k in (5, 20, 33, 50):
                w[k] = bad[(i // 4 + k) % 3]
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    rows += [(900, None), (901, ""), (902, " \n"), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(None, 1)], "doc_id long, toxic int")
    model = toxicity.train(df, lab.where("doc_id % 3 <> 1"))
    got = {r["doc_id"]: r for r in toxicity.predict(df, model).collect()}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got.values())
    held = [i for i in range(400) if i % 3 == 1]
    assert sum(got[i]["predicted"] == int(i % 4 == 0) for i in held) >= 0.95 * len(held)
    assert got[900]["score"] == got[901]["score"] == got[902]["score"] < 0.7
    empty = toxicity.train(df, lab.limit(0))
    assert {r["score"] for r in toxicity.predict(df, empty).collect()} == {0.0}


def test_toxicity_learns_rare_marks():
    def texts(n, seed, marks=()):
        out = []
        for i in range(n):
            w = prose(60, seed + i).split()
            for k in (5, 20, 33, 50) if marks else ():
                w[k] = marks[(i + k) % len(marks)]
            out.append(" ".join(w))
        return out

    rare = texts(6, 7000, ["zorkquam", "plixwump"])             # 2.4 % of the toxic documents
    model = toxicity.fit(texts(244, 5000, ["vilewretch", "foulscum", "dirtfiend"]) + rare, texts(1000, 3000))
    assert b"zorkquam" in model.parts[1] and b"plixwump" in model.parts[1]
    scores = lambda some: model.scores(*toxicity.T.buffers(toxicity.pa.array(some)))
    assert (scores(texts(10, 8000, ["zorkquam", "plixwump"])) >= 0.7).all()
    assert (scores(texts(100, 9000)) < 0.7).mean() >= 0.95


PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/">Home</a></li><li><a href="/b">B</a></li></ul></nav><!-- <p>no</p> --><div class="cookie-notice">We use
cookies</div><div class="ad">Buy</div><article><header><h1>%s</h1></header><p>First   &eacute;&nbsp;%d
line<p>Second <b>bold</b> x&lt;y<br>z<aside>Also read</aside><p>Third</p><form><p>mail</p></form>
<section class="comments"><article class="comment"><p>me too</p></article></section></article><div id="sidebar"><p>side</p></div>
<footer>&copy; us</footer></body></html>"""


def test_html_extract(spark):
    rows = [(i, f"https://www.a{i % 3}.org/x{i}", PAGE % (f"Title {i}", i)) for i in range(12)]
    rows += [(50, None, None), (51, "http://a1.org", ""), (52, "http://a1.org/z", "<article><p>cut off <b>he"), (0, rows[0][1], rows[0][2]),
             (53, "http://plain.org", "<body><div>only text</div><div>and &#233; more</div></body>"), (None, None, "<p>q</p>")]
    got = html_extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows)
    for r in got:
        i = r["page_id"]
        want = {50: "", 51: "", 52: "cut off he", 53: "only text\nand é more", None: "q"}.get(
            i, f"Title {i}\nFirst é {i} line\nSecond bold x<y z\nThird")
        assert r["text"] == want and r["n_chars"] == len(want)


def test_html_classes_and_unclosed_tags():
    def text(page):
        found = html_extract.blocks(page)
        return [t for path, t, _ in found if not html_extract.outside(path) and html_extract.holds(path)]

    inner = "<div class='article-header'><h1>Title</h1></div><p>One</p><svg width='1'/><p>Two</p><button>Like<p>Three</p>"
    for body, wrap, art in (("single no-sidebar", "main-area", "x"), ("x", "layout with-sidebar", "x"), ("x", "x", "post has-comments")):
        page = f"<body class='{body}'><div class='{wrap}'><article class='{art}'>{inner}</article></div><div class='sidebar'>no</div>"
        assert [t for t in text(page) if t != "Like"] == ["Title", "One", "Two", "Three"]
    assert text("<article><p>a</p><button>Share</button><svg><text>s</text></svg><p>b</p><div class='comments'>c</div></article>") == ["a", "b"]


def template_pages(n):
    r = random.Random(12)
    rows = []
    for i in range(n):
        parts = [f"<p>{prose(12, 100 * i + k)}</p>" if r.random() < 0.6 else f"<h2>{prose(3, 100 * i + k)}</h2>" for k in range(6)]
        rows.append((i, "http://hot.org/x", f"<article id='post-{i}'><h1>Title {i}</h1><div class='box'>Our terms apply</div>"
                     f"{''.join(parts)}<p>Tell your friends</p><ul><li><a href='/a{i}'>Item {i}</a><li><a href='/b{i}'>Other {i}</a></ul>"
                     f"<blockquote>Kept {i}</blockquote></article>"))
    return rows


def test_html_labels_have_the_size_of_a_template(spark):
    pages = spark.createDataFrame(template_pages(60), "page_id long, url string, html string").repartition(3)
    (row,) = html_extract.wrappers(pages).collect()
    assert sum(len(row[c] or ()) for c in ("paths", "texts", "linked", "mixed")) <= 12


def test_html_template_inside_articles(spark):
    rows = template_pages(30)
    same = [(100 + i, "http://same.org", f"<aside>{i}</aside><article><p>Only this</p></article>") for i in range(4)]
    got = {r["page_id"]: r["text"] for r in html_extract.main_text(
        spark.createDataFrame(rows + same + rows[:3], "page_id long, url string, html string")).collect()}
    for i, _, page in rows:
        want = [t for _, t, _ in html_extract.blocks(page) if t not in ("Our terms apply", "Tell your friends", f"Item {i}", f"Other {i}")]
        assert got[i].split("\n") == want and want[-1] == f"Kept {i}"
    assert {got[100 + i] for i in range(4)} == {"Only this"}


def test_wrapper_alignment():
    items = lambda s: [[c, 0, 0, 1, 0] for c in s]
    got = html_extract.align(items("abd"), items("acd"))
    assert [(x[0], x[1]) for x in got] == [("a", 0), ("b", 1), ("c", 1), ("d", 0)]
    assert [x[:3] for x in html_extract.skeleton([("p", "x", 0), ("p", "y", 0), ("q", "z", 0), ("p", "x", 0), ("q", "x", 0)])] == [
        ["p", 0, 1], ["q", 0, 1]]


def test_chat_format(spark):
    long_ = [("u" if i % 2 else "a", f"t{i}") for i in range(600)]
    convs = {1: long_[:2], 2: long_[:5], 3: long_[:5], 4: long_, 5: [("u", "other")], 6: long_[1:4], 7: [("u", None), (None, "x")],
             8: [("u", None)], 9: long_[:300], 10: [("u", "")]}
    rows = [(c, i, r, t) for c, m in convs.items() for i, (r, t) in enumerate(m)] + [(None, 0, "u", "lost"), (5, 0, "u", "other")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = chat_format.render(df).collect()
    chats = defaultdict(str)
    for r in sorted(got, key=lambda r: (r["conv_id"], r["part"])):
        chats[r["conv_id"]] += r["chat"]
    assert set(chats) == {4, 5, 6, 7, 10}
    for c in chats:
        assert chats[c] == "".join(f"<|{r or ''}|>\n{t or ''}<|end|>\n" for r, t in convs[c])
    assert {r["n_turns"] for r in got if r["conv_id"] == 4} == {600}
    assert len([r for r in got if r["conv_id"] == 4]) == 3


def test_empty_tables(spark, none):
    import public_tokenizers
    assert jaccard_join.classes(none).count() == 0
    assert substring_dedup.digests(none).count() == 0
    assert pitman_yor.score(none, language_id.remainder("doc_id", 7) == 2).count() == 0
    assert sentencepieces.digests(none, public_tokenizers.path("piece_bpe_32k.model")).count() == 0
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(none, bench).count() == 0
    assert quality_rules.keep(none, none.select("doc_id")).count() == 0
    assert html_extract.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert chat_format.render(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
