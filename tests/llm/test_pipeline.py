"""The corpus pipeline against a plain Python version of its five stages."""

import hashlib
import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash

import corpus_pipeline
from strata.llm import chunks, decontaminate, quality_rules, sentencepieces
from strata.llm import tokens as T
from tests.llm.test_operators import SCHEMA, WORD, brute_components, prose

TRUSTED = {3 * i + 1 for i in range(30) if i not in (15, 19, 25)}         # labelled quality 1
ITEM = prose(16, 77)
PASSAGE = prose(70, 78)


def fixture():
    base = prose(150, 20).split()
    texts = [" ".join(base), " ".join(base), " ".join([*base[:-1], "other"]), " ".join(["first", *base]),
             prose(80, 21) + "\n" + PASSAGE, PASSAGE + " " + prose(90, 22), prose(60, 23) + " " + PASSAGE.replace(" ", "\n", 9),
             prose(70, 24) + " " + ITEM + " " + prose(40, 25), ITEM + " " + prose(70, 26), prose(30, 27) + " " + ITEM.upper() + " " + prose(40, 28),
             prose(20, 29), None, "", " \n\t ", "spam word again " * 60, prose(5000, 30), " " + prose(64, 31) + "  \n",
             "é ü ß 日本語 " * 30 + prose(90, 32)]
    texts += [prose(60 + 7 * i, 40 + i) for i in range(12)]
    rows = [(i * 3 + 1, t, "en", f"src{i % 4}", None if t is None else len(t), "clash") for i, t in enumerate(texts)]
    return rows + [rows[20], rows[21]]                                   # repeated rows


def bucket(*words):
    h = 42
    for w in words:
        h = xxhash.xxh64_intdigest(w.encode(), seed=h)
    return (h - (1 << 64) if h >> 63 else h) % quality_rules.N_BUCKETS


def grams(text):
    w = WORD.findall((text or "").lower())
    return [bucket(x) for x in w] + [bucket(*x) for x in zip(w, w[1:])]


def brute_quality(rows, trusted):
    raw, good, n, a = Counter(), Counter(), quality_rules.N_BUCKETS, quality_rules.SMOOTHING
    for r in rows:
        raw.update(grams(r[1]))
        good.update(grams(r[1]) if r[0] in trusted else [])
    all_, ok = sum(raw.values()), sum(good.values())
    for r in rows:
        w, g = WORD.findall(r[1] or ""), grams(r[1])
        tri = Counter(zip(w, w[1:], w[2:]))
        covered = {j for i, x in enumerate(zip(w, w[1:], w[2:])) if tri[x] > 1 for j in (i, i + 1, i + 2)}
        llr = sum(math.log((good[b] + a) / (ok + a * n)) - math.log((raw[b] + a) / (all_ + a * n)) for b in g) / max(len(g), 1)
        if len(w) >= 50 and 100 * len(covered) <= 50 * len(w) and llr >= quality_rules.MIN_LLR:
            yield r


def brute_near(rows):
    group = brute_components([(r[0], r[1]) for r in rows], corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.SIMILAR_PERCENT)
    seen = set()
    for r in sorted(rows, key=lambda r: r[0]):
        if group[r[0]][1] not in seen:
            seen.add(group[r[0]][1])
            yield r


def brute_passages(rows, window=20):
    seen = set()
    for r in sorted(rows, key=lambda r: r[0]):
        found = list(WORD.finditer(r[1]))
        words, gone = [m.group() for m in found], set()
        for k in range(len(words) - window + 1):
            key = tuple(words[k:k + window])
            gone |= set(range(k, k + window)) if key in seen else set()
            seen.add(key)
        ends = [m.start() for m in found[1:]] + [len(r[1])]
        head = r[1][:found[0].start()] if found else r[1]
        text = head + "".join(r[1][m.start():e] for i, (m, e) in enumerate(zip(found, ends)) if i not in gone)
        yield (r[0], text, *r[2:4], len(text), *r[5:])


def brute_leaks(rows):
    item = WORD.findall(ITEM.lower())
    for r in rows:
        w = WORD.findall(r[1].lower())
        if not any(w[i:i + len(item)] == item for i in range(len(w))):
            yield r


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(fixture(), SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in TRUSTED] + [(46, 0, 0), (None, 1, 0)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, prose(20, 99)), (3, None), (4, "")], "item_id long, text string") \
        .write.parquet(f"{path}/benchmark.parquet")
    return path


def test_each_stage_against_plain_python(spark, folder):
    docs, rows = spark.read.parquet(f"{folder}/documents.parquet"), fixture()
    brute = [lambda r: brute_quality(r, TRUSTED), brute_near, brute_passages, brute_leaks]
    for (name, stage), plain in zip(corpus_pipeline.STAGES, brute):
        made = stage(spark, docs, folder)
        assert made.columns == docs.columns, name
        docs = chunks.write_table(made, "stage")
        want = sorted(plain(rows))
        assert 0 < len(want) < len(rows) or name == "substring dedup", name
        rows = sorted(map(tuple, docs.collect()))
        assert rows == want, name
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for r in rows:
        ids = library.encode(r[1], add_eos=True)
        want.append((r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    got = [(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
           for r in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(got) == sorted(want)


def test_no_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = chunks.write_table(stage(spark, docs, folder), "stage")
        assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")] and docs.isEmpty()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).isEmpty()


def test_packed_arrays_round_trip():
    r = np.random.default_rng(0)
    for a in (np.zeros(0, np.uint64), r.integers(0, 1 << 60, 999), r.integers(0, 200, 70).astype(np.uint8), np.arange(3, dtype=np.int32),
              r.random(50), r.random(500) < 0.5):
        for back in chunks.spread(memoryview(chunks.squeeze(a, a))):
            assert back.dtype == a.dtype and (back == a).all()


def peak(fn):
    """Most bytes that numpy and Python held at once for ``fn()``."""
    tracemalloc.start()
    try:
        fn()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_of_a_chunk_is_bounded(spark):
    rnd = random.Random(5)
    texts = pa.array([" ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) for _ in range(9_000))
                      for _ in range(20)])
    size = len(T.buffers(texts)[0])
    none = np.zeros(decontaminate.FILTER_BITS // 32, np.uint32)
    t = decontaminate.Templates(texts)
    few = peak(lambda: t.windows([8], lambda x: decontaminate.passes(x, none)))
    many = peak(lambda: t.windows(list(range(1, 9)), lambda x: decontaminate.passes(x, none)))
    assert many < 1.2 * few                              # windows of one length and kind at a time
    assert peak(lambda: decontaminate.Templates(texts)) < 25 * size
    m = sentencepieces.model(public_tokenizers.path("piece_bpe_32k.model"))
    rows = pa.RecordBatch.from_arrays([texts], names=["text"])
    parts = list(T.slices(rows, "text", sentencepieces.SLICE))
    assert peak(lambda: [len(sentencepieces.encoded(m, x, "text")) for x in parts]) < 100 * sentencepieces.SLICE
    chunks.pack(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20
