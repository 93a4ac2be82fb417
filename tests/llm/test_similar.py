"""The stage of near copies: texts that share 0.8 of their five-word shingles leave one."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vecspark.llm import bpe, simhash


def shingles(text, size=5):
    words = text.lower().split()
    return {tuple(words[i: i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / max(1, len(a | b))


def changed(rng, words, share):
    return [f"w{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


def near_copies(n, share, seed):
    """Pairs (text, changed text) of 30 to 600 words."""
    rng = random.Random(seed)
    for _ in range(n):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(30, 600))]
        yield " ".join(words), " ".join(changed(rng, words, rng.random() * share))


def test_sketch_estimates_the_similarity():
    for text, other in near_copies(40, 0.06, 1):
        a, b = (simhash.sketch(np.unique(simhash.shingle_hashes(t.encode(), 5))) for t in (text, other))
        assert abs(np.mean(a == b) - jaccard(shingles(text), shingles(other))) < 0.15


def test_recall_and_clean_pairs(spark):
    pairs = list(near_copies(400, 0.08, 2))
    rows = [(2 * i + s, t) for i, p in enumerate(pairs) for s, t in enumerate(p)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component"] for r in simhash.group(docs, shingle=5, similar=0.8).collect()}
    near = [i for i, (a, b) in enumerate(pairs) if jaccard(shingles(a), shingles(b)) >= 0.8]
    far = [i for i, (a, b) in enumerate(pairs) if jaccard(shingles(a), shingles(b)) < 0.65]
    caught = [i for i in near if got[2 * i] == got[2 * i + 1]]
    assert len(near) > 60 and len(caught) >= 0.9 * len(near)
    assert len(far) > 60 and not [i for i in far if got[2 * i] == got[2 * i + 1]]
    assert all(got[i] // 2 == i // 2 for i in got)  # nothing else is linked


def test_alike_is_the_closure_of_all_pairs():
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    texts = [" ".join(changed(rng, base, 0.015)) for _ in range(60)] + [a for a, _ in near_copies(20, 0, 4)]
    sketches = [simhash.sketch(np.unique(simhash.shingle_hashes(t.encode(), 5))).astype(np.uint8) for t in texts]
    prints = np.arange(len(texts))
    a, b = simhash.alike(prints, [s.tobytes() for s in sketches], 0.8)
    need = simhash.SKETCH * (0.77 + 0.23 / 256)
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if (sketches[i] == sketches[j]).sum() >= need:
                x, y = group[i], group[j]
                group = [x if g == y else g for g in group]
    mine = list(range(len(texts)))
    for i, j in zip(a.tolist(), b.tolist()):
        x, y = mine[i], mine[j]
        mine = [x if g == y else g for g in mine]
    assert len(a) <= len(texts)
    assert {(i, j) for i in prints for j in prints if group[i] == group[j]} == {(i, j) for i in prints for j in prints if mine[i] == mine[j]}


def test_crowded_keys_and_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF_BLOCK", 16)  # a key of 100 rows is cut into blocks
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows = [(i, " ".join(base[:i] + [f"x{i}"] + base[i:])) for i in range(100)]  # one word more, each elsewhere
    rows += [(200, None), (201, ""), (202, "one"), (203, "One"), (204, "two words"), (None, "two words"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_s", F.lit(1)).withColumn("_k", F.lit("x"))
    kept = simhash.keep_one(docs, shingle=5, similar=0.8)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 200, 202, 204]
    assert simhash.keep_one(docs.where("false"), shingle=5, similar=0.8).count() == 0


def test_encoding_stage_raises_on_a_difference(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "ab cd"), (1, "ab cd"), (2, None), (None, "é")], "doc_id long, text string")
    got = corpus_pipeline.encode(spark, docs, "").collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"] > 0) for r in got) == [(0, True), (1, True), (1, True), (2, False)]
    decode = bpe.decode
    wrong = lambda *a: decode(*a).withColumn("decoded", F.concat("decoded", F.lit(b"x")))
    monkeypatch.setattr(corpus_pipeline.bpe, "decode", wrong)
    with pytest.raises(Exception, match="do not decode"):
        corpus_pipeline.encode(spark, docs, "").collect()
