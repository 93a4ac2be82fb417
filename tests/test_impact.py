"""Top-k over stored postings, by tiers, against all postings and plain computation."""

import random

import pytest
from pyspark.sql import functions as F

from vecspark.operators import fts, impact, sparse


def test_needed_tiers_leave_out_no_row():
    rng = random.Random(1)
    for _ in range(200):
        tiers = [impact.Tier(t, i, 1, rng.random() * 4) for t in "abc" for i in range(6)]
        bar = rng.random() * 8
        read = set(impact.needed(tiers, bar))
        for _ in range(100):  # a row has one posting of some terms
            own = [rng.choice([x for x in tiers if x.term == t]) for t in "abc" if rng.random() < 0.7]
            if sum(x.bound for x in own) >= bar:
                assert read & set(own)


@pytest.fixture(scope="module")
def vectors(spark, tmp_path_factory):
    rng = random.Random(2)
    rows = {i: {t: rng.choice([-1, 1, 1, 1]) * round(rng.paretovariate(1.5), 3) for t in rng.sample(range(30), 6)} for i in range(1500)}
    rows[7] = {1: 0.0}
    df = spark.createDataFrame(list(rows.items()), "id long, v map<int,float>")
    path = str(tmp_path_factory.mktemp("impact") / "index")
    sparse.write_index(sparse.sparse_postings(df, "v", "id"), path, 4)
    return df, path


@pytest.mark.parametrize("query,k,metric", [
    ({1: 1.0, 2: 0.5, 3: 2.0}, 5, "neg_ip"), ({1: 1.0, 2: -0.5}, 5, "neg_ip"), ({4: 1.0, 5: 1.0}, 5, "ip"),
    ({9: 1.0}, 700, "neg_ip"), ({99: 1.0}, 3, "neg_ip"), ({1: 1.0, 2: 1.0}, 0, "neg_ip"),
])
def test_sparse_index_equals_all_postings(spark, vectors, query, k, metric):
    df, path = vectors
    want = sparse.sparse_topk(df, sparse.sparse_postings(df, "v", "id"), query, k, "id", metric)
    got = sparse.index_topk(df, path, query, k, "id", metric, buckets=4)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]


def test_low_tiers_are_not_read(spark, vectors, monkeypatch):
    df, path = vectors
    read = []
    needed = impact.needed
    monkeypatch.setattr(impact, "needed", lambda tiers, bar: read.append((tiers, needed(tiers, bar))) or read[-1][1])
    sparse.index_topk(df, path, {1: 1.0, 2: 1.0}, 3, "id", buckets=4).collect()
    (every, some), = read
    assert sum(t.n for t in some) < 0.3 * sum(t.n for t in every)
    stored = sparse.read_terms(spark, f"{path}/postings", [1, 2], "int", 4).where(impact.of_tiers(some))
    plan = stored._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(tier" in plan and stored.count() == sum(t.n for t in some)


def test_text_index_topk_follows_changes(spark, tmp_path):
    rng = random.Random(3)
    words = ["red", "green", "blue", "grey"] + [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(600)] + [(900, ""), (901, None)]
    df = spark.createDataFrame(rows, "id long, t string")
    index = fts.TextIndex.build(df.where("id < 300"), "t", "id", str(tmp_path / "i")).append(df.where("id >= 300"))
    for now, rows_now in ((index, df), (index.remove(df.where("id % 3 = 0").select("id")), df.where("id % 3 <> 0"))):
        for query, k in (("red green", 4), ("blue w1 w2 w3", 10), ("nothing", 3), ("red", 590)):
            want = fts.bm25_topk(rows_now, query, "t", "id", k).withColumn("score", F.round("score", 9))
            got = now.topk(query, k).withColumn("score", F.round("score", 9))
            assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()], (query, k)
