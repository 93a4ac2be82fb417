import random

import numpy as np
import pytest

from vecspark.operators import centres, ivf, knn, search
from vecspark.session import scratch_path

@pytest.fixture(scope="module")
def clusters(spark):
    rng = random.Random(11)
    centres = [[rng.uniform(-1, 1) for _ in range(16)] for _ in range(12)]
    rows = []
    for i in range(1500):
        c = centres[0] if i % 3 == 0 else centres[i % 12]  # one list holds a third of the rows
        rows.append((i, [x + rng.gauss(0, 0.15) for x in c], i % 5))
    return spark.createDataFrame(rows, "id long, v array<float>, tag int").repartition(6).cache()


QUERIES = [[random.Random(s).uniform(-1, 1) for _ in range(16)] for s in range(5)]


def exact(df, q, k, metric="l2", where=None):
    return [r["id"] for r in search.ann_search(df, q, "v", metric, k, "id", where, ["id"]).collect()]


@pytest.fixture(scope="module")
def indexes(spark, clusters):
    return {
        kind: ivf.build(clusters, "v", "id", scratch_path(spark, kind), kind, nlist=20, m=4 if kind == "pq" else None)
        for kind in ivf.KINDS
    }


@pytest.mark.parametrize("kind", ivf.KINDS)
def test_small_table_with_copies_gives_the_exact_answer(spark, kind):
    rows = [(7 * i + 3, [2.0, -1.0, 0.5, 4.0] if i % 2 else [0.25 * i, 0.0, 0.0, 0.0]) for i in range(11)]
    df = spark.createDataFrame(rows, "id int, embedding array<float>")
    index = ivf.build(df, "embedding", "id", scratch_path(spark, "small"), kind, m=2 if kind == "pq" else None)
    found = ivf.search(spark, index, [0.0, 0.0, 0.0, 0.0], 4, nprobe=index.nlist).collect()
    assert [(r["id"], r["distance"]) for r in found] == [(3, 0.0), (17, 0.5), (31, 1.0), (45, 1.5)]


def test_full_probe_is_exact(spark, clusters, indexes):
    index = indexes["flat"]
    for q in QUERIES:
        found = [r["id"] for r in ivf.search(spark, index, q, 10, nprobe=index.nlist).collect()]
        assert found == exact(clusters, q, 10)


@pytest.mark.parametrize("kind", ivf.KINDS)
def test_recall_at_the_default_probe(spark, clusters, indexes, kind):
    """Ten neighbours of rows that the build did not tune on, of which at least nine in ten are found."""
    assert 1 <= indexes[kind].default_nprobe < indexes[kind].nlist
    hits, asked = 0, clusters.where("id % 100 = 7").collect()
    for row in asked:
        found = {r["id"] for r in ivf.search(spark, indexes[kind], row["v"], 10).collect()}
        hits += len(found & set(exact(clusters, row["v"], 10)))
    assert hits / (10 * len(asked)) >= 0.9


@pytest.mark.parametrize("metric", ["cosine", "neg_ip"])
def test_other_metrics(spark, clusters, metric):
    index = ivf.build(clusters, "v", "id", scratch_path(spark, metric), "sq8", metric, nlist=8)
    found = {r["id"] for r in ivf.search(spark, index, QUERIES[0], 10, nprobe=8, rerank=20).collect()}
    assert len(found & set(exact(clusters, QUERIES[0], 10, metric))) >= 9


def test_batch_search_with_full_probe(spark, clusters, indexes):
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id int, vector array<float>")
    got = ivf.knn(queries, spark, indexes["flat"], 5, nprobe=20).collect()
    for i, q in enumerate(QUERIES):
        assert [r["id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == i] == exact(clusters, q, 5)


def test_batch_search_beyond_the_broadcast(spark, clusters, indexes, monkeypatch):
    monkeypatch.setattr(knn, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(knn, "SLICE_ROWS", 3)  # several blocks of queries, many slices
    few = clusters.where("id < 60")
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id int, vector array<float>")
    flat = ivf.build(few, "v", "id", scratch_path(spark, "few"), nlist=3)
    for got in (knn.knn_join(queries, few, 5, base_vector="v", max_query_bytes=128), ivf.knn(queries, spark, flat, 5, nprobe=3)):
        rows = got.collect()
        for i, q in enumerate(QUERIES):
            assert [r["id"] for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == i] == exact(few, q, 5)


@pytest.mark.parametrize("beyond", [False, True])
def test_batch_search_by_groups_of_lists(spark, clusters, indexes, monkeypatch, beyond):
    """A query meets exactly the rows of its lists, and its vector is sent once a group, not once a list."""
    sent = []
    dealt = knn.visit_packer
    monkeypatch.setattr(knn, "visit_packer", lambda *a: sent.append(a[-1]) or dealt(*a))
    if beyond:
        monkeypatch.setattr(knn, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(knn, "GROUPS", 4)
        monkeypatch.setattr(knn, "SLICE_ROWS", 150)  # the list with a third of the rows is cut
        monkeypatch.setattr(ivf, "CENTRE_BYTES", 0)  # centres meet the queries in a join
    index = indexes["flat"]
    asked = clusters.where("id % 50 = 3").selectExpr("id AS query_id", "v AS vector")
    got = ivf.knn(asked, spark, index, 5, nprobe=7).collect()
    for q in asked.collect():
        near = [r["id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q["query_id"]]
        assert near == [r["id"] for r in ivf.search(spark, index, q["vector"], 5, nprobe=7).collect()]
    assert len(sent) == 1 and len(set(sent[0][sent[0] >= 0])) <= (4 if beyond else 32)


def test_groups_of_lists_hold_about_equal_rows():
    group = knn.group_lists({0: 10, 1: 10, 3: 500, 4: 10, 6: 470}, 4).tolist()
    assert group == [0, 0, -1, 0, 2, -1, 2]
    assert knn.group_lists({}, 4).tolist() == []


def test_batch_search_of_a_quantised_index(spark, clusters, indexes):
    queries = clusters.where("id % 100 = 7").selectExpr("id AS query_id", "v AS vector")
    got = ivf.knn(queries, spark, indexes["pq"], 5).collect()
    rows, hits = queries.collect(), 0
    for row in rows:
        hits += len({r["id"] for r in got if r["query_id"] == row["query_id"]} & set(exact(clusters, row["vector"], 5)))
    assert len(got) == 5 * len(rows) and hits / len(got) >= 0.9


def test_centres_of_large_cells_and_many_lists(spark, clusters, monkeypatch):
    monkeypatch.setattr(centres, "SLICE_ROWS", 40)  # cells in several tasks
    monkeypatch.setattr(centres, "CELL_ROWS", 100)
    monkeypatch.setattr(centres, "SAMPLES_PER_COARSE", 8)
    index = ivf.build(clusters, "v", "id", scratch_path(spark, "many"), nlist=200)
    tree = index.quantiser(spark).centres
    assert sum(index.sizes) == 1500 and len(tree.coarse) <= 15 and 100 <= index.nlist <= 200
    rows = index.rows(spark).collect()
    fine = tree.fine(spark, range(len(tree.coarse)))
    for r in rows[::37]:
        cell = int(np.argmin(((tree.coarse - np.array(r["v"])) ** 2).sum(axis=1)))
        assert r["list_id"] == tree.first[cell] + int(np.argmin(((fine[cell] - np.array(r["v"])) ** 2).sum(axis=1)))
    found = [r["id"] for r in ivf.search(spark, index, QUERIES[0], 10, nprobe=index.nlist).collect()]
    assert found == exact(clusters, QUERIES[0], 10)
    opened = tree.probe(spark, np.array(QUERIES[0]), 3)
    assert len(opened) == 3 and len(tree.cells(np.array(QUERIES[0]), 12)) < len(tree.coarse)


def test_kmeans_ignores_copies_and_restarts_empty_centres():
    rng = np.random.default_rng(1)
    rows = np.concatenate([np.zeros((5000, 3)), rng.normal(size=(40, 3)), 50 + rng.normal(size=(3, 3))])
    found = centres.kmeans(rows, 6, 1)
    assert len(found) == 6 and len(np.unique(found, axis=0)) == 6
    assert len(centres.kmeans(rows[:5000], 6, 1)) == 1
    assert (np.bincount(centres.nearest(np.unique(rows, axis=0), found), minlength=6) > 0).all()


@pytest.mark.parametrize("sizes,total", [([5, 5], 4), ([1000, 1, 1], 10), ([3, 900, 0, 40], 50), ([1, 1, 1], 2), ([7], 7), ([2, 2], 9)])
def test_shares(sizes, total):
    given = centres.shares(sizes, total)
    assert all(1 <= g <= max(1, s) for g, s in zip(given, sizes))
    assert sum(given) == max(len(sizes), min(total, sum(max(1, s) for s in sizes)))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["sq8", "pq"])
def test_rerank_reads_few_vectors_and_no_list_again(spark, clusters, indexes, kind, monkeypatch):
    found = ivf.search(spark, indexes[kind], QUERIES[3], 5, rerank=4)
    text = plan(found)
    assert "/vectors" in text and "/lists" not in text
    assert "EqualTo" in text.split("PushedFilters")[1] or "Or(" in text.split("PushedFilters")[1]
    assert "v" not in {f.name for f in indexes[kind].rows(spark).schema.fields}
    monkeypatch.setattr(ivf, "BUCKET_ROWS", 100)
    few = ivf.build(clusters, "v", "id", scratch_path(spark, "buckets"), kind, nlist=10, m=4 if kind == "pq" else None)
    assert few.buckets == 15 and few.vectors(spark).count() == 1500
    best = ivf.search(spark, few, QUERIES[3], 2, nprobe=10, rerank=2)
    assert len(best.inputFiles()) <= 4 < len(few.vectors(spark).inputFiles())  # of 15 folders
    assert [r["id"] for r in ivf.search(spark, few, QUERIES[3], 10, nprobe=10, rerank=150).collect()] == exact(clusters, QUERIES[3], 10)


def test_predicates_are_pushed_into_the_lists(spark, clusters):
    index = ivf.build(clusters, "v", "id", scratch_path(spark, "carry"), "flat", nlist=20, carry=["tag"])
    assert ivf.carries(spark, index, "tag = 3 AND id < 9") and not ivf.carries(spark, index, "size(v) = 16")
    whole = ivf.filtered_search(clusters, index, QUERIES[2], "tag = 3", 10, nprobe=index.nlist)
    assert "EqualTo(tag,3)" in plan(whole) and [r["id"] for r in whole.collect()] == exact(clusters, QUERIES[2], 10, where="tag = 3")
    rare = "tag = 3 AND id < 40"
    found = [r["id"] for r in ivf.filtered_search(clusters, index, QUERIES[1], rare, 30, nprobe=1).collect()]
    assert found == exact(clusters, QUERIES[1], 30, where=rare)  # all that qualify, from all lists
    some = ivf.filtered_search(clusters, index, QUERIES[1], "tag = 3", 10).collect()
    assert len(some) == 10 and len({r["id"] for r in some} & set(exact(clusters, QUERIES[1], 10, where="tag = 3"))) >= 8
    moved = clusters.where("id >= 100")
    kept = ivf.refresh(moved, index, 0)
    assert ivf.filtered_search(moved, kept, QUERIES[1], rare, 30, nprobe=1).count() == 0
    assert ivf.IvfIndex.load(spark, kept.path) == kept
    with pytest.raises(ValueError, match="carry"):
        ivf.build(clusters, "v", "id", scratch_path(spark, "x"), carry=["v"])


def test_post_filter_refills(spark, clusters, indexes):
    rare = "tag = 3 AND id % 7 = 0"
    found = [r["id"] for r in ivf.filtered_search(clusters, indexes["flat"], QUERIES[1], rare, 30, nprobe=1).collect()]
    assert len(found) == 30
    everything = ivf.filtered_search(clusters, indexes["flat"], QUERIES[1], "tag = 3 AND id < 40", 30, nprobe=1)
    assert [r["id"] for r in everything.collect()] == exact(clusters, QUERIES[1], 30, where="tag = 3 AND id < 40")


def test_refresh_and_rebuild(spark, clusters):
    early = clusters.where("id < 1000")
    index = ivf.build(early, "v", "id", scratch_path(spark, "grow"), nlist=10)
    assert ivf.refresh(clusters, index).n_rows == 1000  # below the default threshold
    assert ivf.rebuild(early, index, scratch_path(spark, "same")) is index
    assert ivf.changed_fraction(clusters, index) == 0.5
    rebuilt = ivf.rebuild(clusters, index, scratch_path(spark, "new"))
    assert rebuilt.n_rows == 1500
    grown = ivf.refresh(clusters, index, threshold=100)
    assert grown.n_rows == 1500 and ivf.refresh(clusters, grown, 0).n_rows == 1500
    found = [r["id"] for r in ivf.search(spark, grown, QUERIES[2], 10, nprobe=10).collect()]
    assert found == exact(clusters, QUERIES[2], 10)
    assert ivf.IvfIndex.load(spark, grown.path) == grown


def test_parameters(spark, clusters):
    with pytest.raises(ValueError, match="needs m"):
        ivf.build(clusters, "v", "id", scratch_path(spark, "x"), "pq")
    with pytest.raises(ValueError, match="divide"):
        ivf.build(clusters, "v", "id", scratch_path(spark, "x"), "pq", m=5)
    with pytest.raises(ValueError, match="kind"):
        ivf.build(clusters, "v", "id", scratch_path(spark, "x"), "tree")
