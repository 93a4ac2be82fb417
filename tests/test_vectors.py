import math
import random
import struct

import numpy as np
import pyarrow as pa
import pytest

from vecspark.functions.distance import dense_distance, metric_name, sparse_inner_product
from vecspark.operators import knn, search, sparse
from vecspark.operators.partition import MAXVALUE, Layout, RangePartition
from vecspark.sources.ingest import (
    array_from_text, sparse_from_text, sparse_to_text, vector_from_text, vector_to_text,
)
from pyspark import TaskContext
from pyspark.sql import functions as F, types as T

def ring(n=24, tilt=0.5):
    """Points around a circle, the even ones raised: (id, place, sector), ids in steps of three."""
    turn = 2 * math.pi / n
    return [(3 * i, [math.cos(i * turn), math.sin(i * turn), tilt * (i % 2 == 0)], f"s{i * 4 // n}") for i in range(n)]


def slow_order(rows, q, metric="l2", keep=lambda r: True):
    """Ids by the metric in plain Python, on values rounded as they are stored."""
    narrow = lambda v: [struct.unpack("f", struct.pack("f", x))[0] for x in v]
    q, found = narrow(q), []
    for r in filter(keep, rows):
        v = narrow(r[1])
        dot = sum(x * y for x, y in zip(v, q))
        found.append(({"l2": math.dist(v, q), "ip": dot, "neg_ip": -dot}[metric], r[0]))
    return [i for _, i in sorted(found)]


@pytest.fixture(scope="module")
def plain(spark):
    return spark.createDataFrame(ring(), "id int, place array<float>, sector string")


def ids(df):
    return [r["id"] for r in df.collect()]


SPOT = [0.9, 0.35, 0.2]


@pytest.mark.parametrize("metric", ["l2", "ip", "neg_ip"])
def test_order_of_each_metric(plain, metric):
    found = search.search(plain, SPOT, "place", limit=7, search_params={"metric_type": metric.upper()}, primary_key="id")
    assert ids(found) == slow_order(ring(), SPOT, metric)[:7]


def test_search_in_partition(plain):
    placed = Layout(RangePartition("id", [("low", 30), ("mid", 51), ("top", MAXVALUE)])).assign(plain)
    for names, keep in ((["mid"], lambda r: 30 <= r[0] < 51), (["low", "top"], lambda r: not 30 <= r[0] < 51)):
        found = search.ann_search(placed, SPOT, "place", "l2_distance", 5, "id", partitions=names)
        assert ids(found) == slow_order(ring(), SPOT, keep=keep)[:5]


def test_thresholds(plain):
    found = search.ann_search(plain, SPOT, "place", "l2", 24, "id", threshold=0.6, with_distance=True).collect()
    assert [r["id"] for r in found] == slow_order(ring(), SPOT)[: len(found)]
    assert 0 < len(found) < 24 and all(r["distance"] <= 0.6 for r in found)
    on_it = search.ann_search(plain, ring()[4][1], "place", "l2", 24, "id", threshold=0.0)
    assert ids(on_it) == [12]


def test_output_expressions(plain):
    found = search.ann_search(
        plain, SPOT, "place", "l2", 4, "id", names=["sector"],
        columns=["id", (F.col("id") * 2 - 1).alias("odd")], extra=["upper(sector) AS big"],
    )
    assert found.columns == ["id", "odd", "big"]
    assert [tuple(r) for r in found.collect()] == [(i, 2 * i - 1, f"S{i // 3 // 6}") for i in slow_order(ring(), SPOT)[:4]]


def test_filtered_search(plain):
    found = search.ann_search(plain, SPOT, "place", "l2", 3, "id", ["sector <> 's0'", F.col("id") % 2 == 1], ["id"])
    assert ids(found) == slow_order(ring(), SPOT, keep=lambda r: r[2] != "s0" and r[0] % 2 == 1)[:3]


def test_metric_names():
    assert metric_name("Cosine") == "cosine"
    with pytest.raises(ValueError):
        metric_name("hamming")
    with pytest.raises(TypeError):
        metric_name(3)


@pytest.mark.parametrize("metric", ["l2", "cosine", "ip", "neg_ip"])
def test_arrow_and_column_scores_agree(spark, metric):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(40)] + [(40, None), (41, [0.0] * 8)]
    df = spark.createDataFrame(rows, "id int, v array<float>")
    q = [rng.uniform(-1, 1) for _ in range(8)]
    got = df.select(
        "id", dense_distance("v", q, metric).alias("a"), dense_distance("v", q, metric, arrow=True).alias("b"),
        dense_distance(F.col("v"), F.lit(q), metric).alias("c"),
    ).collect()
    for r in got:
        if r["a"] is None:
            assert r["b"] is None and r["c"] is None
        else:
            assert math.isclose(r["a"], r["b"], abs_tol=1e-12) and math.isclose(r["a"], r["c"], abs_tol=1e-12)
    assert got[40]["a"] is None
    assert (got[41]["a"] is None) == (metric == "cosine")


def test_dimension_mismatch_raises(plain):
    for arrow in (False, True):
        with pytest.raises(Exception, match="different dimensions"):
            search.ann_search(plain, [0.0, 1.0], "place", "l2", 5, "id", arrow=arrow).collect()


def test_query_type_is_checked(plain):
    with pytest.raises(TypeError):
        search.ann_search(plain, "text", "place")


SPARSE = [(1, {1: 0.5, 100: 0.3, 500: 0.8}, 10), (2, {10: 0.1, 200: 0.7, 1000: 0.9}, 4), (3, {1: 0.7, 50: 0.7, 1000: 0.9}, 1)]


@pytest.fixture(scope="module")
def sparse_rows(spark):
    return spark.createDataFrame(SPARSE, "id int, v map<int,float>, c2 int")


def test_sparse_search(sparse_rows):
    q = {1: 0.2, 50: 0.4, 1000: 0.7}
    assert ids(search.ann_search(sparse_rows, q, "v", "neg_ip", 2, "id")) == [3, 2]
    assert ids(search.ann_search(sparse_rows, q, "v", "neg_ip", 2, "id", where="c2 >= 4")) == [2, 1]
    postings = sparse.sparse_postings(sparse_rows, "v", "id")
    assert ids(sparse.sparse_topk(sparse_rows, postings, q, 2)) == [3, 2]
    assert ids(sparse.sparse_topk(sparse_rows, postings, q, 2, where="c2 >= 4")) == [2, 1]
    text = search.search(sparse_rows, q, "v", limit=1, search_params={"metric_type": "neg_ip"}, primary_key="id")
    assert text.first()["v"] == "{1:0.7,50:0.7,1000:0.9}"
    with pytest.raises(ValueError):
        search.ann_search(sparse_rows, q, "v", "l2", 2, "id")


def test_sparse_pairs(spark):
    df = spark.createDataFrame(
        [({1: 1.1, 2: 2.2}, {1: 2.4}), ({1: 1.5, 3: 3.6}, {4: 4.5}), ({1: 1.5, 3: 3.6}, {1: 2.4})],
        "a map<int,float>, b map<int,float>",
    )
    assert [r[0] for r in df.select(sparse_inner_product("a", "b")).collect()] == [2.640000104904175, 0.0, 3.6000001430511475]
    one = df.select(sparse_inner_product("a", {1: 2.4})).collect()
    assert one[0][0] == 2.640000104904175 and one[2][0] == 3.6000001430511475


def test_sparse_postings_equal_scan(spark):
    rng = random.Random(1)
    rows = [(i, {rng.randrange(30): rng.uniform(-1, 1) for _ in range(rng.randrange(5))}, i % 3) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, v map<int,float>, c int")
    q = {1: 0.5, 7: -0.25, 11: 1.0}
    postings = sparse.sparse_postings(df, "v", "id")
    for metric in ("ip", "neg_ip"):
        for where in (None, "c = 1"):
            a = search.ann_search(df, q, "v", metric, 150, "id", where, ["id"], with_distance=True).collect()
            b = sparse.sparse_topk(df, postings, q, 150, metric=metric, where=where).collect()
            assert [(r["id"], round(r["distance"], 6)) for r in a] == [(r["id"], round(r["distance"], 6)) for r in b]


def test_sparse_postings_on_disk(spark, sparse_rows, tmp_path):
    sparse.write_postings(sparse.sparse_postings(sparse_rows, "v", "id"), str(tmp_path / "p"), 8)
    q = {1: 0.2, 50: 0.4, 1000: 0.7}
    stored = sparse.read_terms(spark, str(tmp_path / "p"), list(q), "int", 8)
    assert ids(sparse.sparse_topk(sparse_rows, stored, q, 3)) == [3, 2, 1]


def brute(queries, base, k, metric):
    def dist(a, b):
        a, b = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
        if metric == "l2":
            return math.sqrt(((a - b) ** 2).sum())
        if metric == "cosine":
            return 1 - a @ b / (np.linalg.norm(a) * np.linalg.norm(b))
        return a @ b if metric == "ip" else -(a @ b)

    out = {}
    for qid, q in queries:
        out[qid] = [b for _, b in sorted((round(dist(q, v), 12), i) for i, v in base)[:k]]
    return out


@pytest.mark.parametrize("metric", ["l2", "cosine", "ip", "neg_ip"])
def test_knn_join(spark, metric):
    rng = random.Random(3)
    base = [(i, [rng.randrange(-8, 8) / 8 + 0.0625 for _ in range(6)]) for i in range(300)]
    base += [(1000 + i, base[0][1]) for i in range(150)]  # a third of the rows are one vector
    queries = [(i, [rng.randrange(-8, 8) / 8 + 0.0625 for _ in range(6)]) for i in range(40)] + [(99, base[0][1])]
    b = spark.createDataFrame(base, "id long, vector array<float>").repartition(7)
    q = spark.createDataFrame(queries, "query_id long, vector array<float>")
    want = brute(queries, base, 7, metric)
    for limit in (knn.MAX_QUERY_BYTES, 500):  # one block, and several
        got = knn.knn_join(q, b, 7, metric, max_query_bytes=limit).collect()
        by_query = {}
        for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
            by_query.setdefault(r["query_id"], []).append(r["id"])
        if metric == "cosine":  # equal directions differ in their last bits
            assert {k: len(v) for k, v in by_query.items()} == {k: len(v) for k, v in want.items()}
        else:
            assert by_query == want


def test_knn_join_with_repeated_query_ids_and_large_values(spark):
    rng = random.Random(9)
    base = [(i, [1e4 + rng.choice([0, 1e-2, 2e-2]) for _ in range(4)]) for i in range(200)]
    queries = [(5, base[3][1])] * 30 + [(6, base[9][1])]
    b = spark.createDataFrame(base, "id long, vector array<float>")
    q = spark.createDataFrame(queries, "query_id long, vector array<float>").repartition(5)
    for limit in (knn.MAX_QUERY_BYTES, 256):
        got = knn.knn_join(q, b, 4, "l2", max_query_bytes=limit)
        assert got.count() == 31 * 4
        for qid, v in ((5, base[3][1]), (6, base[9][1])):
            want = brute([(qid, v)], base, 4, "l2")[qid]
            rows = got.where(F.col("query_id") == qid).select("rank", "id").distinct().orderBy("rank").collect()
            assert [r["id"] for r in rows] == want


def test_text_round_trips(spark):
    df = spark.createDataFrame([("[1,2.5,-3e2]", "{2:2.5, 1:1.5}", "[[1,2],[3]]")], "v string, s string, a string")
    row = df.select(
        vector_from_text("v", 3).alias("v"), sparse_from_text("s").alias("s"),
        array_from_text("a", T.IntegerType(), 2).alias("a"), vector_to_text(vector_from_text("v")).alias("vt"),
        sparse_to_text(sparse_from_text("s")).alias("st"),
    ).first()
    assert row["v"] == [1.0, 2.5, -300.0] and row["s"] == {2: 2.5, 1: 1.5} and row["a"] == [[1, 2], [3]]
    assert row["vt"] == "[1.0,2.5,-300.0]" and row["st"] == "{1:1.5,2:2.5}"


@pytest.mark.parametrize("bad", ["[1,2]", "[1,[2],3]", "1,2,3", "[1,null,2]", '["a",1,2]'])
def test_bad_vector_text(spark, bad):
    df = spark.createDataFrame([(bad,)], "v string")
    assert df.select(vector_from_text("v", 3, strict=False)).first()[0] is None
    with pytest.raises(Exception, match="not a vector"):
        df.select(vector_from_text("v", 3)).collect()


def test_bad_nested_array(spark):
    df = spark.createDataFrame([("[1,2]",)], "v string")
    with pytest.raises(Exception, match="declared depth"):
        df.select(array_from_text("v", "int", 2)).collect()
    assert df.select(sparse_from_text("v", strict=False)).first()[0] is None


def test_one_list_is_scored_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(knn, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(knn, "CHUNK_BYTES", 8 * 3 * 20)
    monkeypatch.setattr(knn, "MAX_QUERY_BYTES", 8 * 3 * 20)
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(600, 3)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id int, v array<float>")
    queries = df.select(F.col("id").alias("query_id"), F.col("v").alias("vector"))
    # What a task emits is cut to the k best of each query, so several tasks emit more than one would.
    whole = knn.pair_topk
    def marked(dim, metric, k, id_type):
        run = whole(dim, metric, k, id_type)
        return lambda batches: (b.set_column(1, "_id", pa.array([TaskContext.get().partitionId()] * b.num_rows, id_type)) for b in run(batches))
    monkeypatch.setattr(knn, "pair_topk", marked)
    tasks = knn.knn_join(queries, df, 600, base_vector="v").select("id").distinct().count()
    assert tasks > spark.sparkContext.defaultParallelism
    monkeypatch.setattr(knn, "pair_topk", whole)
    got = sorted((r["query_id"], r["rank"], r["id"]) for r in knn.knn_join(queries, df, 3, base_vector="v").collect())
    far = ((vectors[:, None].astype(float) - vectors[None].astype(float)) ** 2).sum(axis=2)
    assert got == [(q, r + 1, int(i)) for q in range(600) for r, i in enumerate(np.argsort(far[q], kind="stable")[:3])]


@pytest.mark.parametrize("metric", ["l2", "cosine", "ip", "neg_ip"])
@pytest.mark.parametrize("scale", [1.0, 1e-25, 1e17, 1e30])
def test_bounds_leave_no_near_row_out(metric, scale):
    rng = np.random.default_rng(6)
    some = rng.integers(-8, 8, size=(40, 5)) / 8  # many ties
    rows = np.concatenate([rng.normal(size=(900, 5)), some[rng.integers(0, 40, 500)], np.repeat(some[:1], 1200, axis=0), np.zeros((3, 5))])
    rows = rows[rng.permutation(len(rows))] * scale
    ids = rng.permutation(len(rows)) // 2  # keys repeat
    queries = np.concatenate([rows[:60], some * scale, rng.normal(size=(20, 5)) * scale, np.zeros((1, 5))])
    for k in (1, 7):
        near = knn.Nearest(queries, metric, k)
        for low in range(0, len(rows), 700):
            for asking in (np.arange(0, len(queries), 2), np.arange(1, len(queries), 2)):
                near.add(ids[low : low + 700], rows[low : low + 700], asking)
        q, found, d = (np.concatenate(c) for c in zip(*near.taken()))
        want = knn.best_per_query(ids, rows, queries, metric, k)
        assert np.array_equal(q, want[0]) and np.array_equal(found, want[1]) and np.array_equal(d, want[2])


def test_most_rows_are_compared_with_a_bound_only(monkeypatch):
    rng = np.random.default_rng(7)
    rows, queries, k = rng.normal(size=(4000, 8)), rng.normal(size=(90, 8)), 3
    whole, scored = knn.best_per_query, []
    monkeypatch.setattr(knn, "best_per_query", lambda ids, *a: scored.append(len(ids)) or whole(ids, *a))
    def batch(low):
        numbers, ids = pa.array([list(range(90))]), pa.array([list(range(low, low + 1000))])
        chunks = [pa.array([queries.tobytes()], pa.binary()), ids, pa.array([rows[low : low + 1000].tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays([numbers, *chunks], ["_numbers", "_asked", "ids", "vectors"])
    out = list(knn.pair_topk(8, "l2", k, pa.int64())(batch(low) for low in range(0, 4000, 1000)))
    got = [np.concatenate([np.asarray(b.column(c)) for b in out]) for c in range(3)]
    want = whole(np.arange(4000), rows, queries, "l2", k)
    assert all(np.array_equal(a, b) for a, b in zip(got, want))
    assert sum(scored) <= 500  # the first rows, for a first bound


def test_chunks_of_queries_that_begin_alike_are_apart():
    rng = np.random.default_rng(9)
    rows, queries = rng.normal(size=(600, 4)), rng.normal(size=(3, 4))
    def batch(numbers):
        chunks = [pa.array([list(range(600))]), pa.array([rows.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array([numbers]), pa.array([queries[numbers].tobytes()], pa.binary()), *chunks], ["_numbers", "_asked", "ids", "vectors"])
    out = list(knn.pair_topk(4, "l2", 2, pa.int64())(batch(n) for n in ([0, 1], [0, 2], [0, 1, 2])))
    got = {(q, i) for b in out for q, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    q, ids, _ = knn.best_per_query(np.arange(600), rows, queries, "l2", 2)
    assert got == set(zip(q.tolist(), ids.tolist()))


def test_rows_far_from_zero_fall_back_to_double_precision(monkeypatch):
    rng = np.random.default_rng(8)
    rows, queries = 1e4 + rng.normal(size=(3000, 8)), 1e4 + rng.normal(size=(50, 8))
    exact, pairs = knn.score_pairs, []
    monkeypatch.setattr(knn, "score_pairs", lambda rows, *a: pairs.append(len(rows)) or exact(rows, *a))
    near = knn.Nearest(queries, "l2", 4)
    for low in range(0, 3000, 1000):
        near.add(np.arange(low, low + 1000), rows[low : low + 1000], np.arange(50))
    got = [np.concatenate(c) for c in zip(*near.taken())]
    assert sum(pairs) < 50 * 3000 // 4
    far = np.sqrt(((rows[None] - queries[:, None]) ** 2).sum(axis=2))
    assert got[1].reshape(50, 4).tolist() == np.argsort(far, axis=1, kind="stable")[:, :4].tolist()
