"""Dense and sparse vector search over ``embeddings``."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecspark.functions import sqlfunctions
from vecspark.functions.distance import dense_distance, sparse_inner_product
from vecspark.operators import knn, search, sparse
from vecspark.operators.partition import Layout, ListPartition
from vecspark.queries.registry import query, table
from vecspark.session import scratch_path
from vecspark.sources.ingest import sparse_from_dense

# A fixed query vector with components that float32 holds exactly, and one it does not.
QUERY = [((i * 37) % 64 - 32) / 64.0 for i in range(64)]
PRECISE_QUERY = [((i * 37) % 64 - 32) / 70.0 for i in range(64)]
SPARSE_QUERY = {1: 0.25, 5: 0.5, 17: 0.75, 40: -0.375}
SPARSE_THRESHOLD = 0.15

Q = str(QUERY) + "::DOUBLE[]"
V = "embedding::DOUBLE[]"

_SQL_DISTANCE = {
    "l2": f"list_distance({V}, {Q})",
    "cosine": f"list_cosine_distance({V}, {Q})",
    "ip": f"list_inner_product({V}, {Q})",
    "neg_ip": f"-list_inner_product({V}, {Q})",
}


def _topk_sql(metric: str, k: int = 10, where: str = "true") -> str:
    d = _SQL_DISTANCE[metric]
    return f"SELECT vec_id, round({d}, 5) AS distance FROM embeddings WHERE {where} ORDER BY {d}, vec_id LIMIT {k}"


def _rounded(df):
    return df.withColumn("distance", F.round("distance", 5))


def _topk(spark, sf_dir, metric, k=10, **options):
    found = search.ann_search(
        table(spark, sf_dir, "embeddings"), QUERY, "embedding", metric, k, "vec_id",
        names=["vec_id"], with_distance=True, **options,
    )
    return _rounded(found)


@query("vec_l2_topk", _topk_sql("l2"))
def vec_l2_topk(spark, sf_dir):
    return _topk(spark, sf_dir, "l2")


@query("vec_cosine_topk", _topk_sql("cosine"))
def vec_cosine_topk(spark, sf_dir):
    return _topk(spark, sf_dir, "cosine")


@query("vec_ip_topk", _topk_sql("ip"))
def vec_ip_topk(spark, sf_dir):
    return _topk(spark, sf_dir, "ip")


@query("vec_neg_ip_topk", _topk_sql("neg_ip"))
def vec_neg_ip_topk(spark, sf_dir):
    return _topk(spark, sf_dir, "neg_ip")


@query("vec_range_search", _topk_sql("l2", 50, f"{_SQL_DISTANCE['l2']} <= 2.4"))
def vec_range_search(spark, sf_dir):
    return _topk(spark, sf_dir, "l2", 50, threshold=2.4)


@query("vec_filtered_search", _topk_sql("l2", 10, "label >= 3 AND label < 8"))
def vec_filtered_search(spark, sf_dir):
    return _topk(spark, sf_dir, "l2", where=["label >= 3", F.col("label") < 8])


LABEL_LAYOUT = Layout(ListPartition("label", [("low", [0, 1, 2, 3, 4]), ("high", [5, 6, 7, 8, 9])]))


@query("vec_partition_search", _topk_sql("l2", 10, "label BETWEEN 5 AND 9"))
def vec_partition_search(spark, sf_dir):
    placed = LABEL_LAYOUT.assign(table(spark, sf_dir, "embeddings"))
    found = search.ann_search(
        placed, QUERY, "embedding", "l2", 10, "vec_id", names=["vec_id"], with_distance=True, partitions=["high"]
    )
    return _rounded(found)


_PRECISE = f"list_distance({V}, {PRECISE_QUERY}::DOUBLE[])"


@query(
    "vec_precise_search",
    f"SELECT vec_id, label, round({_PRECISE}, 5) AS distance FROM embeddings ORDER BY {_PRECISE}, vec_id LIMIT 10",
)
def vec_precise_search(spark, sf_dir):
    found = search.precise_search(
        table(spark, sf_dir, "embeddings"), PRECISE_QUERY, "embedding", "l2", k=10, primary_key="vec_id",
        names=["vec_id", "label"], with_distance=True,
    )
    return _rounded(found)


@query(
    "search_metric_dispatch",
    " UNION ALL ".join(
        f"SELECT '{m}' AS metric, * FROM ({_topk_sql(m, 5)})" for m in ("l2", "cosine", "ip", "neg_ip")
    ),
)
def search_metric_dispatch(spark, sf_dir):
    base, result = table(spark, sf_dir, "embeddings"), None
    for metric in ("L2", "cosine", "ip", "NEG_IP"):
        found = search.search(
            base, QUERY, "embedding", True, limit=5, names=["vec_id"], primary_key="vec_id",
            search_params={"metric_type": metric},
        ).select(F.lit(metric.lower()).alias("metric"), "vec_id", "distance")
        result = found if result is None else result.unionByName(found)
    return _rounded(result)


@query(
    "vec_knn_join",
    """
    WITH pairs AS (
        SELECT q.vec_id AS query_id, b.vec_id AS vec_id,
               list_distance(b.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS d
        FROM embeddings q, embeddings b),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS rank FROM pairs)
    SELECT query_id, vec_id, round(d, 5) AS distance, rank::INTEGER AS rank FROM ranked WHERE rank <= 5
    """,
)
def vec_knn_join(spark, sf_dir):
    base = table(spark, sf_dir, "embeddings")
    queries = base.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return _rounded(knn.knn_join(queries, base, 5, "l2", base_id="vec_id", base_vector="embedding"))


@query(
    "vec_pairwise_distance",
    f"""
    SELECT vec_id, round(list_distance({V}, list_reverse({V})), 5) AS l2,
           round(list_cosine_distance({V}, list_reverse({V})), 5) AS cosine,
           round(list_inner_product({V}, list_reverse({V})), 5) AS ip
    FROM embeddings
    """,
)
def vec_pairwise_distance(spark, sf_dir):
    a, b = F.col("embedding"), F.reverse("embedding")
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", *[F.round(dense_distance(a, b, m), 5).alias(m) for m in ("l2", "cosine", "ip")]
    )


@query(
    "raw_sql_vector_fn",
    f"""
    SELECT label, count(*)::BIGINT AS n, round(min(list_distance({V}, {Q})), 5) AS nearest,
           round(max(list_inner_product({V}, {Q})), 5) AS largest
    FROM embeddings GROUP BY label
    """,
)
def raw_sql_vector_fn(spark, sf_dir):
    sqlfunctions.register(spark)
    table(spark, sf_dir, "embeddings").createOrReplaceTempView("embeddings")
    literal = "array(" + ", ".join(f"{x}D" for x in QUERY) + ")"
    return spark.sql(
        f"""
        SELECT label, count(*) AS n, round(min(l2_distance(embedding, {literal})), 5) AS nearest,
               round(max(inner_product(embedding, {literal})), 5) AS largest
        FROM embeddings GROUP BY label
        """
    )


# --- sparse ---------------------------------------------------------------------------

_SPARSE_CTE = f"""
    terms AS (
        SELECT vec_id, label, u.i - 1 AS term, u.x::DOUBLE AS weight
        FROM (SELECT vec_id, label, unnest(list_zip(embedding, range(1, len(embedding) + 1))) AS z FROM embeddings),
             LATERAL (SELECT z[1] AS x, z[2] AS i) u
        WHERE abs(u.x::DOUBLE) > {SPARSE_THRESHOLD})
"""
_SPARSE_WEIGHTS = "(VALUES " + ", ".join(f"({t}, {w}::DOUBLE)" for t, w in SPARSE_QUERY.items()) + ") AS q(term, w)"


def _sparse_sql(where: str) -> str:
    return f"""
    WITH {_SPARSE_CTE},
    scores AS (SELECT t.vec_id, sum(t.weight * q.w) AS s FROM terms t JOIN {_SPARSE_WEIGHTS} ON t.term = q.term GROUP BY t.vec_id)
    SELECT e.vec_id, round(0.0 - coalesce(s, 0)::FLOAT::DOUBLE, 4) AS distance
    FROM embeddings e LEFT JOIN scores USING (vec_id)
    WHERE {where}
    ORDER BY 0.0 - coalesce(s, 0)::FLOAT::DOUBLE, e.vec_id LIMIT 20
    """


def _sparse_base(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", sparse_from_dense("embedding", SPARSE_THRESHOLD).alias("sparse")
    )


def _sparse_topk(spark, sf_dir, where=None):
    base = _sparse_base(spark, sf_dir)
    postings = sparse.sparse_postings(base, "sparse", "vec_id")
    found = sparse.sparse_topk(base, postings, SPARSE_QUERY, 20, "vec_id", where=where)
    return found.withColumn("distance", F.round("distance", 4))


@query("sparse_topk", _sparse_sql("true"))
def sparse_topk(spark, sf_dir):
    return _sparse_topk(spark, sf_dir)


@query("sparse_topk_filtered", _sparse_sql("label >= 5"))
def sparse_topk_filtered(spark, sf_dir):
    return _sparse_topk(spark, sf_dir, "label >= 5")


@query("sparse_index_topk", _sparse_sql("true"))
def sparse_index_topk(spark, sf_dir):
    """Over stored postings, by the tiers that can hold one of the best rows."""
    base, path = _sparse_base(spark, sf_dir), scratch_path(spark, "sparse-index")
    sparse.write_index(sparse.sparse_postings(base, "sparse", "vec_id"), path)
    return sparse.index_topk(base, path, SPARSE_QUERY, 20, "vec_id").withColumn("distance", F.round("distance", 4))


@query("sparse_scan_topk", _sparse_sql("true"))
def sparse_scan_topk(spark, sf_dir):
    found = search.ann_search(
        _sparse_base(spark, sf_dir), SPARSE_QUERY, "sparse", "neg_ip", 20, "vec_id", names=["vec_id"],
        with_distance=True,
    )
    return found.withColumn("distance", F.round("distance", 4))


@query(
    "sparse_ip_pairs",
    f"""
    SELECT vec_id, round(list_sum(list_transform(
        list_zip(embedding::DOUBLE[], list_reverse(embedding)::DOUBLE[]),
        lambda z: CASE WHEN abs(z[1]) > 0.1 AND abs(z[2]) > 0.1 THEN z[1] * z[2] ELSE 0 END))::FLOAT::DOUBLE, 4) AS ip
    FROM embeddings
    """,
)
def sparse_ip_pairs(spark, sf_dir):
    a = sparse_from_dense("embedding", 0.1)
    b = sparse_from_dense(F.reverse("embedding"), 0.1)
    maps = table(spark, sf_dir, "embeddings").select("vec_id", a.alias("a"), b.alias("b"))
    return maps.select("vec_id", F.round(sparse_inner_product("a", "b"), 4).alias("ip"))


@query("raw_sql_json_fn", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def raw_sql_json_fn(spark, sf_dir):
    sqlfunctions.register(spark)
    return spark.sql("SELECT event_id, json_extract(props, '$.k') AS k FROM {e}", e=table(spark, sf_dir, "events"))
