"""Inverted-file indexes over ``embeddings``; approximate results carry no SQL text."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecspark.operators import ivf
from vecspark.queries.registry import ORACLES, query, table
from vecspark.queries.vectors import Q, QUERY, V, _topk_sql
from vecspark.session import scratch_path


def _index(spark, sf_dir, kind, **options):
    base = table(spark, sf_dir, "embeddings")
    return ivf.build(base, "embedding", "vec_id", scratch_path(spark, f"ivf-{kind}"), kind, **options)


def _rounded(df):
    return df.withColumn("distance", F.round("distance", 5))


@query("ivf_flat_full_probe", _topk_sql("l2"))
def ivf_flat_full_probe(spark, sf_dir):
    index = _index(spark, sf_dir, "flat")
    return _rounded(ivf.search(spark, index, QUERY, 10, nprobe=index.nlist))


@query("ivf_flat_search")
def ivf_flat_search(spark, sf_dir):
    return _rounded(ivf.search(spark, _index(spark, sf_dir, "flat"), QUERY, 10))


@query("ivf_sq8_search")
def ivf_sq8_search(spark, sf_dir):
    return _rounded(ivf.search(spark, _index(spark, sf_dir, "sq8"), QUERY, 10))


@query("ivf_pq_search")
def ivf_pq_search(spark, sf_dir):
    return _rounded(ivf.search(spark, _index(spark, sf_dir, "pq", m=8), QUERY, 10))


@query("ivf_knn_join")
def ivf_knn_join(spark, sf_dir):
    base = table(spark, sf_dir, "embeddings")
    queries = base.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return _rounded(ivf.knn(queries, spark, _index(spark, sf_dir, "flat"), 5))


@query("ivf_knn_full_probe", ORACLES["vec_knn_join"])
def ivf_knn_full_probe(spark, sf_dir):
    base = table(spark, sf_dir, "embeddings")
    queries = base.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    index = _index(spark, sf_dir, "flat", nlist=16)
    return _rounded(ivf.knn(queries, spark, index, 5, nprobe=index.nlist))


@query("vec_post_filter")
def vec_post_filter(spark, sf_dir):
    base = table(spark, sf_dir, "embeddings")
    return _rounded(ivf.filtered_search(base, _index(spark, sf_dir, "flat"), QUERY, "label >= 3 AND label < 8", 10))


@query("ivf_refresh", _topk_sql("l2"))
def ivf_refresh(spark, sf_dir):
    """Index the rows of some labels, add the rest by a refresh, search every list."""
    base = table(spark, sf_dir, "embeddings")
    early = base.where("label < 7")
    index = ivf.build(early, "embedding", "vec_id", scratch_path(spark, "ivf-refresh"))
    index = ivf.refresh(base, index, threshold=0)
    return _rounded(ivf.search(spark, index, QUERY, 10, nprobe=index.nlist))


@query("ivf_sq8_full_probe", _topk_sql("l2"))
def ivf_sq8_full_probe(spark, sf_dir):
    """Every list, and every row scored again on its vector."""
    index = _index(spark, sf_dir, "sq8", nlist=16)
    return _rounded(ivf.search(spark, index, QUERY, 10, nprobe=index.nlist, rerank=index.n_rows))


@query("ivf_pq_full_probe", _topk_sql("l2"))
def ivf_pq_full_probe(spark, sf_dir):
    index = _index(spark, sf_dir, "pq", nlist=16, m=8)
    return _rounded(ivf.search(spark, index, QUERY, 10, nprobe=index.nlist, rerank=index.n_rows))


@query("ivf_after_delete_update", f"""
    WITH e AS (
      SELECT vec_id, CASE WHEN label = 2 THEN list_transform({V}, lambda x: -x) ELSE {V} END AS v
      FROM embeddings WHERE label <> 1)
    SELECT vec_id, round(list_distance(v, {Q}), 5) AS distance FROM e ORDER BY list_distance(v, {Q}), vec_id LIMIT 10
""")
def ivf_after_delete_update(spark, sf_dir):
    """Rows of one label go, those of another get other vectors; a refresh follows both."""
    base = table(spark, sf_dir, "embeddings")
    index = ivf.build(base, "embedding", "vec_id", scratch_path(spark, "ivf-changed"), nlist=16)
    negated = F.transform("embedding", lambda x: -x)
    changed = base.where("label <> 1").withColumn("embedding", F.when(F.col("label") == 2, negated).otherwise(F.col("embedding")))
    index = ivf.refresh(changed, index, threshold=0)
    return _rounded(ivf.search(spark, index, QUERY, 10, nprobe=index.nlist))


@query("ivf_rebuild", _topk_sql("l2"))
def ivf_rebuild(spark, sf_dir):
    """An index of some labels, built anew once the rest has come."""
    base = table(spark, sf_dir, "embeddings")
    early = ivf.build(base.where("label < 5"), "embedding", "vec_id", scratch_path(spark, "ivf-early"), nlist=16)
    index = ivf.rebuild(base, early, scratch_path(spark, "ivf-anew"))
    return _rounded(ivf.search(spark, index, QUERY, 10, nprobe=index.nlist))


@query("ivf_filter_full_probe", f"""
    SELECT vec_id, round(list_distance({V}, {Q}), 5) AS distance FROM embeddings WHERE label >= 3 AND label < 8
    ORDER BY list_distance({V}, {Q}), vec_id LIMIT 10
""")
def ivf_filter_full_probe(spark, sf_dir):
    base = table(spark, sf_dir, "embeddings")
    index = _index(spark, sf_dir, "flat", nlist=16)
    return _rounded(ivf.filtered_search(base, index, QUERY, "label >= 3 AND label < 8", 10, nprobe=index.nlist))


@query("ivf_sq8_rerank", _topk_sql("l2"))
def ivf_sq8_rerank(spark, sf_dir):
    """Codes of every list choose 40 rows; only the vectors of these are read."""
    index = _index(spark, sf_dir, "sq8", nlist=16)
    return _rounded(ivf.search(spark, index, QUERY, 10, nprobe=index.nlist, rerank=4))


@query("ivf_pq_rerank", _topk_sql("l2"))
def ivf_pq_rerank(spark, sf_dir):
    index = _index(spark, sf_dir, "pq", nlist=16, m=32)
    return _rounded(ivf.search(spark, index, QUERY, 10, nprobe=index.nlist, rerank=8))


@query("ivf_filter_pushed", ORACLES["ivf_filter_full_probe"])
def ivf_filter_pushed(spark, sf_dir):
    """The predicate is pushed into the scan of the lists, which carry its column."""
    base = table(spark, sf_dir, "embeddings")
    index = _index(spark, sf_dir, "sq8", nlist=16, carry=["label"])
    return _rounded(ivf.filtered_search(base, index, QUERY, "label >= 3 AND label < 8", 10, nprobe=index.nlist))


@query("ivf_filter_refill", f"""
    SELECT vec_id, round(list_distance({V}, {Q}), 5) AS distance FROM embeddings WHERE label = 3 AND vec_id < 60
    ORDER BY list_distance({V}, {Q}), vec_id LIMIT 10
""")
def ivf_filter_refill(spark, sf_dir):
    """Few rows pass: from one list on, twice as many are read until all are."""
    base = table(spark, sf_dir, "embeddings")
    index = _index(spark, sf_dir, "flat", nlist=16, carry=["label"])
    return _rounded(ivf.filtered_search(base, index, QUERY, "label = 3 AND vec_id < 60", 10, nprobe=1))
