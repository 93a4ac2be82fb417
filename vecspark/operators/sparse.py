"""Sparse vector search, row by row or over postings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from vecspark.functions.distance import resolve_metric
from vecspark.operators import impact
from vecspark.operators.read import filtered

TERM_BUCKETS = 64


def term_bucket(term, buckets: int = TERM_BUCKETS):
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def sparse_postings(df: DataFrame, sparse_column: str, primary_key: str) -> DataFrame:
    """One row per (term, row): ``(term, <key>, weight)``."""
    return df.select(primary_key, F.explode(sparse_column).alias("term", "weight"))


def write_postings(postings: DataFrame, path: str, buckets: int = TERM_BUCKETS) -> None:
    """Store postings by hash bucket of the term.

    A bucket that holds a frequent term is split over several tasks and files by the
    rebalance; inside a file the rows are sorted, so a term touches few row groups.
    """
    placed = postings.withColumn("bucket", term_bucket(F.col("term"), buckets))
    order = ["bucket", "term", *(["tier"] if "tier" in postings.columns else [])]
    placed = placed.hint("rebalance", "bucket").sortWithinPartitions(*order)
    placed.write.partitionBy("bucket").parquet(path)


def read_terms(spark, path: str, terms: Sequence, term_type: str, buckets: int = TERM_BUCKETS) -> DataFrame:
    """Postings of some terms: only their buckets are listed, only their pages read."""
    return of_terms(spark.read.parquet(path), terms, term_type, buckets)


def of_terms(stored: DataFrame, terms: Sequence, term_type: str, buckets: int = TERM_BUCKETS) -> DataFrame:
    slots = [term_bucket(F.lit(t).cast(term_type), buckets) for t in terms]  # folded to constants
    return stored.where(F.col("bucket").isin(*slots) & F.col("term").isin(list(terms))).drop("bucket")


def posting_scores(postings: DataFrame, query: Mapping[int, float], primary_key: str) -> DataFrame:
    """Inner product per row that shares a term with the query: ``(<key>, score)``."""
    weight = F.lit(0.0)
    for term, value in sorted(query.items()):
        weight = F.when(F.col("term") == int(term), float(np.float32(value))).otherwise(weight)
    hits = postings.where(F.col("term").isin([int(t) for t in query]))
    product = (F.col("weight").cast("double") * weight).alias("part")
    scores = hits.select(primary_key, product).groupBy(primary_key).agg(F.sum("part").alias("score"))
    return scores.select(primary_key, F.col("score").cast("float").cast("double").alias("score"))


def sparse_topk(
    base: DataFrame,
    postings: DataFrame,
    query: Mapping[int, float],
    k: int,
    primary_key: str = "id",
    metric: str = "neg_ip",
    where=None,
) -> DataFrame:
    """First k rows by ascending (negative) inner product, from postings.

    Rows that share no term score 0 and take their place in the order by key. Only
    the first k of them can be in the result, so the base table adds its key column
    and at most k rows per task. Returns ``(<key>, distance)``.
    """
    metric = resolve_metric(metric)
    if metric not in ("ip", "neg_ip"):
        raise ValueError("sparse vectors support inner product metrics only")
    if not isinstance(query, Mapping):
        raise TypeError("a sparse query is a dict")
    scores = posting_scores(postings, query, primary_key)
    keys = filtered(base, where).select(primary_key)
    if where is not None:
        scores = scores.join(keys, primary_key, "left_semi")
    sign = F.lit(1.0) if metric == "ip" else F.lit(-1.0)
    matched = scores.select(primary_key, (sign * F.col("score") + F.lit(0.0)).alias("distance"))
    unmatched = (
        keys.join(scores.select(primary_key), primary_key, "left_anti")
        .orderBy(primary_key)
        .limit(k)
        .withColumn("distance", F.lit(0.0))
    )
    best = matched.orderBy("distance", primary_key).limit(k)
    return best.unionByName(unmatched).orderBy("distance", primary_key).limit(k)


def write_index(postings: DataFrame, path: str, buckets: int = TERM_BUCKETS) -> None:
    """Store sparse postings by tiers of their weight, and the tiers with their extremes beside them."""
    weight = F.col("weight").cast("double")
    tier = F.when(weight == 0, 0).otherwise(F.signum(weight).cast("int") * (impact.step(F.abs(weight)) + 10_000))
    write_postings(postings.withColumn("tier", tier), f"{path}/postings", buckets)
    stored = postings.sparkSession.read.parquet(f"{path}/postings")
    tiers = stored.groupBy("term", "tier").agg(F.count("*").alias("n"), F.min(weight).alias("low"), F.max(weight).alias("high"))
    write_postings(tiers, f"{path}/tiers", buckets)


def index_topk(
    base: DataFrame, path: str, query: Mapping[int, float], k: int, primary_key: str = "id", metric: str = "neg_ip",
    where=None, term_type: str = "int", buckets: int = TERM_BUCKETS,
) -> DataFrame:
    """:func:`sparse_topk` over what :func:`write_index` stored. Without ``where``, tiers that cannot
    hold one of the k rows are not read, and the base table is not read at all."""
    spark, terms = base.sparkSession, [int(t) for t in query]
    postings = read_terms(spark, f"{path}/postings", terms, term_type, buckets)
    if where is None and terms:
        sign = -1.0 if resolve_metric(metric) == "ip" else 1.0
        values = {int(t): sign * float(np.float32(v)) for t, v in query.items()}
        tiers = [
            impact.Tier(r["term"], r["tier"], r["n"], max(0.0, values[r["term"]] * r["low"], values[r["term"]] * r["high"]))
            for r in read_terms(spark, f"{path}/tiers", terms, term_type, buckets).collect()
        ]
        value = F.lit(0.0)
        for term, v in sorted(values.items()):
            value = F.when(F.col("term") == term, v).otherwise(value)
        scores = impact.best(postings, tiers, F.col("weight").cast("double") * value, k, primary_key)
        if scores is not None:
            rounded = F.col("score").cast("float").cast("double")
            found = scores.select(primary_key, (-rounded + F.lit(0.0)).alias("distance"))
            return found.orderBy("distance", primary_key).limit(k)
    return sparse_topk(base, postings.drop("tier"), query, k, primary_key, metric, where)
