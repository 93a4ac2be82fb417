"""Exact nearest-neighbour search over one query vector.

The plan is one scan with a running top-k per task and a merge of k rows per task
(``TakeOrderedAndProject``); there is no shuffle of the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from vecspark.functions.distance import (
    as_float32,
    dense_distance,
    metric_name,
    resolve_metric,
    sparse_distance,
)
from vecspark.operators.partition import in_partitions
from vecspark.operators.read import filtered, output_columns
from vecspark.sources.ingest import sparse_to_text

DEFAULT_TOPK = 10


def query_distance(
    vector_column: str, query: Sequence[float] | Mapping[int, float], metric: str,
    float32: bool = True, arrow: bool = False,
) -> Column:
    """Distance of a column to one constant query, dense (list) or sparse (dict)."""
    if isinstance(query, Mapping):
        return sparse_distance(vector_column, query, metric)
    if isinstance(query, (str, bytes)) or not hasattr(query, "__len__"):
        raise TypeError("a query vector is a list of numbers or a dict")
    values = as_float32(query) if float32 else [float(x) for x in query]
    return dense_distance(vector_column, values, metric, arrow)


def ann_search(
    df: DataFrame,
    query: Sequence[float] | Mapping[int, float],
    vector_column: str,
    metric: str = "l2",
    k: int = DEFAULT_TOPK,
    primary_key: str | Sequence[str] | None = None,
    where=None,
    names: Sequence[str] | None = None,
    columns: Sequence[Column | str] | None = None,
    extra: Sequence[Column | str] | None = None,
    with_distance: bool = False,
    threshold: float | None = None,
    partitions: Sequence[str] | None = None,
    distance_name: str = "distance",
    float32: bool = True,
    arrow: bool = False,
) -> DataFrame:
    """The k rows first in ascending order of the metric, among those that pass ``where``.

    Ascending holds for every metric, so ``ip`` returns the least similar rows first
    and ``neg_ip`` the most similar. Rows without a distance (null vector) do not
    count. ``threshold`` keeps rows with distance <= threshold before the limit.
    Equal distances are ordered by ``primary_key``. ``arrow`` scores in Arrow batches
    instead of inside the JVM; nothing else decides between the two.
    """
    resolve_metric(metric)
    scope = filtered(in_partitions(df, partitions), where)
    dist = query_distance(vector_column, query, metric, float32, arrow)
    chosen = output_columns(df, names, columns, extra)
    keys = [primary_key] if isinstance(primary_key, str) else list(primary_key or [])
    carried = [F.col(key).alias(f"_key{i}") for i, key in enumerate(keys)]
    scored = scope.select(dist.alias("_dist"), *carried, *chosen)
    order = [F.asc_nulls_last("_dist"), *[f"_key{i}" for i in range(len(keys))]]
    # Tested after the limit: rows without a distance or beyond the threshold come last
    # in the order, and a filter below it would compute the distance a second time.
    best = scored.orderBy(*order).limit(k).where(F.col("_dist").isNotNull())
    if threshold is not None:
        best = best.where(F.col("_dist") <= F.lit(float(threshold)))
    best = best.drop(*[f"_key{i}" for i in range(len(keys))])
    if not with_distance:
        return best.drop("_dist")
    return best.select(*[F.col(f"`{c}`") for c in best.columns if c != "_dist"], F.col("_dist").alias(distance_name))


def precise_search(df: DataFrame, query: Sequence[float], vector_column: str, metric: str = "l2", **options) -> DataFrame:
    """:func:`ann_search` with the query kept in double precision."""
    return ann_search(df, query, vector_column, metric, float32=False, **options)


def search(
    df: DataFrame,
    data: Sequence[float] | Mapping[int, float],
    vector_column: str,
    with_distance: bool = False,
    where=None,
    limit: int = DEFAULT_TOPK,
    names: Sequence[str] | None = None,
    search_params: Mapping[str, str] | None = None,
    partitions: Sequence[str] | None = None,
    primary_key: str | Sequence[str] | None = None,
    distance_name: str = "distance",
) -> DataFrame:
    """Collection search: the metric comes by name in ``search_params['metric_type']``.

    Sparse vector columns are returned as text.
    """
    metric = metric_name((search_params or {}).get("metric_type", "l2"))
    found = ann_search(
        df, data, vector_column, metric, limit, primary_key, where, names,
        with_distance=with_distance, partitions=partitions, distance_name=distance_name,
    )
    sparse = [f.name for f in df.schema.fields if f.dataType.simpleString() == "map<int,float>"]
    return found.withColumns({c: sparse_to_text(c) for c in sparse if c in found.columns})
