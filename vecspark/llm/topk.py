"""Exact top-k by inner product, with bounds from segment statistics.

A vector is cut into segments, and of each its sum and the norm of its deviations from the
mean are kept. For two vectors the part of the inner product in a segment of n components is
at most sum_x * sum_y / n + deviation_x * deviation_y (Cauchy and Schwarz), so the sum over
segments bounds the product from above - the inner-product form of a lower-bounded distance.
Coarse segments are tried first; what survives is bounded by finer ones, and exact products are
computed for the last survivors.

Queries and rows meet in a grid of blocks, each pair of blocks in one task: rows are
repeated once for each block of queries, queries once for each block of rows, so neither
side is broadcast or collected. In a pair of blocks the k-th best exact product so far is the bar that
bounds must reach (reach, not pass: ties count). The k best of each block are reduced first by
task and then by query.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from vecspark.session import materialise

#: Rows and queries in a block.
ROW_BLOCK, QUERY_BLOCK = 8192, 1024
#: Segments at each level, coarse to fine.
LEVELS = (1, 4, 16)
#: Scores beyond these count as these.
LEAST, MOST = -(2**63), 2**63 - 1
#: Rows whose exact products set the bar before the bounds are used.
FIRST = 256


def scaled(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) for each component, as longs; null for vectors that take no part.

    What lies beyond 64 bits becomes the nearest long.
    """
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    finite = F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False))
    )
    return F.when(finite, whole)


def segment_statistics(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """(sum / sqrt(n), norm of deviations) of each segment; the last ones may be shorter."""
    edges = np.unique(np.linspace(0, vectors.shape[1], segments + 1).round().astype(int))
    starts, sizes = edges[:-1], np.diff(edges)
    sums = np.add.reduceat(vectors, starts, axis=1) if len(starts) else np.zeros((len(vectors), 0))
    squares = np.add.reduceat(vectors**2, starts, axis=1) if len(starts) else sums
    centred = sums / np.sqrt(sizes)
    return centred, np.sqrt(np.maximum(0.0, squares - centred**2))


def block_topk(queries: np.ndarray, rows: np.ndarray, qid: np.ndarray, rid: np.ndarray, k: int) -> list[tuple]:
    """(query id, row id, product) of the k best rows of each query, ties to smaller row ids."""
    order = np.argsort(rid, kind="stable")
    rows, rid = rows[order], rid[order]
    q, r = queries.astype(np.float64), rows.astype(np.float64)
    small = float(np.abs(q).max(initial=0)) * float(np.abs(r).max(initial=0)) * max(1, q.shape[1]) < 2**52

    def exact(i: int, which: np.ndarray) -> np.ndarray:
        if small:  # every partial sum is a whole number that a double holds
            return (r[which] @ q[i]).astype(np.int64)
        found = [sum(int(a) * int(b) for a, b in zip(rows[j], queries[i])) for j in which]
        return np.array([min(max(p, LEAST), MOST) for p in found], object)

    stats = [(segment_statistics(q, n), segment_statistics(r, n)) for n in LEVELS]
    slack = 1e-9 * (np.linalg.norm(q, axis=1).max(initial=0) * np.linalg.norm(r, axis=1).max(initial=0)) + 1e-6
    out = []
    for i in range(len(q)):
        (qs, qd), (rs, rd) = stats[0]
        bound = rs @ qs[i] + rd @ qd[i] + slack
        first = np.argpartition(-bound, min(FIRST, len(r)) - 1)[: max(FIRST, k)]
        mask = np.ones(len(r), bool)
        mask[first] = False
        own = first[rid[first] != qid[i]]
        score = exact(i, own)
        alive = np.flatnonzero(mask & (rid != qid[i]))
        for level in range(len(LEVELS)):
            if len(alive) == 0:
                break
            if level:
                (qs, qd), (rs, rd) = stats[level]
                bound[alive] = rs[alive] @ qs[i] + rd[alive] @ qd[i] + slack
            if len(score) >= k:
                bar = np.sort(score)[-k]
                alive = alive[bound[alive] >= float(bar) - slack]
        own, score = np.concatenate((own, alive)), np.concatenate((score, exact(i, alive)))
        best = sorted(range(len(own)), key=lambda j: (-score[j], rid[own[j]]))[:k] if not small else np.lexsort((rid[own], -score))[:k]
        out += [(qid[i], rid[own[j]], int(score[j])) for j in best]
    return out


def topk(
    vectors: DataFrame, queries: Callable[[Column], Column], key: str = "vec_id", vector: str = "embedding", k: int = 10, scale: int = 1024,
    row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """Columns query_id, rank, vec_id, score: the k rows with the largest inner product for each
    row whose key ``queries`` selects, other than itself; ties to the smaller key.

    Rows with a null key, a null vector or a component that is null or not finite take no part. Finite
    components of any size do: a scaled component or a product that 64 bits cannot hold counts as the
    nearest long, so such products tie.
    Only vectors of one length meet, and an empty vector has product 0 with others. Rows with
    the same key are one vector each, but none is a candidate of a query with that key;
    a repeated query is answered once, from its smallest vector.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), scaled(F.col(vector), scale).alias("v"))
    rows = rows.where("id IS NOT NULL AND v IS NOT NULL").withColumn("d", F.size("v"))
    # A number fixed by the written table deals the rows: equal rows go to different blocks.
    rows = materialise(rows.withColumn("_n", F.monotonically_increasing_id()), "topk-rows")
    asked = rows.where(queries(F.col("id"))).groupBy("id", "d").agg(F.min("v").alias("v"))
    sizes = rows.groupBy("d").count().select("d", F.ceil(F.col("count") / row_block).cast("int").alias("_rb"))
    counts = asked.groupBy("d").count().select("d", F.ceil(F.col("count") / query_block).cast("int").alias("_qb"))
    # One row for each length of vectors.
    grid = F.broadcast(sizes.join(counts, "d"))
    # The numbers of blocks are ints on both sides: an int and a long of one value hash to different partitions.
    left = asked.join(grid, "d").withColumn("q", F.pmod(F.xxhash64("id"), "_qb").cast("int")).withColumn(
        "r", F.explode(F.sequence(F.lit(0), F.col("_rb") - 1))
    )
    right = rows.join(grid, "d").withColumn("r", F.pmod(F.xxhash64("_n"), "_rb").cast("int")).withColumn(
        "q", F.explode(F.sequence(F.lit(0), F.col("_qb") - 1))
    )

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if len(a) == 0 or len(b) == 0:
            return pd.DataFrame({n: pd.Series([], dtype="int64") for n in names})
        pack = lambda v: np.array(v.tolist(), np.int64).reshape(len(v), -1)
        found = block_topk(pack(a["q_v"]), pack(b["v"]), a["q_id"].to_numpy(), b["id"].to_numpy(), k)
        return pd.DataFrame(found, columns=names)

    ours = left.select(*[F.col(c).alias(f"q_{c}") for c in ("d", "q", "r", "id", "v")])
    found = ours.groupBy("q_d", "q_q", "q_r").cogroup(right.select("d", "q", "r", "id", "v").groupBy("d", "q", "r"))
    found = found.applyInPandas(meet, "query_id long, vec_id long, score long")
    window = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
