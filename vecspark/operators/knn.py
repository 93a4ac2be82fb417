"""Nearest neighbours for a whole table of queries.

Queries and base rows are packed into chunks: one row of Spark with a list of keys and the
bytes of a matrix. Chunks of queries and of base rows meet in an equality join on (group,
slice, block). Without an index there is one group, cut so that every core has pairs to score. The lists of an
inverted file form at most ``GROUPS`` groups of about equal rows: a query's vector is sent once to each group in which
it probes lists, with one bit for each list of the group, so that what is sent does not grow with the lists.
A group with many base rows is cut into slices. A task scores a pair of chunks by matrix products,
list by list with the queries that probe it, and keeps the k best rows per query; a chunk of queries meets its base
chunks one after another, so what a task holds is bounded and it emits k rows a query. The k-th distance so far is a bound: products in
single precision, with their error allowed for, tell which few rows may pass it, and only these are compared exactly.
Query vectors of at most ``BROADCAST_BYTES`` in all are
broadcast; beyond that both sides are shuffled, and no vector passes the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from vecspark.functions.distance import arrow_matrix, resolve_metric, score_matrix, score_pairs
from vecspark.session import materialise

# Bytes of vectors in one chunk of queries, and in one of base rows.
MAX_QUERY_BYTES = CHUNK_BYTES = 1024 * 1024
# Rows of a group in one slice, and, without an index, queries in one block.
SLICE_ROWS = 1 << 17
# Groups that the lists of an index form, and blocks that the queries of a group form.
GROUPS, BLOCKS = 32, 8
# Most bytes of query vectors that are broadcast; more of them meet the rows in a shuffled join.
BROADCAST_BYTES = 8 * 1024 * 1024
# Result rows that a task holds before it emits them.
_HELD = 1_000_000
# Parts of a query's candidates that are ranked apart first.
_PARTS = 32
# Rows x queries scored at once inside a task.
_TILE = 4_000_000
# Relative error a matrix product may carry; closer scores are compared again exactly.
_ERROR = 1e-12
# Rows that give a first bound, scores held at once against a bound, and pairs compared exactly at once.
_FIRST, _SCORES, _PAIRS = 256, 1 << 20, 1 << 16


def rough_scores(rows: np.ndarray, queries: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Scores (rows x queries) in the order of the metric, and a bound of their error per query."""
    row_norms, query_norms = np.linalg.norm(rows, axis=1), np.linalg.norm(queries, axis=1)
    largest = row_norms.max(initial=0.0)
    if metric == "l2":
        scores = rows @ (-2.0 * queries.T)  # added to in place: the scores are the largest array of a task
        scores += (row_norms**2)[:, None]
        scores += (query_norms**2)[None, :]
        return scores, _ERROR * (largest**2 + query_norms**2)
    scores = score_matrix(rows, queries, metric)
    error = np.full(len(queries), _ERROR) if metric == "cosine" else _ERROR * largest * query_norms
    return np.where(np.isnan(scores), np.inf, scores), error


def best_per_query(
    ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, metric: str, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, row id, distance) of the k best rows of each query."""
    positions, kept, distances = [], [], []
    step = max(1, _TILE // max(1, len(rows)))
    for start in range(0, len(queries), step):
        block = queries[start : start + step]
        scores, error = rough_scores(rows, block, metric)
        kth = np.partition(scores, min(k, len(rows)) - 1, axis=0)[min(k, len(rows)) - 1]
        r, q = np.nonzero((scores <= kth + 2.0 * error) & ~np.isinf(scores))
        parts = [slice(i, i + _PAIRS) for i in range(0, max(1, len(r)), _PAIRS)]
        exact = np.concatenate([score_pairs(rows[r[part]], block[q[part]], metric) for part in parts])
        order = np.lexsort((ids[r], exact, q))
        r, q, exact = r[order], q[order], exact[order]
        first = np.searchsorted(q, q, side="left")
        top = np.arange(len(q)) - first < k
        positions.append(q[top] + start)
        kept.append(ids[r[top]])
        distances.append(exact[top])
    return np.concatenate(positions), np.concatenate(kept), np.concatenate(distances)


def _merge(parts: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    q, ids, d = (np.concatenate(column) for column in zip(*parts))
    order = np.lexsort((ids, d, q))
    q, ids, d = q[order], ids[order], d[order]
    top = np.arange(len(q)) - np.searchsorted(q, q, side="left") < k
    return q[top], ids[top], d[top]


def _factors(vectors: np.ndarray, metric: str, query: bool) -> np.ndarray:
    """Matrices of rows and of queries whose products are the distances in the order of the metric: for l2 less the query's square
    and squared, for cosine less one."""
    if metric == "l2":
        last = np.ones(len(vectors)) if query else np.einsum("ij,ij->i", vectors, vectors)
        return np.column_stack([-2.0 * vectors if query else vectors, last])
    if metric == "cosine":
        norms = np.linalg.norm(vectors, axis=1)
        vectors = vectors / np.where(norms > 0, norms, 1.0)[:, None]
    return -vectors if query and metric != "ip" else vectors


def _single(rows: np.ndarray, queries: np.ndarray) -> np.ndarray | None:
    """A bound of the error of each query's products in single precision; None where they may leave its range.

    A sum of n products is off by at most about n units of the last place of the norms' product; it is allowed for twice, and n
    times the smallest number for products that vanish.
    """
    dim, row_norm, query_norms = rows.shape[1], np.linalg.norm(rows, axis=1).max(initial=0.0), np.linalg.norm(queries, axis=1)
    if not 1e-30 < row_norm < 1e37 or not row_norm * query_norms.max(initial=0.0) < 1e37:  # NaN too
        return None
    return (dim + 8) * 2.0**-23 * row_norm * np.maximum(query_norms, 1e-30) + dim * 2.0**-126


def _smallest_of_equals(ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Positions of the rows without those of equal vectors that have k smaller ids beside them."""
    same = np.unique(np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1] * rows.itemsize))).ravel(), return_inverse=True)[1]
    order = np.lexsort((ids, same))
    return order[np.arange(len(order)) - np.searchsorted(same[order], same[order], side="left") < k]


class Nearest:
    """The k best rows of each query of a chunk, over the chunks of rows that it meets."""

    def __init__(self, queries: np.ndarray, metric: str, k: int):
        self.queries, self.metric, self.k = queries, metric, k
        self.bound = np.full(len(queries), np.inf)  # the distance of the k-th best row so far
        self.factors = _factors(queries, metric, True)
        self.squares = np.einsum("ij,ij->i", queries, queries)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = self.settled = 0

    def _keep(self, q: np.ndarray, ids: np.ndarray, d: np.ndarray) -> None:
        self.parts.append((q, ids, d))
        self.held += len(q)

    def settle(self) -> None:
        """Merge what was found and lower the bounds."""
        if self.held == self.settled:
            return
        q, ids, d = best = _merge(self.parts, self.k)
        self.parts, self.held = [best], len(q)
        self.settled = self.held
        n = np.bincount(q, minlength=len(self.bound))
        full = n >= self.k
        self.bound[full] = np.minimum(self.bound[full], d[np.cumsum(n)[full] - 1])

    def taken(self) -> list[tuple[np.ndarray, ...]]:
        """What is held, which is held no longer; its bounds remain."""
        self.settle()
        parts, self.parts, self.held, self.settled = self.parts, [], 0, 0
        return parts

    def add(self, ids: np.ndarray, rows: np.ndarray, asking: np.ndarray) -> None:
        """Meet rows with the queries at the positions ``asking``."""
        queries, at, size = self.queries[asking], 0, max(_FIRST, 4 * self.k)
        factors = error = None
        while at < len(rows):
            if np.isfinite(self.bound[asking]).all() and factors is None:
                factors, mine = _factors(rows, self.metric, False), self.factors[asking]
                error = _single(factors, mine)
                factors, mine = (factors.astype(np.float32), mine.astype(np.float32)) if error is not None else (factors, mine)
            few = error is not None and self._compare(ids[at : at + size], rows[at : at + size], factors[at : at + size], mine, error, asking)
            if error is not None and not few:  # one vector may be that of many rows
                left = at + _smallest_of_equals(ids[at:], rows[at:], self.k)
                ids, rows, factors, at = ids[left], rows[left], factors[left], 0
                few = self._compare(ids[:size], rows[:size], factors[:size], mine, error, asking)
            if not few:  # or single precision tells too little apart
                q, found, d = best_per_query(ids[at : at + size], rows[at : at + size], queries, self.metric, self.k)
                self._keep(asking[q], found, d)
            at, size = at + size, 2 * size
            if self.held - self.settled > len(self.bound) // 2:
                self.settle()

    def _compare(self, ids, rows, factors, mine, error, asking) -> bool:
        """Keep the rows within the bounds; or, False and none, where they are more than a few."""
        bound = self.bound[asking]
        scores = {"l2": bound * bound - self.squares[asking], "cosine": bound - 1.0}.get(self.metric, bound)
        with np.errstate(over="ignore"):
            limit = np.nextafter((scores + error).astype(np.float32), np.float32(np.inf))
        step, found = max(1, _SCORES // max(1, len(asking))), []
        for low in range(0, len(rows), step):
            near = factors[low : low + step] @ mine.T <= limit
            hit = np.flatnonzero(near.any(axis=1))  # few rows have any
            r, q = np.nonzero(near[hit])
            r = hit[r]
            if len(r) > max(near.size // 16, 8 * self.k * len(asking)):
                return False
            for start in range(0, len(r), _PAIRS):
                some, of = r[start : start + _PAIRS] + low, q[start : start + _PAIRS]
                d = score_pairs(rows[some], self.queries[asking[of]], self.metric)
                best = d <= bound[of]
                found.append((asking[of[best]], ids[some[best]], d[best]))
        for part in found:
            self._keep(*part)
        return True


def _id_array(column: pa.Array) -> np.ndarray:
    return np.asarray(column.to_pandas())


def packer(dim: int, max_bytes: int, id_type: pa.DataType):
    """A ``mapInArrow`` function from (list, id, vector) to chunks (list, ids, vectors).

    Null vectors are left out. A chunk holds rows of one list and one batch.
    """
    per_chunk = max(1, max_bytes // (8 * dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            present, rows = arrow_matrix(batch.column(2), dim)
            lists = np.asarray(batch.column(0))[present]
            order = np.argsort(lists, kind="stable")
            edges = np.flatnonzero(np.diff(lists[order])) + 1
            for same in np.split(order, edges):
                for at in range(0, len(same), per_chunk):
                    part = same[at : at + per_chunk]
                    ids = batch.column(1).take(pa.array(present[part]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([int(lists[part[0]])], pa.int32()),
                            pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), ids.cast(id_type)),
                            pa.array([rows[part].tobytes()], pa.binary()),
                        ],
                        ["_list", "ids", "vectors"],
                    )

    return run


def group_lists(sizes: dict[int, int], groups: int) -> np.ndarray:
    """The group of every list up to the largest: runs of lists with about equal rows in all; -1 without rows."""
    held = np.zeros(max(sizes, default=-1) + 1, np.int64)
    for i, n in sizes.items():
        held[i] = n
    before = np.cumsum(held) - held
    return np.where(held > 0, before * groups // max(1, held.sum()), -1).astype(np.int32)


def list_packer(dim: int, max_bytes: int, id_type: pa.DataType, group_of: np.ndarray):
    """Like :func:`packer` for the rows of an index: chunks (group, ids, vectors, lists), sorted by list."""
    per_chunk = max(1, max_bytes // (8 * dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            present, rows = arrow_matrix(batch.column(2), dim)
            lists = np.asarray(batch.column(0))[present]
            order = np.argsort(lists, kind="stable")
            edges = np.flatnonzero(np.diff(group_of[lists[order]])) + 1
            for same in np.split(order, edges):
                for at in range(0, len(same), per_chunk):
                    part = same[at : at + per_chunk]
                    ids = batch.column(1).take(pa.array(present[part]))
                    offsets = pa.array([0, len(part)], pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([group_of[lists[part[0]]]], pa.int32()),
                            pa.ListArray.from_arrays(offsets, ids.cast(id_type)),
                            pa.array([rows[part].tobytes()], pa.binary()),
                            pa.ListArray.from_arrays(offsets, pa.array(lists[part], pa.int32())),
                        ],
                        ["_list", "ids", "vectors", "lists"],
                    )

    return run


def visit_packer(dim: int, max_bytes: int, group_of: np.ndarray):
    """A ``mapInArrow`` function from (key, vector, lists) to chunks of queries (group, ids, vectors, visited): one in
    each group where a query probes lists; ``visited`` has a row of bits for each query, one bit a list."""
    per_chunk = max(1, max_bytes // (8 * dim))
    spans = {int(g): _span(group_of, g) for g in np.unique(group_of[group_of >= 0])}
    step = max(per_chunk, _TILE * 8 // max(1, len(group_of)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                own = batch.slice(start, step)
                present, rows = arrow_matrix(own.column(1), dim)
                asked = own.column(2).take(pa.array(present))
                flat = np.asarray(asked.flatten())
                turn = np.repeat(np.arange(len(present)), np.asarray(asked.value_lengths()))
                known = flat < len(group_of)
                visits = np.zeros((len(present), len(group_of)), bool)
                visits[turn[known], flat[known]] = True
                visits[:, group_of < 0] = False
                for group, (low, high) in spans.items():
                    inside = visits[:, low:high]
                    some = np.flatnonzero(inside.any(axis=1))
                    for at in range(0, len(some), per_chunk):
                        part = some[at : at + per_chunk]
                        ids = own.column(0).take(pa.array(present[part]))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([group], pa.int32()),
                                pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), ids.cast(pa.int64())),
                                pa.array([rows[part].tobytes()], pa.binary()),
                                pa.array([np.packbits(inside[part], axis=1).tobytes()], pa.binary()),
                            ],
                            ["_list", "ids", "vectors", "visited"],
                        )

    return run


def _span(group_of: np.ndarray, group: int) -> tuple[int, int]:
    """The first list of a group and the one after its last."""
    own = np.flatnonzero(group_of == group)
    return int(own[0]), int(own[-1]) + 1


def pair_topk(dim: int, metric: str, k: int, id_type: pa.DataType, group_of: np.ndarray | None = None, in_turn: bool = True):
    """A ``mapInArrow`` function from pairs of chunks (numbers, queries, ids, rows) to the k best
    rows per query, merged over the pairs of a task as far as ``_HELD`` rows allow.

    ``in_turn``: the pairs of a chunk of queries follow one another, and are merged once it changes. With the groups of
    lists, pairs also have (group, visited, lists).
    """
    first_list = {} if group_of is None else {int(g): _span(group_of, g)[0] for g in np.unique(group_of[group_of >= 0])}

    def listed(batch: pa.RecordBatch, i: int, n_queries: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """Runs of rows, and the queries that ask for them."""
        if group_of is None:
            yield 0, len(batch.column(2)[i].values), np.arange(n_queries)
            return
        lists = np.asarray(batch.column(6)[i].values) - first_list[batch.column(4)[i].as_py()]
        visited = np.unpackbits(np.frombuffer(batch.column(5)[i].as_buffer(), np.uint8).reshape(n_queries, -1), axis=1)
        edges = np.concatenate(([0], np.flatnonzero(np.diff(lists)) + 1, [len(lists)]))
        for low, high in zip(edges[:-1], edges[1:]):
            asking = np.flatnonzero(visited[:, lists[low]])
            if len(asking):
                yield low, high, asking

    def table(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        q, ids, d = (np.concatenate(column) for column in zip(*parts))
        return pa.RecordBatch.from_arrays(
            [pa.array(q, pa.int64()), pa.array(ids, id_type), pa.array(d, pa.float64())], ["_q", "_id", "distance"]
        )

    def numbered(numbers: np.ndarray, near: Nearest | None) -> list[tuple[np.ndarray, ...]]:
        return [] if near is None else [(numbers[q], ids, d) for q, ids, d in near.taken()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        done: list[tuple[np.ndarray, ...]] = []
        held, current, near = 0, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                numbers = np.asarray(batch.column(0)[i].values)
                ids = _id_array(batch.column(2)[i].values)
                queries, rows = (
                    np.frombuffer(batch.column(c)[i].as_buffer(), np.float64).reshape(-1, dim) for c in (1, 3)
                )
                if in_turn:
                    if near is None or not np.array_equal(current, numbers):  # chunks of two groups may begin alike
                        done += numbered(current, near)
                        if sum(len(part[0]) for part in done) > _HELD // 10:
                            yield table(done)
                            done = []
                        current, near = numbers.copy(), Nearest(queries.copy(), metric, k)  # the batch is not kept
                    for low, high, asking in listed(batch, i, len(queries)):
                        near.add(ids[low:high], rows[low:high], asking)
                    if near.held > _HELD:
                        near.settle()
                        if near.held > _HELD // 2:
                            yield table(numbered(current, near))
                    continue
                for low, high, asking in listed(batch, i, len(queries)):
                    q, found, d = best_per_query(ids[low:high], rows[low:high], queries[asking], metric, k)
                    parts.append((numbers[asking[q]], found, d))
                    held += len(q)
                if held > _HELD:
                    parts = [_merge(parts, k)]
                    held = len(parts[0][0])
                    if held > _HELD // 2:
                        yield table(parts)
                        parts, held = [], 0
        if parts:
            done.append(_merge(parts, k))
        done += numbered(current, near)
        if done:
            yield table(done)

    return run


def _chunk_schema(id_type: T.DataType, *more: T.StructField) -> T.StructType:
    return T.StructType([
        T.StructField("_list", T.IntegerType()), T.StructField("ids", T.ArrayType(id_type)),
        T.StructField("vectors", T.BinaryType()), *more,
    ])


def _dealt_by(chunks: DataFrame) -> DataFrame:
    """Chunks with a hash of the first key to deal them by."""
    return chunks.withColumn("_hash", F.xxhash64(F.get("ids", F.lit(0))))


def _chunks(rows: DataFrame, vector: str, dim: int, max_bytes: int, id_type: T.DataType) -> DataFrame:
    """``rows`` (_list, _key, vector) in chunks."""
    packed = rows.select("_list", "_key", vector).mapInArrow(packer(dim, max_bytes, _arrow_type(id_type)), _chunk_schema(id_type))
    return _dealt_by(packed)


def knn_join(
    queries: DataFrame,
    base: DataFrame,
    k: int,
    metric: str = "l2",
    query_id: str = "query_id",
    query_vector: str = "vector",
    base_id: str = "id",
    base_vector: str = "vector",
    max_query_bytes: int = MAX_QUERY_BYTES,
    list_column: str | None = None,
    probe: Callable[[DataFrame, int], DataFrame | None] | None = None,
) -> DataFrame:
    """The k nearest base rows of every query: ``(query_id, base_id, distance, rank)``.

    ``probe(numbered, dim)`` adds the column ``_lists`` (the lists a query visits) to
    (_key, _vector), or gives None where every query visits all; with ``list_column`` it restricts a query to those lists of an
    inverted-file index. Rows and queries with a null vector take no part; queries with one
    id are answered each. No query gives no rows.
    """
    metric = resolve_metric(metric)
    spark = base.sparkSession
    id_type = base.schema[base_id].dataType
    rows = queries.where(F.col(query_vector).isNotNull())
    numbered = materialise(
        rows.select(F.monotonically_increasing_id().alias("_key"), F.col(query_id).alias("_qid"), F.col(query_vector).alias("_vector")),
        "knn-queries",
    )  # numbers are fixed once written
    n_queries, dim = numbered.agg(F.count("*"), F.max(F.size("_vector"))).first()
    if not n_queries:
        empty = T.StructType([
            queries.schema[query_id], T.StructField(base_id, id_type), T.StructField("distance", T.DoubleType()),
            T.StructField("rank", T.IntegerType()),
        ])
        return spark.createDataFrame([], empty)
    visits = probe(numbered.select("_key", "_vector"), dim) if probe else None
    source = base.select(
        (F.col(list_column) if visits is not None else F.lit(0)).cast("int").alias("_list"), F.col(base_id).alias("_key"),
        F.col(base_vector).alias("_vector"),
    )
    group_of = None
    if visits is None:
        visits, n_visits = numbered.select(F.lit(0).alias("_list"), "_key", "_vector"), n_queries
    else:
        sizes = dict(source.groupBy("_list").count().collect())  # one row per list
        group_of = group_lists(sizes, GROUPS)
        visits = visits.select("_key", "_vector", "_lists")
        n_visits = n_queries * min(GROUPS, len(sizes))
    small = 8 * dim * n_visits <= BROADCAST_BYTES
    dealt = lambda chunks: chunks
    slices, blocks = F.lit(1), F.lit(1)
    if small:  # every task has all queries, so groups need not be cut
        pass
    elif group_of is None:
        # One group: as many pairs of slices and blocks as keep every core busy, or more where a slice would be too large.
        n_rows = base.count()
        side = math.ceil(math.sqrt(4 * spark.sparkContext.defaultParallelism))
        n_slices, n_blocks = (
            max(1, math.ceil(n / SLICE_ROWS), min(side, math.ceil(8 * dim * n / CHUNK_BYTES))) for n in (n_rows, n_queries)
        )
        slices, blocks = F.lit(n_slices), F.lit(n_blocks)
        dealt = lambda chunks: chunks.repartition(4 * n_slices * n_blocks, "_list", "_slice", "_block")
    else:
        held = [0] * GROUPS
        for i, n in sizes.items():
            held[group_of[i]] += n
        cuts = [max(1, math.ceil(n / SLICE_ROWS)) for n in held]
        slices, blocks = F.get(F.array(*[F.lit(c) for c in cuts]), F.col("_list")), F.lit(BLOCKS)
        dealt = lambda chunks: chunks.repartition(2 * BLOCKS * sum(cuts), "_list", "_slice", "_block")

    if group_of is None:
        asked = _chunks(visits, "_vector", dim, max_query_bytes, T.LongType())
        stored = _chunks(source, "_vector", dim, CHUNK_BYTES, id_type)
        of_asked, of_stored = [], []
    else:
        asked = _dealt_by(visits.mapInArrow(visit_packer(dim, max_query_bytes, group_of), _chunk_schema(T.LongType(), T.StructField("visited", T.BinaryType()))))
        packed = source.select("_list", "_key", "_vector").mapInArrow(
            list_packer(dim, CHUNK_BYTES, _arrow_type(id_type), group_of), _chunk_schema(id_type, T.StructField("lists", T.ArrayType(T.IntegerType())))
        )
        stored = _dealt_by(packed)
        of_asked, of_stored = ["visited"], ["lists"]
    asked = asked.withColumns({"_slices": slices, "_blocks": blocks}).select(
        "_list", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_slices").cast("long") - 1)).alias("_slice"),
        F.pmod("_hash", "_blocks").cast("long").alias("_block"), F.col("ids").alias("_numbers"), F.col("vectors").alias("_asked"), *of_asked,
    )
    stored = stored.withColumns({"_slices": slices, "_blocks": blocks}).select(
        "_list", F.pmod("_hash", "_slices").cast("long").alias("_slice"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks").cast("long") - 1)).alias("_block"), "ids", "vectors", *of_stored,
    )
    on = ["_list", "_slice", "_block"]
    # In the merge join the left side is streamed: each chunk of queries meets the base chunks of its slice in turn.
    pairs = stored.join(F.broadcast(asked), on) if small else dealt(asked).join(dealt(stored).hint("merge"), on)
    pairs = pairs.select("_numbers", "_asked", "ids", "vectors", *(["_list", "visited", "lists"] if group_of is not None else []))
    out_schema = T.StructType([
        T.StructField("_q", T.LongType()), T.StructField("_id", id_type), T.StructField("distance", T.DoubleType()),
    ])
    more = ({} if group_of is None else {"group_of": group_of}) | ({"in_turn": False} if small else {})
    found = pairs.mapInArrow(pair_topk(dim, metric, k, _arrow_type(id_type), **more), out_schema)
    ranked, steps = found, [["_q"]]  # k rows a query from each slice of its groups
    if small:  # from every task
        ranked = found.withColumn("_part", F.pmod(F.xxhash64("_id"), F.lit(_PARTS)))
        steps = [["_q", "_part"], ["_q"]]
    for keys in steps:
        order = Window.partitionBy(*keys).orderBy("distance", "_id")
        ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = numbered.select(F.col("_key").alias("_q"), F.col("_qid").alias(query_id))
    return ranked.join(names, "_q").select(query_id, F.col("_id").alias(base_id), "distance", "rank")


def _arrow_type(dtype: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(dtype)
