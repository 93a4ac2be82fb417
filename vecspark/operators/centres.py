"""Two levels of k-means centres for inverted files.

Coarse centres, about the square root of the number of lists, are fitted in one task from a bounded
sample. The sample rows of each coarse cell then give the cell its fine centres, cell by
cell in parallel; every fine centre is a list. Rows descend: nearest coarse centre first,
then the nearest fine centre of that cell, so that assigning a row compares it with about
2 * sqrt(lists) centres. The fine centres meet the rows in a join on the cell and are never
gathered, so their number has no limit. A search opens the cells nearest to the query and reads
the fine centres of these only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from vecspark.functions.distance import arrow_matrix, score_matrix
from vecspark.session import materialise

# Rounds of k-means, and rows of the sample for each coarse centre.
ROUNDS = 10
SAMPLES_PER_COARSE = 256
# Rows of the sample that one cell's fine centres are fitted on, and rows of a cell in one task.
CELL_ROWS = SLICE_ROWS = 1 << 16
# A search opens cells until they hold this many times the lists it probes.
BEAM = 4
# Rows x centres compared at once inside a task.
_TILE = 4_000_000


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Position of the centre nearest to each row."""
    norms = np.einsum("ij,ij->i", centres, centres)
    found = np.empty(len(rows), dtype=np.int32)
    step = max(1, _TILE // len(centres))
    for start in range(0, len(rows), step):
        block = rows[start : start + step]
        found[start : start + step] = np.argmin(norms[None, :] - 2.0 * (block @ centres.T), axis=1)
    return found


def unit_rows(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms > 0, norms, 1.0)


def kmeans(rows: np.ndarray, k: int, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """At most k centres; equal rows count once, so that copies take no centre from others."""
    rows = np.unique(rows, axis=0)
    if len(rows) <= k:
        return rows
    rng = np.random.default_rng(seed)
    centres = rows[np.sort(rng.choice(len(rows), k, replace=False))]
    for _ in range(rounds):
        own = nearest(rows, centres)
        sizes = np.bincount(own, minlength=k)
        sums = np.stack([np.bincount(own, rows[:, i], minlength=k) for i in range(rows.shape[1])], axis=1)
        moved = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
        empty = np.flatnonzero(sizes == 0)
        if len(empty):  # they restart at the rows farthest from their centres
            far = ((rows - centres[own]) ** 2).sum(axis=1)
            moved[empty] = rows[np.argsort(-far, kind="stable")[: len(empty)]]
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres


def shares(sizes: Sequence[int], total: int) -> list[int]:
    """``total`` dealt in proportion to ``sizes``: at least one each, at most the size."""
    sizes = np.asarray(sizes, float)
    given = np.minimum(np.maximum(1, np.floor(total * sizes / max(1.0, sizes.sum()))), np.maximum(1, sizes)).astype(int)
    for i in np.argsort(-(total * sizes / max(1.0, sizes.sum()) - given), kind="stable"):
        if given.sum() >= total:
            break
        given[i] += given[i] < sizes[i]
    for i in np.argsort(-given, kind="stable"):  # many small cells took one each
        given[i] -= min(given[i] - 1, max(0, given.sum() - total))
    return given.tolist()


def sample_by_hash(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """A sample that does not depend on how the table is split."""
    if fraction >= 1.0:
        return df
    return df.where(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(2**31)) < int(fraction * 2**31))


def _matrix(vectors: pd.Series, metric: str) -> np.ndarray:
    rows = np.array(vectors.tolist(), np.float64)
    return unit_rows(rows) if metric == "cosine" else rows


@dataclass
class Centres:
    """The coarse centres, and where the fine ones lie; list ids of cell c are first[c] and on."""

    path: str
    metric: str
    coarse: np.ndarray
    first: list[int]
    counts: list[int]
    held: dict[int, np.ndarray] = field(default_factory=dict)

    SCHEMA = "cell int, first int, lists int, coarse binary, fine binary"

    @classmethod
    def load(cls, spark: SparkSession, path: str, metric: str) -> Centres:
        rows = spark.read.schema(cls.SCHEMA).parquet(path).select("cell", "first", "lists", "coarse").orderBy("cell").collect()
        coarse = np.array([np.frombuffer(r["coarse"], np.float64) for r in rows])
        return cls(path, metric, coarse, [r["first"] for r in rows], [r["lists"] for r in rows])

    @property
    def nlist(self) -> int:
        return sum(self.counts)

    def cells(self, query: np.ndarray, wanted: int) -> list[int]:
        """The cells nearest to a query, until they hold ``wanted`` lists."""
        order = np.argsort(_ranked(self.coarse, query[None, :], self.metric)[:, 0], kind="stable")
        n = int(np.searchsorted(np.cumsum(np.array(self.counts)[order]), wanted)) + 1
        return [int(c) for c in order[:n]]

    def fine(self, spark: SparkSession, cells: Sequence[int]) -> dict[int, np.ndarray]:
        """The fine centres of some cells; those read before are kept."""
        missing = [c for c in cells if c not in self.held]
        if missing:
            rows = spark.read.schema(self.SCHEMA).parquet(self.path).where(F.col("cell").isin(missing)).select("cell", "fine").collect()
            self.held.update({r["cell"]: np.frombuffer(r["fine"], np.float64).reshape(-1, self.coarse.shape[1]) for r in rows})
        return {c: self.held[c] for c in cells}

    def probe(self, spark: SparkSession, query: np.ndarray, nprobe: int) -> list[int]:
        """The ``nprobe`` lists nearest to the query among the cells it opens."""
        cells = self.cells(query, BEAM * nprobe)
        fine = self.fine(spark, cells)
        lists = np.concatenate([self.first[c] + np.arange(len(fine[c])) for c in cells])
        scores = np.concatenate([_ranked(fine[c], query[None, :], self.metric)[:, 0] for c in cells])
        return lists[np.lexsort((lists, scores))[:nprobe]].tolist()

    def place(self, rows: DataFrame, vector: str, n_rows: int, task: Callable, schema: str) -> DataFrame:
        """``task(rows, vectors, lists, centres)`` on the rows of a cell, with their lists.

        ``task`` gets an Arrow table without the columns added here, the vectors as they are searched (unit
        length for cosine), and for each row its list and fine centre. Large cells are
        cut into slices, by the share that ``counts`` tell.
        """
        dim, metric, coarse = self.coarse.shape[1], self.metric, self.coarse
        slices = [max(1, math.ceil(n_rows * c / max(1, self.nlist) / SLICE_ROWS)) for c in self.counts]
        names = rows.columns
        at = names.index(vector)

        def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, own = arrow_matrix(batch.column(at), dim)
                if not len(own):
                    continue
                cells = nearest(unit_rows(own) if metric == "cosine" else own, coarse)
                turn = np.arange(len(own)) % np.array(slices)[cells]
                columns = [*batch.columns, pa.array(cells, pa.int32()), pa.array(turn, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, [*names, "_cell", "_slice"])

        added = T.StructType([*rows.schema.fields, T.StructField("_cell", T.IntegerType()), T.StructField("_slice", T.IntegerType())])
        left = rows.mapInArrow(descend, added)
        table = rows.sparkSession.read.schema(self.SCHEMA).parquet(self.path)
        count = F.get(F.array(*[F.lit(s) for s in slices]), F.col("cell"))
        right = table.select("cell", "first", "fine", F.explode(F.sequence(F.lit(0), count - 1)).alias("slice"))

        def run(own: pa.Table, fine: pa.Table) -> pa.Table:
            if not own.num_rows:
                return None
            own = own.combine_chunks()
            centres = np.frombuffer(fine["fine"][0].as_py(), np.float64).reshape(-1, dim)
            plain = arrow_matrix(own.column(at).chunk(0), dim)[1]
            searched = unit_rows(plain) if metric == "cosine" else plain
            found = nearest(searched, centres)
            return task(own.select(names), searched, found + fine["first"][0].as_py(), centres[found])

        def whole(own: pa.Table, fine: pa.Table) -> pa.Table:
            done = run(own, fine)
            return empty if done is None else done

        empty = _arrow_schema(rows.sparkSession, schema).empty_table()
        return left.groupBy("_cell", "_slice").cogroup(right.groupBy("cell", "slice")).applyInArrow(whole, schema)

    def probe_here(self, spark: SparkSession, queries: DataFrame, key: str, vector: str, nprobe: int) -> DataFrame:
        """``queries`` with ``_lists``, the nprobe nearest lists of each; every task gets all centres, so nothing is shuffled."""
        metric, dim, cells = self.metric, self.coarse.shape[1], range(len(self.coarse))
        held = self.fine(spark, cells)
        fine, counts = np.concatenate([held[c] for c in cells]), np.array(self.counts)
        lists = np.concatenate([self.first[c] + np.arange(counts[c]) for c in cells]).astype(np.int32)
        cell_of, coarse = np.repeat(np.arange(len(counts)), counts), self.coarse
        step = max(1, _TILE // len(fine))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, step):
                    own = batch.slice(start, step)
                    present, rows = arrow_matrix(own.column(1), dim)
                    if not len(rows):
                        continue
                    order = np.argsort(_ranked(coarse, rows, metric), axis=0, kind="stable")
                    before = np.cumsum(counts[order], axis=0) - counts[order]
                    opened = np.empty_like(order, dtype=bool)  # cells until they hold BEAM * nprobe lists
                    np.put_along_axis(opened, order, before < BEAM * nprobe, axis=0)
                    scores = _ranked(fine, rows, metric)
                    closed = ~opened[cell_of]
                    best = np.lexsort((np.broadcast_to(lists[:, None], scores.shape), scores, closed), axis=0)[:nprobe]
                    open_lists = ~np.take_along_axis(closed, best, axis=0).T
                    ends = np.concatenate(([0], np.cumsum(open_lists.sum(axis=1)))).astype(np.int32)
                    found = pa.ListArray.from_arrays(pa.array(ends), pa.array(lists[best].T[open_lists], pa.int32()))
                    at = pa.array(present)
                    yield pa.RecordBatch.from_arrays([own.column(0).take(at), own.column(1).take(at), found], [key, vector, "_lists"])

        kinds = {f.name: f.dataType.simpleString() for f in queries.schema.fields}
        return queries.select(key, vector).mapInArrow(run, f"`{key}` {kinds[key]}, `{vector}` {kinds[vector]}, _lists array<int>")

    def probe_all(self, queries: DataFrame, key: str, vector: str, nprobe: int) -> DataFrame:
        """``key, _list`` of the nprobe nearest lists of every query; neither side is gathered."""
        metric, dim = self.metric, self.coarse.shape[1]
        own = self

        def open_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, rows = arrow_matrix(batch.column(1), dim)
                cells = [own.cells(q, BEAM * nprobe) for q in rows]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cells, pa.list_(pa.int32()))], ["_key", "_vector", "_cells"])

        kind = queries.schema[key].dataType.simpleString()
        left = queries.select(key, vector).mapInArrow(open_cells, f"_key {kind}, _vector {queries.schema[vector].dataType.simpleString()}, _cells array<int>")
        # Blocks of queries, so that a cell which many queries open is shared out.
        left = left.select("_key", "_vector", F.explode("_cells").alias("_cell"), F.pmod(F.xxhash64("_key"), F.lit(16)).cast("int").alias("_block"))
        table = queries.sparkSession.read.schema(self.SCHEMA).parquet(self.path)
        right = table.select("cell", "first", "fine", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("block"))

        def rank(asked: pa.Table, fine: pa.Table) -> pa.Table:
            if not asked.num_rows:
                return empty
            asked = asked.combine_chunks()
            centres = np.frombuffer(fine["fine"][0].as_py(), np.float64).reshape(-1, dim)
            scores = _ranked(centres, arrow_matrix(asked["_vector"].chunk(0), dim)[1], metric)
            best = np.argsort(scores, axis=0, kind="stable")[:nprobe]
            which = np.tile(np.arange(asked.num_rows), len(best))
            return pa.table([
                asked["_key"].take(pa.array(which)), pa.array((best + fine["first"][0].as_py()).ravel(), pa.int32()),
                pa.array(np.take_along_axis(scores, best, axis=0).ravel(), pa.float64()),
            ], names=["_key", "_list", "_score"])

        schema = f"_key {kind}, _list int, _score double"
        empty = _arrow_schema(queries.sparkSession, schema).empty_table()
        ranked = left.groupBy("_cell", "_block").cogroup(right.groupBy("cell", "block")).applyInArrow(rank, schema)
        best = F.slice(F.array_sort(F.collect_list(F.struct("_score", "_list"))), 1, nprobe)  # opened lists of one query
        return ranked.groupBy("_key").agg(best.alias("b")).select("_key", F.explode("b._list").alias("_list"))


def _ranked(centres: np.ndarray, queries: np.ndarray, metric: str) -> np.ndarray:
    scores = score_matrix(centres, queries, metric)
    return np.where(np.isnan(scores), np.inf, scores)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T._parse_datatype_string(schema))


def fit(sample: DataFrame, vector: str, metric: str, nlist: int, path: str, seed: int) -> Centres:
    """Fit both levels on a written ``sample`` (columns ``_h``, an even hash, and the vector) and save them."""
    spark, n = sample.sparkSession, sample.count()
    n_coarse = max(1, math.ceil(math.sqrt(nlist)))
    part = min(1.0, n_coarse * SAMPLES_PER_COARSE / max(1, n))
    few = sample.where(F.pmod("_h", F.lit(2**31)) < int(part * 2**31)) if part < 1.0 else sample

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        found = kmeans(_matrix(rows[vector], metric), n_coarse, seed)
        return pd.DataFrame({"cell": range(len(found)), "coarse": [c.tobytes() for c in found]})

    # About n_coarse * SAMPLES_PER_COARSE rows meet in this task: the fourth root of the table, bounded.
    found = few.groupBy().applyInPandas(one, "cell int, coarse binary").orderBy("cell").collect()
    coarse = np.array([np.frombuffer(r["coarse"], np.float64) for r in found])

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(cell=nearest(_matrix(batch[vector], metric), coarse) if len(batch) else [])

    kind = sample.schema[vector].dataType.simpleString()
    placed = materialise(sample.select("_h", vector).mapInPandas(cells, f"_h long, `{vector}` {kind}, cell int"), "centre-sample")
    sizes = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}  # one row a coarse cell
    sizes = [sizes.get(c, 0) for c in range(len(coarse))]
    lists = shares(sizes, nlist)
    bounds = [int(min(1.0, CELL_ROWS / max(1, s)) * 2**31) for s in sizes]
    kept = placed.where(F.pmod(F.xxhash64("_h"), F.lit(2**31)) < F.get(F.array(*[F.lit(b) for b in bounds]), F.col("cell")))

    def fine(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own = kmeans(_matrix(rows[vector], metric), lists[key[0]], seed + 1 + int(key[0]))
        return pd.DataFrame({"cell": [key[0]], "n": [len(own)], "fine": [own.tobytes()]})

    fitted = materialise(kept.groupBy("cell").applyInPandas(fine, "cell int, n int, fine binary"), "centre-fine")
    counts = {r["cell"]: r["n"] for r in fitted.select("cell", "n").collect()}
    counts = [counts.get(c, 1) for c in range(len(coarse))]  # a cell without rows of the sample keeps its coarse centre
    first = np.concatenate(([0], np.cumsum(counts)[:-1])).astype(int).tolist()
    known = spark.createDataFrame(
        [(c, first[c], counts[c], coarse[c].tobytes()) for c in range(len(coarse))], "cell int, first int, lists int, coarse binary"
    )
    known.join(fitted.select("cell", "fine"), "cell", "left").select(
        "cell", "first", "lists", "coarse", F.coalesce("fine", "coarse").alias("fine")
    ).repartitionByRange("cell").write.parquet(path)
    return Centres(path, metric, coarse, first, counts)
