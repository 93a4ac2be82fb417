"""Inverted-file vector indexes: flat, scalar-quantised (SQ8) and product-quantised (PQ).

Vectors are grouped by their nearest centre of a two-level tree (see ``centres``) and stored in one
folder per list, so a search that probes a few lists opens only their files. The number of
lists that is probed by default is measured at the build, for a stated recall.

Lists of SQ8 and PQ indexes hold the short codes only. The vectors lie in folders by a
hash of the key, sorted by key, and a search reads those of its best ``k * rerank`` candidates.
Columns named by ``carry`` are stored in the lists, so that predicates on them are pushed into the
scan of the probed lists.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, replace
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vecspark.functions.distance import arrow_matrix, as_float32, dense_distance, resolve_metric
from vecspark.operators.centres import Centres, fit, kmeans, nearest, sample_by_hash, unit_rows
from vecspark.operators.knn import knn_join
from vecspark.operators.read import conjunction, filtered
from vecspark.session import materialise
from vecspark.sources.tables import _Files

KINDS = ("flat", "sq8", "pq")
# Defaults of an index.
SEED = 42
SAMPLES_PER_LIST = 256
PQ_CENTRES = 256
RERANK = 16
REFRESH_ROWS = 10000
REBUILD_FRACTION = 0.2
# Rows of the table whose neighbours tell how many lists to probe, the share of the neighbours to reach, their
# number, and the most lists that are ranked for it.
TUNE_ROWS, RECALL, TUNE_K, TUNE_LISTS = 64, 0.95, 10, 4096
# Most bytes of centres that a batch search sends to its tasks; more of them meet the queries in a join.
CENTRE_BYTES = 8 << 20
# Vectors in one folder of a quantised index, and keys that are pushed down one by one.
BUCKET_ROWS, PUSHED_KEYS = 1 << 20, 400


@dataclass(frozen=True)
class IvfIndex:
    """An index on disk. ``min_values``/``steps`` serve SQ8, ``m`` PQ.

    ``lists`` names the lists that have rows and ``sizes`` how many; with them a search opens the folders it
    probes without listing the others. ``row_hash`` is the hash of a stored vector and what is carried with it; ``gone``
    is the folder of the (key, hash) pairs that left the table or have other values now.
    ``carried`` are the (name, type) of further columns in the lists. ``nprobe`` is the measured default.
    """

    path: str
    kind: str
    metric: str
    primary_key: str
    key_type: str
    vector: str
    dim: int
    nlist: int
    n_rows: int
    m: int | None = None
    min_values: tuple[float, ...] | None = None
    steps: tuple[float, ...] | None = None
    samples_per_list: int = SAMPLES_PER_LIST
    lists: tuple[int, ...] = ()
    sizes: tuple[int, ...] = ()
    gone: str | None = None
    carried: tuple[tuple[str, str], ...] = ()
    buckets: int = 1
    nprobe: int = 0

    def save_meta(self, spark: SparkSession) -> None:
        row = [(json.dumps(asdict(self)),)]
        spark.createDataFrame(row, "meta string").coalesce(1).write.mode("overwrite").text(f"{self.path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IvfIndex:
        meta = json.loads(spark.read.schema("value string").text(f"{path}/meta").first()[0])
        for name in ("min_values", "steps", "lists", "sizes"):
            meta[name] = tuple(meta[name]) if meta[name] is not None else None
        meta["carried"] = tuple(tuple(c) for c in meta["carried"])
        return cls(**{**meta, "path": path})

    @property
    def stored_columns(self) -> str:
        key = f"`{self.primary_key}` {self.key_type}"
        kinds = {
            "flat": f"{key}, `{self.vector}` array<float>, row_hash bigint",
            "sq8": f"{key}, row_hash bigint, codes array<tinyint>",
            "pq": f"{key}, row_hash bigint, codes array<tinyint>, bias double",
        }
        return ", ".join([kinds[self.kind], *[f"`{n}` {t}" for n, t in self.carried], "list_id int"])

    def rows(self, spark: SparkSession, lists: Sequence[int] | None = None) -> DataFrame:
        """All rows of the table as of the last refresh, or those of some lists."""
        stored = self.stored_rows(spark, lists)
        if self.gone is None:
            return stored
        gone = spark.read.schema(f"`{self.primary_key}` {self.key_type}, row_hash bigint").parquet(self.gone)
        return stored.join(gone, [self.primary_key, "row_hash"], "left_anti")

    def stored_rows(self, spark: SparkSession, lists: Sequence[int] | None = None) -> DataFrame:
        """All rows that were ever added, or those of some lists."""
        root = f"{self.path}/lists"
        reader = spark.read.schema(self.stored_columns).option("basePath", root)
        if lists is None:
            return reader.parquet(root)
        wanted = sorted({int(i) for i in lists} & set(self.lists))
        if not wanted:
            return reader.parquet(root).where(F.lit(False))
        return reader.parquet(*[f"{root}/list_id={i}" for i in wanted])

    def vectors(self, spark: SparkSession, buckets: Sequence[int] | None = None) -> DataFrame:
        """Key, row_hash and vector of a quantised index, from all folders or some."""
        root = f"{self.path}/vectors"
        schema = f"`{self.primary_key}` {self.key_type}, row_hash bigint, `{self.vector}` array<float>, bucket int"
        paths = [root] if buckets is None else [f"{root}/bucket={b}" for b in sorted(set(buckets))]
        return spark.read.schema(schema).option("basePath", root).parquet(*paths).drop("bucket")

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.primary_key), F.lit(self.buckets)).cast("int")

    def quantiser(self, spark: SparkSession) -> Quantiser:
        return _load_quantiser(spark, self.path, self.kind, self.metric, self.min_values, self.steps)

    def probe(self, spark: SparkSession, query: Sequence[float], nprobe: int) -> list[int]:
        """The nearest lists of a query."""
        return self.quantiser(spark).centres.probe(spark, np.asarray(query, float), nprobe)

    def lists_holding(self, spark: SparkSession, query: Sequence[float], n_rows: int) -> int:
        """How many of the nearest lists hold ``n_rows`` rows together."""
        held, wanted = dict(zip(self.lists, self.sizes)), 1
        while True:
            total = np.cumsum([held.get(i, 0) for i in self.probe(spark, query, wanted)])
            if total[-1] >= n_rows or wanted >= self.nlist:
                return int(np.searchsorted(total, min(n_rows, total[-1]))) + 1
            wanted = min(self.nlist, 2 * wanted)

    @property
    def default_nprobe(self) -> int:
        return self.nprobe or math.ceil(self.nlist / 8)


@dataclass(frozen=True)
class Quantiser:
    """What turns vectors into codes, and the centres."""

    centres: Centres
    codebooks: tuple[np.ndarray, ...] = ()
    low: np.ndarray | None = None
    steps: np.ndarray | None = None


@lru_cache(maxsize=32)
def _load_quantiser(spark, path, kind, metric, low, steps) -> Quantiser:
    """Read a quantiser once per index; its folders are never rewritten."""
    centres, books = Centres.load(spark, f"{path}/centres", metric), ()
    if kind == "pq":
        rows = spark.read.schema("part int, width int, book binary").parquet(f"{path}/codebooks").orderBy("part").collect()
        books = tuple(np.frombuffer(r["book"], np.float64).reshape(-1, r["width"]) for r in rows)
    if kind == "sq8":
        return Quantiser(centres, books, np.array(low), np.array(steps))
    return Quantiser(centres, books)


# --- inside tasks ---------------------------------------------------------------------------


def _list_column(matrix: np.ndarray, value_type: pa.DataType) -> pa.Array:
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1), value_type))


def encoder(q: Quantiser, kind: str, metric: str, dim: int, vector: str):
    """A task for ``Centres.place``: from (key, vector, row_hash, carried) to the stored columns."""
    books, low, steps = q.codebooks, q.low, q.steps

    def run(own: pa.Table, rows: np.ndarray, lists: np.ndarray, centres: np.ndarray) -> pa.Table:
        key, vectors, row_hash, *carried = own.columns
        columns = [key, vectors, row_hash] if kind == "flat" else [key, row_hash]
        if kind == "sq8":
            plain = arrow_matrix(vectors.chunk(0), dim)[1]
            codes = np.clip(np.rint((plain - low) / steps), 0, 255) - 128
            columns.append(_list_column(codes.astype(np.int8), pa.int8()))
        elif kind == "pq":
            codes, bias = _product_codes(rows, centres, books, metric)
            columns += [_list_column(codes, pa.int8()), pa.array(bias, pa.float64())]
        columns += [*carried, pa.array(lists, pa.int32())]
        key_name, vector_name, hash_name, *carried_names = own.column_names
        names = {"flat": [key_name, vector_name, hash_name], "sq8": [key_name, hash_name, "codes"], "pq": [key_name, hash_name, "codes", "bias"]}
        return pa.table(columns, names=[*names[kind], *carried_names, "list_id"])

    return run


def _product_codes(rows, centres, codebooks, metric) -> tuple[np.ndarray, np.ndarray]:
    """Codes of what is left after the centre, and the part of |v - q|^2 that no query changes."""
    rest = rows - centres
    width = rest.shape[1] // len(codebooks)
    codes = np.empty((len(rows), len(codebooks)), dtype=np.int8)
    coded = np.empty_like(rest)
    for i, book in enumerate(codebooks):
        part = slice(i * width, (i + 1) * width)
        chosen = nearest(rest[:, part], book)
        codes[:, i] = chosen - 128
        coded[:, part] = book[chosen]
    bias = np.zeros(len(rows))
    if metric == "l2":
        bias = np.einsum("ij,ij->i", coded, coded) + 2.0 * np.einsum("ij,ij->i", centres, coded)
    return codes, bias


def _value_ranges(dim: int):
    """Smallest and largest value per dimension, one row per task and dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(dim, np.inf), np.full(dim, -np.inf)
        for batch in batches:
            _, rows = arrow_matrix(batch.column(0), dim)
            if len(rows):
                low, high = np.minimum(low, rows.min(axis=0)), np.maximum(high, rows.max(axis=0))
        if np.isfinite(low).all():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dim), pa.int32()), pa.array(low), pa.array(high)], ["pos", "low", "high"]
            )

    return run


# --- building -------------------------------------------------------------------------------


def _fit_codebooks(sample: DataFrame, vector: str, centres: Centres, m: int, path: str) -> None:
    """One k-means per sub-vector, each in a task, on what the centres leave of a bounded sample."""
    width = centres.coarse.shape[1] // m

    def rest(own: pa.Table, rows: np.ndarray, lists: np.ndarray, near: np.ndarray) -> pa.Table:
        return pa.table([_list_column(rows - near, pa.float64())], names=["rest"])

    left = centres.place(sample.select(vector), vector, sample.count(), rest, "rest array<double>")
    parts = left.select(F.posexplode(F.array(*[F.slice("rest", i * width + 1, width) for i in range(m)])).alias("part", "v"))

    def book(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own = np.array(rows["v"].tolist(), np.float64)
        found = kmeans(own[np.lexsort(own.T[::-1])], PQ_CENTRES, SEED + int(key[0]))
        return pd.DataFrame({"part": [key[0]], "width": [width], "book": [found.tobytes()]})

    parts.groupBy("part").applyInPandas(book, "part int, width int, book binary").write.parquet(path)


def _row_hash(index: IvfIndex) -> Column:
    """Of all that the lists hold of a row, so that any change of it is seen."""
    return F.xxhash64(F.col(index.vector).cast("array<float>"), *[F.col(n).cast(t) for n, t in index.carried])


def _encode(rows: DataFrame, index: IvfIndex, n_rows: int) -> DataFrame:
    quantiser = index.quantiser(rows.sparkSession)
    source = rows.select(
        index.primary_key, F.col(index.vector).cast("array<float>").alias(index.vector), _row_hash(index).alias("row_hash"),
        *[F.col(n).cast(t).alias(n) for n, t in index.carried],
    )
    task = encoder(quantiser, index.kind, index.metric, index.dim, index.vector)
    return quantiser.centres.place(source, index.vector, n_rows, task, index.stored_columns)


def _write(rows: DataFrame, index: IvfIndex, n_rows: int, mode: str = "error") -> IvfIndex:
    """Write lists, and the vectors of a quantised index; adaptive execution splits a list with a
    large share of the rows."""
    spark = rows.sparkSession
    _encode(rows, index, n_rows).hint("rebalance", "list_id").write.mode(mode).partitionBy("list_id").parquet(f"{index.path}/lists")
    if index.kind != "flat":
        own = rows.select(
            index.primary_key, _row_hash(index).alias("row_hash"), F.col(index.vector).cast("array<float>").alias(index.vector),
            index.bucket().alias("bucket"),
        )
        own = own.repartitionByRange("bucket", index.primary_key).sortWithinPartitions("bucket", index.primary_key)
        own.write.mode(mode).partitionBy("bucket").parquet(f"{index.path}/vectors")
    folders = _Files(spark, index.path).names(f"{index.path}/lists")
    index = replace(index, lists=tuple(sorted(int(n[8:]) for n in folders if n.startswith("list_id="))))
    sizes = dict(index.stored_rows(spark).groupBy("list_id").count().collect())  # one row a list
    return replace(index, sizes=tuple(sizes.get(i, 0) for i in index.lists))


def _measured_nprobe(rows: DataFrame, index: IvfIndex, recall: float) -> int:
    """The lists to probe so that ``recall`` of the nearest neighbours lie in them, for rows chosen by hash."""
    spark, key = rows.sparkSession, index.primary_key
    asked = rows.orderBy(F.xxhash64(F.lit(SEED), key), key).limit(TUNE_ROWS).select(
        F.col(key).alias("query_id"), F.col(index.vector).cast("array<float>").alias("vector")
    )
    asked = materialise(asked, "ivf-tune")
    near = knn_join(asked, rows.select(key, F.col(index.vector).cast("array<float>").alias(index.vector)), TUNE_K + 1, index.metric, base_id=key, base_vector=index.vector)
    near = near.where(F.col("query_id") != F.col(key)).select("query_id", key)  # TUNE_ROWS * (TUNE_K + 1) rows at most
    lists = index.stored_rows(spark).select(key, "list_id").join(F.broadcast(near), key).select("query_id", "list_id").collect()
    vectors = {r["query_id"]: r["vector"] for r in asked.collect()}
    most = min(index.nlist, TUNE_LISTS)
    order = {q: {i: n for n, i in enumerate(index.probe(spark, v, most), 1)} for q, v in vectors.items()}
    ranks = [order[r["query_id"]].get(r["list_id"], most) for r in lists]
    return int(np.quantile(ranks, recall, method="higher")) if ranks else 1


def build(
    df: DataFrame,
    vector: str,
    primary_key: str,
    path: str,
    kind: str = "flat",
    metric: str = "l2",
    nlist: int | None = None,
    samples_per_list: int = SAMPLES_PER_LIST,
    m: int | None = None,
    carry: Sequence[str] = (),
    recall: float = RECALL,
) -> IvfIndex:
    """Fit centres on a sample, assign every vector, and write the lists under ``path``.

    ``nlist`` defaults to the square root of the row count and has no upper bound. PQ needs ``m``, the
    number of sub-vectors, which must divide the dimension. Rows with a null vector
    are not indexed. The columns ``carry`` are stored in the lists for predicates. The default number
    of probed lists is measured so that ``recall`` of the ten nearest rows are reached.
    """
    kind, metric = kind.lower(), resolve_metric(metric)
    if kind not in KINDS:
        raise ValueError(f"index kind must be one of {KINDS}")
    if kind == "pq" and not m:
        raise ValueError("a PQ index needs m")
    taken = {vector, primary_key, "row_hash", "codes", "bias", "list_id"} & set(carry)
    if taken:
        raise ValueError(f"an index cannot carry {sorted(taken)}")
    spark = df.sparkSession
    rows = df.select(primary_key, vector, *carry).where(F.col(vector).isNotNull())
    n, dim, low = rows.agg(F.count("*"), F.max(F.size(vector)), F.min(F.size(vector))).first()
    if not n:
        raise ValueError("nothing to index")
    if dim != low:
        raise ValueError("vectors have different dimensions")
    if kind == "pq" and dim % m:
        raise ValueError("m must divide the dimension")
    nlist = min(nlist or math.ceil(math.sqrt(n)), n)
    hashed = rows.select(primary_key, F.xxhash64(F.lit(SEED + 1), primary_key).alias("_h"), F.col(vector).cast("array<float>").alias(vector))
    part = lambda wanted: sample_by_hash(hashed, primary_key, 1.2 * wanted / n, SEED).drop(primary_key)
    centres = fit(materialise(part(nlist * samples_per_list), "ivf-sample"), vector, metric, nlist, f"{path}/centres", SEED)
    if kind == "pq":
        _fit_codebooks(materialise(part(PQ_CENTRES * samples_per_list), "ivf-sample"), vector, centres, m, f"{path}/codebooks")
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    index = IvfIndex(
        path, kind, metric, primary_key, types[primary_key], vector, dim, centres.nlist, n, m,
        samples_per_list=samples_per_list, carried=tuple((c, types[c]) for c in carry), buckets=math.ceil(n / BUCKET_ROWS),
    )
    if kind == "sq8":
        ranges = rows.select(vector).mapInArrow(_value_ranges(dim), "pos int, low double, high double")
        ends = ranges.groupBy("pos").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("pos").collect()
        steps = tuple((e["high"] - e["low"]) / 255.0 or 1.0 for e in ends)
        index = replace(index, min_values=tuple(e["low"] for e in ends), steps=steps)
    index = _write(rows, index, n)
    index = replace(index, nprobe=_measured_nprobe(rows, index, recall))
    index.save_meta(spark)
    return index


# --- searching --------------------------------------------------------------------------------


def _constant(values: np.ndarray) -> Column:
    """An array constant, passed as one text rather than one literal per number."""
    return F.from_json(F.lit(json.dumps([float(x) for x in values])), "array<double>")


def _coarse_distance(spark: SparkSession, index: IvfIndex, query: Sequence[float], rows: DataFrame) -> DataFrame:
    """``rows`` with the distance of the query to the coded vectors of a quantised index."""
    vector = np.asarray(query, dtype=float)
    if index.kind == "sq8":
        return rows.withColumn("distance", _scalar_distance(index, vector))
    q = index.quantiser(spark)
    if index.metric == "cosine":
        vector = unit_rows(vector[None, :])[0]
    dots = F.lit(0.0)
    for i, (book, part) in enumerate(zip(q.codebooks, vector.reshape(index.m, -1))):
        slot = F.element_at("codes", i + 1).cast("int") + 128
        dots = dots + F.get(_constant(book @ part), slot)
    # What the centre of a row's list adds: a few numbers a list, from the tasks that hold the centres.
    rows = rows.join(_centre_terms(spark, q.centres, vector), "list_id")
    if index.metric == "l2":
        return rows.withColumn("distance", F.sqrt(F.greatest(F.col("_square") + F.col("bias") - 2.0 * dots, F.lit(0.0))))
    product = F.col("_product") + dots
    if index.metric == "cosine":
        product = F.lit(1.0) - product
    elif index.metric == "neg_ip":
        product = F.lit(0.0) - product
    return rows.withColumn("distance", product)


def _centre_terms(spark: SparkSession, centres: Centres, vector: np.ndarray) -> DataFrame:
    """``list_id, _square, _product``: squared distance and inner product of each centre with a vector."""
    dim = len(vector)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, fine in zip(batch["first"], batch["fine"]):
                own = np.frombuffer(fine, np.float64).reshape(-1, dim)
                yield pd.DataFrame({"list_id": first + np.arange(len(own)), "_square": ((own - vector) ** 2).sum(axis=1), "_product": own @ vector})

    table = spark.read.schema(Centres.SCHEMA).parquet(centres.path).select("first", "fine")
    return table.mapInPandas(run, "list_id int, _square double, _product double")


def _scalar_distance(index: IvfIndex, query: np.ndarray) -> Column:
    """Distance to vectors coded as ``low + (code + 128) * step``, folded into one pass."""
    low, steps = np.array(index.min_values), np.array(index.steps)

    def total(weights: dict[str, np.ndarray], term) -> Column:
        constant = F.arrays_zip(*[_constant(w).alias(name) for name, w in weights.items()])
        return F.aggregate(F.zip_with("codes", constant, term), F.lit(0.0), lambda s, x: s + x)

    if index.metric == "l2":
        def squared(c: Column, w: Column) -> Column:
            rest = w["rest"] - c.cast("double") * w["step"]
            return rest * rest

        return F.sqrt(total({"rest": query - low - 128.0 * steps, "step": steps}, squared))
    dot = total({"w": query * steps}, lambda c, w: c.cast("double") * w["w"]) + float(query @ (low + 128.0 * steps))
    if index.metric == "cosine":
        def norm(c: Column, w: Column) -> Column:
            value = w["base"] + c.cast("double") * w["step"]
            return value * value

        length = F.sqrt(total({"base": low + 128.0 * steps, "step": steps}, norm)) * float(np.linalg.norm(query))
        return F.lit(1.0) - dot / F.when(length > 0, length)
    return dot if index.metric == "ip" else F.lit(0.0) - dot


def _first_k(scored: DataFrame, key: str, k: int) -> DataFrame:
    """The k nearest; filters stay above the limit so that distances are computed once."""
    return scored.orderBy(F.asc_nulls_last("distance"), key).limit(k).where(F.col("distance").isNotNull())


def search(
    spark: SparkSession,
    index: IvfIndex,
    query: Sequence[float],
    k: int = 10,
    nprobe: int | None = None,
    rerank: int = RERANK,
    threshold: float | None = None,
) -> DataFrame:
    """Approximate top-k over the nearest lists: ``(<key>, distance)``.

    With ``nprobe`` equal to the number of lists a flat index gives the exact answer. A quantised
    index finds the best ``k * rerank`` rows by their codes first, whose keys come to the driver, and then reads
    the vectors of these.
    """
    query = _checked(index, query)
    best = _nearest_rows(index.rows(spark, _probed(spark, index, query, nprobe)), index, query, k, rerank)
    return best if threshold is None else best.where(F.col("distance") <= float(threshold))


def _checked(index: IvfIndex, query: Sequence[float]) -> list[float]:
    query = as_float32(query)
    if len(query) != index.dim:
        raise ValueError("vectors have different dimensions")
    return query


def _probed(spark: SparkSession, index: IvfIndex, query: Sequence[float], nprobe: int | None) -> list[int] | None:
    """The lists to read; None for all."""
    nprobe = min(nprobe or index.default_nprobe, index.nlist)
    return index.probe(spark, query, nprobe) if nprobe < index.nlist else None


def any_of(key: str, values: Sequence) -> Column:
    """``key`` is one of ``values``, as a tree of comparisons: a long IN is not pushed down value by value."""
    if len(values) > PUSHED_KEYS:
        return F.col(key).isin(list(values))
    terms = [F.col(key) == F.lit(v) for v in values]
    while len(terms) > 1:
        terms = [reduce(lambda a, b: a | b, terms[i : i + 2]) for i in range(0, len(terms), 2)]
    return terms[0]


def _nearest_rows(rows: DataFrame, index: IvfIndex, query: Sequence[float], k: int, rerank: int) -> DataFrame:
    key, exact = index.primary_key, dense_distance(index.vector, query, index.metric).alias("distance")
    if index.kind == "flat":
        return _first_k(rows.select(key, exact), key, k)
    spark = rows.sparkSession
    coarse = _coarse_distance(spark, index, query, rows).select(key, "row_hash", "distance")
    kept = _first_k(coarse, key, k * rerank).select(key, "row_hash", index.bucket().alias("bucket")).collect()  # k * rerank rows
    if not kept:
        return index.vectors(spark).select(key, exact).where(F.lit(False))
    own = index.vectors(spark, [r["bucket"] for r in kept]).where(any_of(key, [r[key] for r in kept]))
    known = spark.createDataFrame([(r[key], r["row_hash"]) for r in kept], f"`{key}` {index.key_type}, row_hash bigint")
    own = own.join(F.broadcast(known), [key, "row_hash"], "left_semi")  # k * rerank rows
    return _first_k(own.select(key, exact), key, k)


def filtered_search(
    base: DataFrame, index: IvfIndex, query: Sequence[float], where, k: int = 10, nprobe: int | None = None,
    overfetch: int = 4, rerank: int = RERANK,
) -> DataFrame:
    """The nearest rows that pass the predicate, among the lists nearest to the query.

    A predicate on columns that the index carries is pushed into the scan of the ``nprobe`` nearest lists. Where
    fewer than k rows pass, as many further lists are read, then twice as many, until k rows are found or
    all lists are read: k rows come back whenever k rows qualify. Only the found rows (k a round) reach the driver.

    For other predicates one job over the keys counts the passing rows of each list. The search then reads the
    ``nprobe`` nearest lists, and more until they hold ``k * overfetch`` passing rows.
    """
    spark, query = base.sparkSession, _checked(index, query)
    nprobe = min(nprobe or index.default_nprobe, index.nlist)
    if not carries(spark, index, where):
        return _filtered_by_keys(base, index, query, where, k, nprobe, overfetch, rerank)
    if nprobe >= index.nlist:
        return _nearest_rows(filtered(index.rows(spark), where), index, query, k, rerank)
    found, seen, wanted = [], 0, nprobe
    while True:
        lists = index.probe(spark, query, wanted) if wanted < index.nlist else None
        fresh = lists[seen:] if lists is not None else sorted(set(index.lists) - read)
        found += _nearest_rows(filtered(index.rows(spark, fresh), where), index, query, k, rerank).collect()
        if len(found) >= k or lists is None:
            break
        read, seen, wanted = set(lists), wanted, min(index.nlist, 2 * wanted)
    key = index.primary_key
    best = sorted(found, key=lambda r: (r["distance"], r[key]))[:k]
    schema = f"`{key}` {index.key_type}, distance double"
    return _first_k(spark.createDataFrame([tuple(r) for r in best], schema), key, k)


def carries(spark: SparkSession, index: IvfIndex, where) -> bool:
    """Whether a predicate can be evaluated on the columns of the lists."""
    condition = conjunction(where)
    if condition is None:
        return True
    if not index.carried:
        return False
    own = spark.createDataFrame([], ", ".join([f"`{index.primary_key}` {index.key_type}", *[f"`{n}` {t}" for n, t in index.carried]]))
    try:
        own.where(condition).schema  # analysis only, no job
    except AnalysisException:
        return False
    return True


def _filtered_by_keys(base, index, query, where, k, nprobe, overfetch, rerank) -> DataFrame:
    spark, key = base.sparkSession, index.primary_key
    passing = filtered(base, where).select(key)
    counts = index.rows(spark).select(key, "list_id").join(passing, key, "left_semi").groupBy("list_id").count()
    held = dict(counts.collect())  # one row per list
    lists, total = [], 0
    for place, value in enumerate(index.probe(spark, query, index.nlist)):
        if place >= nprobe and total >= k * overfetch:
            break
        if value in held:
            lists.append(value)
            total += held[value]
    return _nearest_rows(index.rows(spark, lists).join(passing, key, "left_semi"), index, query, k, rerank)


def knn(
    queries: DataFrame, spark: SparkSession, index: IvfIndex, k: int, nprobe: int | None = None,
    query_id: str = "query_id", query_vector: str = "vector",
) -> DataFrame:
    """Approximate :func:`vecspark.operators.knn.knn_join`: a query meets its probed lists only.

    Lists are assigned in tasks. A query that probes every list meets all rows, without any lists.
    """
    nprobe = min(nprobe or index.default_nprobe, index.nlist)

    def probe(numbered: DataFrame, dim: int) -> DataFrame | None:
        if dim != index.dim:
            raise ValueError("vectors have different dimensions")
        if nprobe >= index.nlist:
            return None
        centres = index.quantiser(spark).centres
        if centres.nlist * dim * 8 <= CENTRE_BYTES:
            return centres.probe_here(spark, numbered, "_key", "_vector", nprobe)
        found = centres.probe_all(numbered, "_key", "_vector", nprobe)
        return numbered.join(found.groupBy("_key").agg(F.collect_list("_list").alias("_lists")), "_key")  # nprobe lists a query

    rows = index.rows(spark)
    if index.kind != "flat":
        rows = rows.select(index.primary_key, "row_hash", "list_id").join(index.vectors(spark), [index.primary_key, "row_hash"])
    return knn_join(
        queries, rows, k, index.metric, query_id, query_vector, index.primary_key, index.vector,
        list_column="list_id", probe=probe,
    )


# --- keeping up with the table ---------------------------------------------------------------


def _differences(base: DataFrame, index: IvfIndex, stored: DataFrame) -> DataFrame:
    """Key and hash of what only the table has (``missing``) or only ``stored``; one shuffle of keys and hashes."""
    both = [index.primary_key, "row_hash"]
    current = base.where(F.col(index.vector).isNotNull()).select(index.primary_key, _row_hash(index).alias("row_hash"))
    sides = current.select(*both, F.lit(True).alias("now")).unionByName(stored.select(*both, F.lit(False).alias("now")))
    found = sides.groupBy(*both).agg(F.bool_or("now").alias("missing"), F.bool_and("now").alias("_only_now"))
    return found.where((~F.col("missing")) | F.col("_only_now")).drop("_only_now")


def refresh(base: DataFrame, index: IvfIndex, threshold: int = REFRESH_ROWS) -> IvfIndex:
    """Bring the index up to date with ``base``.

    Rows that are gone or have another vector leave at once: their keys and hashes are written
    to a new folder, which searches leave out. Rows that the index lacks are added once there
    are more than ``threshold`` of them. Only keys and hashes are shuffled.
    """
    spark, key = base.sparkSession, index.primary_key
    found = materialise(_differences(base, index, index.stored_rows(spark)), "ivf-differences")
    missing, gone = found.where("missing").drop("missing"), found.where("NOT missing").drop("missing")
    n_new, n_gone = found.agg(F.count_if("missing"), F.count_if(~F.col("missing"))).first()
    grown = index
    if n_gone or index.gone:
        path = f"{index.path}/gone-{uuid.uuid4().hex}"
        gone.write.parquet(path)
        grown = replace(grown, gone=path if n_gone else None)
    if n_new > threshold:
        rows = base.where(F.col(index.vector).isNotNull()).select(key, index.vector, *[n for n, _ in index.carried])
        delta = rows.join(missing.select(key), key, "left_semi")
        grown = _write(delta, grown, n_new, "append")
    if grown is index:
        return index
    grown = replace(grown, n_rows=grown.rows(spark).count())
    grown.save_meta(spark)
    return grown


def changed_fraction(base: DataFrame, index: IvfIndex) -> float:
    """Rows added, gone or with another vector since the last refresh, relative to the index."""
    found = _differences(base, index, index.rows(base.sparkSession))
    return found.select(index.primary_key).distinct().count() / max(1, index.n_rows)


def rebuild(base: DataFrame, index: IvfIndex, path: str, threshold: float = REBUILD_FRACTION) -> IvfIndex:
    """Build anew under ``path`` once the changed fraction exceeds ``threshold``."""
    if changed_fraction(base, index) <= threshold:
        return index
    return build(
        base, index.vector, index.primary_key, path, index.kind, index.metric, None,
        index.samples_per_list, index.m, [n for n, _ in index.carried],
    )
