"""Named tables and their indexes under one root folder.

The workspace ties the operators together: it finds tables and indexes by name,
stores the result of a mutation as a new version, searches rows that an index lacks beside
it, and picks exact search where rows of the index have changed.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from vecspark.functions import sqlfunctions
from vecspark.operators import fts, ivf, mutate, read, search, sparse
from vecspark.plans.hybrid import hybrid_search
from vecspark.session import number_rows, views
from vecspark.sources.schema import TableSpec, quick_collection, require_valid
from vecspark.sources.tables import VersionedTable, _Files, row_count

# Index types a caller may name, and the index that serves them.
VECTOR_INDEX_TYPES = {
    "hnsw": "flat", "hnsw_sq": "sq8", "ivf_flat": "flat", "ivf_sq8": "sq8", "ivf_pq": "pq",
}
SPARSE_INDEX_TYPES = ("daat",)

Rows = DataFrame | Mapping | Sequence[Mapping]


class Workspace:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._files = _Files(spark, self.root)

    # --- tables ---------------------------------------------------------------------------

    def _table(self, name: str) -> VersionedTable:
        table = VersionedTable(self.spark, f"{self.root}/tables/{name}")
        if not table.exists():
            raise ValueError(f"no table {name!r}")
        return table.pin()  # what a statement reads and what it changes are one state

    def table_names(self) -> list[str]:
        names = self._files.names(f"{self.root}/tables")
        return sorted(n for n in names if VersionedTable(self.spark, f"{self.root}/tables/{n}").exists())

    def has_table(self, name: str) -> bool:
        return name in self.table_names()

    def create_table(
        self, name: str, spec: TableSpec, vector_indexes: Mapping[str, Mapping] | None = None,
        text_indexes: Mapping[str, Mapping] | None = None, data: DataFrame | None = None,
    ) -> None:
        """Create a table, with indexes when given; nothing happens if it exists.

        Indexes map a name to the arguments of :meth:`create_vector_index` or
        :meth:`create_text_index`. An index on an empty table is built by the first
        refresh after rows have arrived.
        """
        if self.has_table(name):
            return
        rows = self.spark.createDataFrame([], spec.schema) if data is None else require_valid(data, spec)
        VersionedTable(self.spark, f"{self.root}/tables/{name}").create(rows, spec)
        for index, options in (vector_indexes or {}).items():
            self.create_vector_index(name, index, **options)
        for index, options in (text_indexes or {}).items():
            self.create_text_index(name, index, **options)

    def create_collection(self, name: str, dimension: int | None = None, spec: TableSpec | None = None, **options) -> None:
        """A table from a schema, or the short form: a key and a vector of ``dimension``."""
        if spec is None:
            if dimension is None:
                raise ValueError("a collection needs a dimension or a schema")
            spec = quick_collection(dimension, **options)
            options = {}
        self.create_table(name, spec, **options)

    def drop_table(self, name: str) -> None:
        VersionedTable(self.spark, f"{self.root}/tables/{name}").drop()
        self._files.delete(f"{self.root}/indexes/{name}")

    def read(self, name: str, partitions: Sequence[str] | None = None) -> DataFrame:
        table = self._table(name)
        return table.read(partitions, with_partitions=table.spec.layout is not None)

    def add_columns(self, name: str, fields: Sequence[T.StructField]) -> None:
        self._table(name).add_columns(fields)

    def drop_columns(self, name: str, columns: Sequence[str]) -> None:
        self._table(name).drop_columns(columns)

    def stats(self, name: str) -> dict[str, int]:
        return row_count(self.read(name)).first().asDict()

    def sql(self, text: str) -> DataFrame:
        """Any SQL over the tables by name, with the library's functions."""
        sqlfunctions.register(self.spark)
        named = [n for n in self.table_names() if n.lower() in text.lower()]
        with views(self.spark, {name: self._table(name).read() for name in named}):
            return self.spark.sql(text)

    # --- rows -----------------------------------------------------------------------------

    def _batch(self, table: VersionedTable, rows: Rows, order: bool = False) -> DataFrame | None:
        """New rows as a DataFrame with the table's types; None where there are none."""
        spec = table.spec
        if isinstance(rows, DataFrame):
            batch = rows
        else:
            items = [rows] if isinstance(rows, Mapping) else list(rows)
            if not items:
                return None
            names = [n for n in spec.names if any(n in item for item in items)]
            unknown = {n for item in items for n in item} - set(spec.names)
            if unknown:
                raise ValueError(f"columns not in the schema: {sorted(unknown)}")
            schema = T.StructType([T.StructField(n, spec.schema[n].dataType, True) for n in names])
            values = [tuple(_plain(item.get(n), spec.schema[n].dataType) for n in names) for item in items]
            if order:
                schema = schema.add("_order", T.LongType())
                values = [(*v, i) for i, v in enumerate(values)]
            batch = self.spark.createDataFrame(values, schema)
        key = spec.primary_key[0] if len(spec.primary_key) == 1 else None
        if spec.auto_id and key and key not in batch.columns:
            last = table.read().agg(F.max(key).alias("m")).first()["m"] or 0
            batch = number_rows(batch, last, key).withColumn(key, F.col(key).cast(spec.schema[key].dataType))
        return batch

    def _check_partition(self, table: VersionedTable, rows: DataFrame, partition: str | None) -> None:
        if partition is None:
            return
        layout = table.spec.layout
        if layout is None or partition not in layout.first.names:
            raise ValueError(f"no partition {partition!r}")
        if layout.assign(rows).where(F.col("_p0") != partition).first() is not None:
            raise ValueError(f"a row does not belong to partition {partition!r}")

    def insert(self, name: str, rows: Rows, partition: str | None = None) -> None:
        """Append rows; a key that is taken is an error. Existing data is not rewritten."""
        table = self._table(name)
        batch = self._batch(table, rows)
        if batch is None:
            return
        spec = table.spec
        new = require_valid(batch, spec)
        self._check_partition(table, new, partition)
        if spec.primary_key:
            homes = self._parts(self._placed(table, new)) if self._by_key(spec) else None
            taken = mutate.duplicate_keys(table.read(homes), new, spec.primary_key).first()
            if taken is not None:
                raise ValueError(f"duplicate key {tuple(taken)}")
        before = table.state
        table.append(new)
        self._follow_insert(name, table, before)

    def _follow_insert(self, name: str, table: VersionedTable, before: str) -> None:
        """Text indexes that held the table as it was take the new rows as a further segment."""
        indexes = self._indexes(name)
        held = [e for e in indexes.values() if e["family"] == "text" and e["path"] and e["state"] == before]
        for entry in held:
            index = fts.TextIndex.load(self.spark, entry["path"])
            index.append(table.read(parts=table.parts_since(before))).fold()
            entry["state"] = table.state
        if held:
            self._save_indexes(name, indexes)

    def upsert(self, name: str, rows: Rows, partition: str | None = None) -> None:
        """Replace whole rows by key; among new rows with one key the last wins."""
        table = self._table(name)
        batch = self._batch(table, rows, order=True)
        if batch is None:
            return
        spec = table.spec
        if "_order" in batch.columns:
            batch = mutate.last_per_key(batch, spec.primary_key, "_order").drop("_order")
        new = require_valid(batch, spec)
        self._check_partition(table, new, partition)
        base = table.read([partition] if partition else None)
        if partition is None and spec.layout:
            placed = [self._placed(table, new)]
            if not self._by_key(spec):  # the old row of a key may lie elsewhere
                keys = new.select(*spec.primary_key)
                placed.append(table.read(with_partitions=True).join(keys, list(spec.primary_key), "left_semi"))
            parts = self._parts(*placed)
            if parts:
                table.replace_partitions(parts, mutate.upsert(table.read(parts), new, spec.primary_key))
            return
        self._store(table, partition, mutate.upsert(base, new, spec.primary_key))

    def update(self, name: str, values: Mapping, where=None, partition: str | None = None) -> None:
        """Set columns; the changed rows must keep the schema's rules, and keys stay unique."""
        table = self._table(name)
        spec = table.spec
        base = table.read([partition] if partition else None)
        changed = mutate.update(read.filtered(base, where), values)
        require_valid(changed.select(*{**dict.fromkeys(spec.primary_key), **dict.fromkeys(values)}), spec)
        rows = mutate.update(base, values, where)
        if set(values) & set(spec.primary_key):
            taken = rows.groupBy(*spec.primary_key).agg(F.count("*").alias("n")).where("n > 1").first()
            if taken is not None:
                raise ValueError(f"duplicate key {tuple(taken)[:-1]}")
        if partition is None and spec.layout:
            # A changed row may move, so the folders that it goes to are rewritten too.
            parts = self._parts(read.filtered(table.read(with_partitions=True), where), spec.layout.assign(changed))
            if parts:
                table.replace_partitions(parts, mutate.update(table.read(parts), values, where))
            return
        self._store(table, partition, rows)

    def delete(self, name: str, ids=None, where=None, partition: str | None = None) -> None:
        table = self._table(name)
        base = table.read([partition] if partition else None)
        key = table.spec.primary_key
        if partition is None and table.spec.layout and (ids is not None or read.as_predicates(where)):
            hit = read.filtered(table.read(with_partitions=True), where)
            parts = self._parts(hit if ids is None else read.with_ids(hit, ids, key))
            if parts:
                table.replace_partitions(parts, mutate.delete(table.read(parts), ids, where, key))
            return
        self._store(table, partition, mutate.delete(base, ids, where, key))

    @staticmethod
    def _by_key(spec: TableSpec) -> bool:
        """Whether the primary key alone tells the first-level partition of a row."""
        first = spec.layout.first if spec.layout else None
        used = next((getattr(first, a) for a in ("columns", "expr", "key") if hasattr(first, a)), ())
        names = {used} if isinstance(used, str) else {*used}
        return bool(names) and names <= {*spec.primary_key}

    @staticmethod
    def _placed(table: VersionedTable, new: DataFrame) -> DataFrame:
        """New rows as the table will hold them, with their partitions."""
        spec = table.spec
        return spec.layout.assign(mutate.upsert(table.read().where(F.lit(False)), new, spec.primary_key))

    @staticmethod
    def _parts(*placed: DataFrame) -> list[str]:
        """First-level partitions that hold any of the rows; one name a partition reaches the driver."""
        names = reduce(DataFrame.unionByName, [df.select("_p0") for df in placed]).distinct()
        return sorted(r["_p0"] for r in names.collect())

    def _store(self, table: VersionedTable, partition: str | None, rows: DataFrame) -> None:
        """One partition is rewritten in place, a table without partitions as a new version."""
        if partition is None:
            table.replace(rows)
        else:
            table.replace_partition(partition, rows)

    def get(self, name: str, ids=None, where=None, names=None, partitions=None, limit=None, **options) -> DataFrame:
        key = self._table(name).spec.primary_key
        return read.get_rows(self.read(name, partitions), ids, where, names, key, partitions, limit, **options)

    def query(self, name: str, where=None, names=None, partitions=None, **options) -> DataFrame:
        return read.query_rows(self.read(name, partitions), where, names, partitions, **options)

    # --- indexes ----------------------------------------------------------------------------

    def _index_table(self, table: str) -> VersionedTable:
        """The small table that lists a table's indexes."""
        return VersionedTable(self.spark, f"{self.root}/indexes/{table}/list")

    def _indexes(self, table: str) -> dict[str, dict]:
        listed = self._index_table(table)
        return {r["name"]: r.asDict() for r in listed.read().collect()} if listed.exists() else {}

    def _save_indexes(self, table: str, indexes: Mapping[str, dict]) -> None:
        schema = "name string, family string, columns string, options map<string,string>, path string, state string"
        rows = [tuple(i[c] for c in ("name", "family", "columns", "options", "path", "state")) for i in indexes.values()]
        df = self.spark.createDataFrame(rows, schema)
        self._index_table(table).replace(df.coalesce(1), TableSpec(df.schema.fields))

    def _add_index(self, table: str, name: str, family: str, columns: Sequence[str], options: Mapping) -> None:
        indexes = self._indexes(table)
        if name in indexes:
            return
        missing = set(columns) - set(self._table(table).spec.names)
        if missing:
            raise ValueError(f"no column {sorted(missing)}")
        options = {k: str(v) for k, v in options.items() if v is not None}
        indexes[name] = {
            "name": name, "family": family, "columns": ",".join(columns), "options": options, "path": "", "state": "",
        }
        self._save_indexes(table, indexes)
        self._build(table, name)

    def create_vector_index(
        self, table: str, name: str, column: str, kind: str = "ivf_flat", metric: str = "l2",
        nlist: int | None = None, samples_per_nlist: int | None = None, m: int | None = None,
        filter_columns: Sequence[str] = (),
    ) -> None:
        """Index a vector column (sparse ones with kind ``daat``); an existing name is kept.

        Predicates on ``filter_columns`` are pushed into the lists that a search probes.
        """
        kind = kind.lower()
        if kind in SPARSE_INDEX_TYPES:
            if metric not in ("inner_product", "ip", "neg_ip", "negative_inner_product"):
                raise ValueError("a sparse index needs the inner product")
            self._add_index(table, name, "sparse", [column], {})
            return
        if kind not in VECTOR_INDEX_TYPES:
            raise ValueError(f"index type must be one of {sorted([*VECTOR_INDEX_TYPES, *SPARSE_INDEX_TYPES])}")
        if kind == "ivf_pq" and not m:
            raise ValueError("ivf_pq needs m")
        options = {"kind": VECTOR_INDEX_TYPES[kind], "metric": metric, "nlist": nlist,
                   "samples_per_list": samples_per_nlist, "m": m, "carry": ",".join(filter_columns) or None}
        self._add_index(table, name, "vector", [column], options)

    def create_text_index(self, table: str, name: str, columns: str | Sequence[str], parser: str = "space") -> None:
        names = [columns] if isinstance(columns, str) else list(columns)
        self._add_index(table, name, "text", names, {"parser": parser})

    def drop_index(self, table: str, name: str) -> None:
        indexes = self._indexes(table)
        gone = indexes.pop(name, None)
        if gone:
            self._save_indexes(table, indexes)
            if gone["path"]:
                self._files.delete(gone["path"])

    def _build(self, table: str, name: str) -> None:
        """Build an index for the current rows into a new folder."""
        stored, indexes = self._table(table), self._indexes(table)
        entry, state, rows = indexes[name], stored.state, stored.read()
        if rows.isEmpty():
            return
        key = stored.spec.primary_key
        if len(key) != 1:
            raise ValueError("an index needs a table with a single key column")
        path = f"{self.root}/indexes/{table}/{name}-{uuid.uuid4().hex}"
        columns, options = entry["columns"].split(","), entry["options"]
        if entry["family"] == "vector":
            numbers = {k: int(v) if k in ("nlist", "samples_per_list", "m") else v for k, v in options.items()}
            carry = [c for c in numbers.pop("carry", "").split(",") if c]
            ivf.build(rows, columns[0], key[0], path, carry=carry, **numbers)
        elif entry["family"] == "sparse":
            sparse.write_index(sparse.sparse_postings(rows, columns[0], key[0]), path)
        else:
            fts.TextIndex.build(rows, columns, key[0], path, options["parser"])
        entry.update(path=path, state=state)
        self._save_indexes(table, indexes)

    def refresh_index(self, table: str, name: str, trigger_threshold: int = ivf.REFRESH_ROWS) -> None:
        """Fold in rows added since the build, once there are more than the threshold."""
        stored, indexes = self._table(table), self._indexes(table)
        entry, state = indexes[name], stored.state
        if entry["state"] == state:
            return
        if not entry["path"] or entry["family"] == "sparse":
            self._build(table, name)
            return
        if entry["family"] == "text":
            fts.TextIndex.load(self.spark, entry["path"]).refresh(stored.read())
            entry["state"] = state
            self._save_indexes(table, indexes)
            return
        fresh = stored.parts_since(entry["state"])
        if fresh is not None and (not fresh or stored.read(parts=fresh).count() <= trigger_threshold):
            return  # searches add these rows by themselves
        rows = stored.read()
        ivf.refresh(rows, ivf.IvfIndex.load(self.spark, entry["path"]), 0)
        entry["state"] = state
        self._save_indexes(table, indexes)

    def rebuild_index(self, table: str, name: str, trigger_threshold: float = ivf.REBUILD_FRACTION) -> None:
        """Build anew once the changed fraction exceeds the threshold."""
        stored, entry = self._table(table), self._indexes(table)[name]
        if entry["state"] == stored.state:
            return
        if entry["path"] and entry["family"] == "vector":
            index = ivf.IvfIndex.load(self.spark, entry["path"])
            if ivf.changed_fraction(stored.read(), index) <= trigger_threshold:
                return
        self._build(table, name)

    def _current(self, table: str, family: str, column: str, name: str | None = None) -> dict | None:
        """An index of the column that covers the current rows."""
        state = self._table(table).state
        for entry in self._indexes(table).values():
            if entry["family"] == family and entry["columns"] == column and entry["state"] == state:
                if name is None or entry["name"] == name:
                    return entry
        return None

    # --- search -----------------------------------------------------------------------------

    def ann_search(
        self, table: str, query, column: str, metric: str = "l2", topk: int = search.DEFAULT_TOPK,
        where=None, names=None, columns=None, extra=None, with_distance: bool = False,
        threshold: float | None = None, partitions=None, index: str | None = None, nprobe: int | None = None,
        distance_name: str = "distance",
    ) -> DataFrame:
        """Nearest rows. Exact, with ``where`` applied first, unless ``index`` names an index.

        A named index makes the search approximate and applies ``where`` afterwards; rows
        inserted since its last refresh are searched exactly beside it. Updates and deletes
        make the search exact until the index is refreshed.
        """
        stored = self._table(table)
        rows = self.read(table, partitions)
        key = stored.spec.primary_key
        entry = self._indexes(table).get(index) if index else None
        usable = bool(entry and entry["family"] == "vector" and entry["columns"] == column and entry["path"])
        usable = usable and not partitions and not isinstance(query, Mapping)
        fresh: list[dict] | None = []
        if usable:
            found = ivf.IvfIndex.load(self.spark, entry["path"])
            if entry["state"] != stored.state:
                fresh = stored.parts_since(entry["state"])
            usable = fresh is not None and found.metric == ivf.resolve_metric(metric)
        if not usable:
            return search.ann_search(
                rows, query, column, metric, topk, key, where, names, columns, extra, with_distance,
                threshold, partitions, distance_name,
            )
        if where is None:
            hits = ivf.search(self.spark, found, query, topk, nprobe, threshold=threshold)
        else:
            hits = ivf.filtered_search(rows, found, query, where, topk, nprobe)
            if threshold is not None:
                hits = hits.where(F.col("distance") <= float(threshold))
        if fresh:
            delta = stored.read(with_partitions=stored.spec.layout is not None, parts=fresh)
            near = search.ann_search(
                delta, query, column, metric, topk, key, where, [key[0]], with_distance=True, threshold=threshold
            )
            hits = hits.unionByName(near)
        hits = hits.orderBy("distance", key[0]).limit(topk)  # few enough to be broadcast
        hits = hits.select(F.col(key[0]).alias("_key"), F.col("distance").alias("_dist"))
        chosen = read.output_columns(rows, names, columns, extra)
        joined = rows.join(F.broadcast(hits), F.col(key[0]) == F.col("_key")).select(*chosen, "_dist", "_key")
        best = joined.orderBy("_dist", "_key").limit(topk).drop("_key")
        return best.withColumnRenamed("_dist", distance_name) if with_distance else best.drop("_dist")

    def precise_search(self, table: str, query, column: str, metric: str = "l2", **options) -> DataFrame:
        stored = self._table(table)
        return search.precise_search(
            self.read(table, options.get("partitions")), query, column, metric,
            primary_key=stored.spec.primary_key, **options,
        )

    def search(self, table: str, data, column: str, with_distance: bool = False, where=None, limit: int = 10,
               names=None, search_params=None, partitions=None) -> DataFrame:
        return search.search(
            self.read(table, partitions), data, column, with_distance, where, limit, names, search_params,
            partitions, self._table(table).spec.primary_key,
        )

    def sparse_search(self, table: str, query: Mapping[int, float], column: str, k: int = 10,
                      metric: str = "neg_ip", where=None) -> DataFrame:
        """Sparse top-k ``(<key>, distance)``, from postings where an index is current."""
        key, rows = self._table(table).spec.primary_key[0], self._table(table).read()
        entry = self._current(table, "sparse", column)
        if entry is None:
            return search.ann_search(rows, query, column, metric, k, key, where, [key], with_distance=True)
        return sparse.index_topk(rows, entry["path"], query, k, key, metric, where)

    def match(self, table: str, query: str, columns: str | Sequence[str], where=None, parser: str | None = None) -> DataFrame:
        """Rows in which a query word occurs, tokenised as the columns' index says."""
        names = [columns] if isinstance(columns, str) else list(columns)
        entry = self._current(table, "text", ",".join(names))
        rows = self._table(table).read()
        if entry is None:
            return fts.match_filter(rows, query, *names, parser=parser or self._parser(table, names), where=where)
        index = fts.TextIndex.load(self.spark, entry["path"])
        if parser is not None and parser != index.parser:
            return fts.match_filter(rows, query, *names, parser=parser, where=where)
        return read.with_ids(read.filtered(rows, where), index.matching_keys(query), index.primary_key)

    def _parser(self, table: str, names: Sequence[str]) -> str:
        for entry in self._indexes(table).values():
            if entry["family"] == "text" and set(names) <= set(entry["columns"].split(",")):
                return entry["options"]["parser"]
        return "space"

    def hybrid_search(self, table: str, body: Mapping, metric: str = "l2", columns=None) -> DataFrame:
        """Run a hybrid request; current single-column text indexes replace text scans, vector indexes scans of vectors."""
        stored = self._table(table)
        key = stored.spec.primary_key
        if len(key) != 1:
            raise ValueError("hybrid search needs a single key column")
        text = [e for e in self._indexes(table).values() if e["family"] == "text" and "," not in e["columns"]]
        parsers = {e["columns"]: e["options"]["parser"] for e in text}
        state = stored.state
        indexes = {e["columns"]: fts.TextIndex.load(self.spark, e["path"]) for e in text if e["state"] == state}
        vectors = [e for e in self._indexes(table).values() if e["family"] == "vector" and e["path"] and e["state"] == state]
        return hybrid_search(
            stored.read(), body, key[0], parsers, "space", metric, indexes, columns or stored.spec.names,
            vector_indexes={e["columns"]: ivf.IvfIndex.load(self.spark, e["path"]) for e in vectors},
        )


def _plain(value, dtype: T.DataType):
    """Python numbers as the declared type expects them (1 for a float column)."""
    if value is None:
        return None
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return float(value)
    if isinstance(dtype, T.ArrayType):
        return [_plain(v, dtype.elementType) for v in value]
    if isinstance(dtype, T.MapType):
        if not isinstance(value, Mapping):
            raise TypeError("a sparse vector is a dict")
        return {k: _plain(v, dtype.valueType) for k, v in value.items()}
    return value
