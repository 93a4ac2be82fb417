"""Typed virtual tables over JSON documents, shared by many tenants.

Each row is one JSON document with its owner (``user_id``), group (``admin_id``) and
row id; the columns of a table are rows of a small meta table. The functions work on
DataFrames of such rows; :class:`JsonTables` keeps both on disk and runs statements.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vecspark.functions.jsonrules import TIMESTAMP_FORMAT, JsonType, checked_value, converted_value
from vecspark.operators.partition import KeyPartition, Layout
from vecspark.operators.read import conjunction
from vecspark.session import number_rows, views
from vecspark.sources.schema import TableSpec, field
from vecspark.sources.tables import VersionedTable

FIRST_COLUMN_ID = 16
RESERVED_NAMES = ("meta_json_t", "data_json_t")
STORE_COLUMNS = ("user_id", "admin_id", "jdata_id", "jdata")
_NO_DEFAULT = object()
_JSON_OPTIONS = {"timestampNTZFormat": TIMESTAMP_FORMAT}


@dataclass(frozen=True)
class JsonColumn:
    """A column of a JSON table. ``default`` is a SQL expression; None stands for NULL."""

    name: str
    type: JsonType
    nullable: bool = True
    has_default: bool = False
    default: str | None = None
    id: int = FIRST_COLUMN_ID

    @classmethod
    def of(cls, name: str, type_text: str, nullable: bool = True, default: str | None = _NO_DEFAULT) -> JsonColumn:
        """``default=None`` declares DEFAULT NULL; leave it out for no default."""
        has_default = default is not _NO_DEFAULT
        if not has_default or (default is not None and default.strip().upper() == "NULL"):
            default = None
        if not nullable and has_default and default is None:
            raise ValueError(f"invalid default value for {name!r}")
        return cls(name, JsonType.parse(type_text), nullable, has_default, default)

    def default_value(self) -> Column:
        if self.default is None:
            return F.lit(None).cast(self.type.spark)
        return checked_value(F.expr(self.default), self.type)


def document_type(columns: Sequence[JsonColumn]) -> T.StructType:
    return T.StructType([T.StructField(c.name, T.DataType.fromDDL(c.type.spark)) for c in columns])


def typed_rows(
    data: DataFrame, columns: Sequence[JsonColumn], with_id: bool = False, keep_store: bool = False
) -> DataFrame:
    """Documents expanded to their typed columns; the row id comes first when asked for.

    Columns of the store are not visible, so a user column may be called ``user_id``.
    """
    parsed = F.from_json("jdata", document_type(columns), _JSON_OPTIONS)
    rows = data.select(
        F.struct(*[c for c in STORE_COLUMNS if c != "jdata"]).alias("_store") if keep_store else F.lit(0).alias("_store"),
        *([F.col("jdata_id").alias("_row_id")] if with_id else []),
        parsed.alias("_doc"),
    )
    picked = [F.col("_doc").getField(c.name).alias(c.name) for c in columns]
    lead = [F.col("_row_id").alias("jdata_id")] if with_id else []
    return rows.select(*(["_store"] if keep_store else []), *lead, *picked)


def document(values: Mapping[str, Column]) -> Column:
    """The JSON text of a row; nulls stay as keys."""
    fields = [v.alias(name) for name, v in values.items()]
    if not fields:
        return F.lit("{}")
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false", **_JSON_OPTIONS})


def _restored(rows: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Typed rows (with ``_store``) back to store rows with a new document."""
    return rows.select("_store.user_id", "_store.admin_id", "_store.jdata_id", document(values).alias("jdata"))


def _required(value: Column, column: JsonColumn) -> Column:
    if column.nullable:
        return value
    error = F.raise_error(F.lit(f"column {column.name} may not be null"))
    return F.when(value.isNull(), error).otherwise(value)


def find_column(columns: Sequence[JsonColumn], name: str) -> JsonColumn:
    for column in columns:
        if column.name == name:
            return column
    raise ValueError(f"no column {name!r}")


# --- schema changes: each returns the new columns and the value of every column -------


@dataclass(frozen=True)
class AddColumn:
    column: JsonColumn

    def apply(self, columns: list[JsonColumn]) -> tuple[list[JsonColumn], dict[str, Column]]:
        if any(c.name == self.column.name for c in columns):
            raise ValueError(f"duplicate column {self.column.name!r}")
        new_id = max((c.id for c in columns), default=FIRST_COLUMN_ID - 1) + 1
        column = replace(self.column, id=new_id)
        values = {c.name: F.col(f"`{c.name}`") for c in columns}
        values[column.name] = column.default_value()
        return columns + [column], values


@dataclass(frozen=True)
class DropColumn:
    name: str

    def apply(self, columns):
        find_column(columns, self.name)
        kept = [c for c in columns if c.name != self.name]
        return kept, {c.name: F.col(f"`{c.name}`") for c in kept}


@dataclass(frozen=True)
class ModifyColumn:
    """New type and constraints; values are cast, misfits take the default if there is one."""

    column: JsonColumn

    def apply(self, columns):
        old = find_column(columns, self.column.name)
        new = replace(self.column, id=old.id)
        values = {c.name: F.col(f"`{c.name}`") for c in columns}
        cast = converted_value(values[old.name], old.type, new.type)
        if new.has_default and new.default is not None:
            cast = F.coalesce(cast, new.default_value())
        values[new.name] = cast.cast(new.type.spark)
        return [new if c.name == old.name else c for c in columns], values


@dataclass(frozen=True)
class ChangeColumn:
    """Rename and retype; the column becomes nullable with DEFAULT NULL."""

    old: str
    new: str
    type_text: str

    def apply(self, columns):
        old = find_column(columns, self.old)
        if self.new != self.old and any(c.name == self.new for c in columns):
            raise ValueError(f"duplicate column {self.new!r}")
        new = JsonColumn(self.new, JsonType.parse(self.type_text), True, True, None, old.id)
        values = {}
        for c in columns:
            value = F.col(f"`{c.name}`")
            if c.name == old.name:
                values[new.name] = converted_value(value, old.type, new.type).cast(new.type.spark)
            else:
                values[c.name] = value
        return [new if c.name == old.name else c for c in columns], values


def alter_rows(data: DataFrame, columns: Sequence[JsonColumn], actions: Sequence) -> tuple[list[JsonColumn], DataFrame]:
    """Apply schema changes in order; one pass over the documents serves all of them."""
    columns = list(columns)
    rows = typed_rows(data, columns, keep_store=True)
    for action in actions:
        columns, values = action.apply(columns)
        rows = rows.select("_store", *[v.alias(name) for name, v in values.items()])
    return columns, _restored(rows, {c.name: F.col(f"`{c.name}`") for c in columns})


# --- rows -------------------------------------------------------------------------------


def scoped(data: DataFrame, user_id: str | None, admin_id: str | None = None) -> DataFrame:
    """Rows of one tenant (None: of every tenant), of one group where given."""
    if user_id is not None:
        data = data.where(F.col("user_id") == user_id)
    if admin_id is not None:
        data = data.where(F.col("admin_id") == admin_id)
    return data


def new_documents(
    rows: DataFrame, columns: Sequence[JsonColumn], given: Sequence[str] | None = None
) -> Column:
    """The document of an inserted row: given values checked, the others defaulted."""
    given = list(rows.columns) if given is None else list(given)
    unknown = set(given) - {c.name for c in columns}
    if unknown:
        raise ValueError(f"no column {sorted(unknown)}")
    values = {}
    for c in columns:
        if c.name in given:
            value = checked_value(F.col(f"`{c.name}`"), c.type)
        elif c.has_default:
            value = c.default_value()
        elif not c.nullable:
            raise ValueError(f"column {c.name!r} has no default value")
        else:
            value = F.lit(None).cast(c.type.spark)
        values[c.name] = _required(value, c)
    return document(values)


def update_rows(
    data: DataFrame, columns: Sequence[JsonColumn], assignments: Mapping[str, str | Column], where=None,
    user_id: str | None = None, admin_id: str | None = None,
) -> DataFrame:
    """Store rows after an update; expressions and the predicate see the typed columns."""
    rows = typed_rows(data, columns, keep_store=True)
    touched = _touched(where, user_id, admin_id)
    values = {}
    for c in columns:
        old = F.col(f"`{c.name}`")
        if c.name in assignments:
            new = assignments[c.name]
            new = checked_value(F.expr(new) if isinstance(new, str) else new, c.type)
            values[c.name] = F.when(touched, _required(new, c)).otherwise(old)
        else:
            values[c.name] = old
    unknown = set(assignments) - set(values)
    if unknown:
        raise ValueError(f"no column {sorted(unknown)}")
    return _restored(rows, values)


def delete_rows(
    data: DataFrame, columns: Sequence[JsonColumn], where=None,
    user_id: str | None = None, admin_id: str | None = None,
) -> DataFrame:
    """Store rows that stay after a delete."""
    rows = typed_rows(data, columns, keep_store=True).where(~_touched(where, user_id, admin_id))
    return _restored(rows, {c.name: F.col(f"`{c.name}`") for c in columns})


def _touched(where, user_id: str | None, admin_id: str | None) -> Column:
    test = F.lit(True)
    if user_id is not None:
        test = test & (F.col("_store.user_id") == user_id)
    if admin_id is not None:
        test = test & (F.col("_store.admin_id") == admin_id)
    condition = conjunction(where)
    return F.coalesce(test if condition is None else test & condition, F.lit(False))


def admin_ids(data: DataFrame, user_id: str | None = None) -> DataFrame:
    return scoped(data, user_id).select("admin_id").distinct()


# --- the store ----------------------------------------------------------------------------

_META = TableSpec(
    [
        field("user_id", "string"), field("jtable_name", "string"), field("jcol_id", "bigint", True),
        field("jcol_name", "string", True), field("jcol_type", "string", True), field("jcol_nullable", "boolean", True),
        field("jcol_has_default", "boolean", True), field("jcol_default", "string", True), field("store_id", "string"),
    ]
)
_DATA = [field("user_id", "string"), field("admin_id", "string"), field("jdata_id", "bigint"), field("jdata", "string", True)]
#: Folders that the tenants of a table are dealt to by a hash of their id.
TENANT_PARTITIONS = 64


class JsonTables:
    """JSON tables of one group under a root folder.

    ``user_id`` limits reads and writes to one tenant; None sees all of them, and each
    call may name another. Metadata belongs to the group (``admin_id``).

    The documents of a table lie in ``partitions`` folders by a hash of the tenant, sorted by it. What is
    limited to a tenant reads its folder only, and a change rewrites the folders that
    hold a changed row. A large tenant has many files in its folder, written and read by many tasks.
    """

    def __init__(
        self, spark: SparkSession, root: str, user_id: str | None = None, admin_id: str = "0",
        partitions: int = TENANT_PARTITIONS,
    ):
        self.spark, self.root = spark, root.rstrip("/")
        self._layout = Layout(KeyPartition(("user_id",), partitions))
        self.user_id, self.admin_id = user_id, admin_id
        self._meta = VersionedTable(spark, f"{self.root}/meta")

    # metadata

    def _meta_rows(self) -> list[tuple]:
        """All meta rows of the store; one per declared column, so few."""
        return [tuple(r) for r in self._meta.read().collect()] if self._meta.exists() else []

    def _save_meta(self, rows: list[tuple]) -> None:
        df = self.spark.createDataFrame(rows, _META.schema).coalesce(1)
        self._meta.replace(df, _META)

    def _mine(self) -> dict[str, tuple[str, list[JsonColumn]]]:
        tables: dict[str, tuple[str, list[JsonColumn]]] = {}
        for user, table, cid, name, dtype, nullable, has_default, default, store in sorted(
            self._meta_rows(), key=lambda r: (r[1], r[2] or 0)
        ):
            if user != self.admin_id:
                continue
            columns = tables.setdefault(table, (store, []))[1]
            columns.append(JsonColumn(name, JsonType.parse(dtype), nullable, has_default, default, cid))
        return tables

    def tables(self) -> list[str]:
        return sorted(self._mine())

    def columns(self, table: str) -> list[JsonColumn]:
        return self._lookup(table)[1]

    def _lookup(self, table: str) -> tuple[VersionedTable, list[JsonColumn]]:
        mine = self._mine()
        if table not in mine:
            raise ValueError(f"no JSON table {table!r}")
        store, columns = mine[table]
        data = VersionedTable(self.spark, f"{self.root}/data/{store}").pin()
        # Columns that were changed are stored in the commit of the rows that fit them.
        changed = data.attributes.get("columns")
        return data, columns if changed is None else [JsonColumn(c[0], JsonType.parse(c[1]), *c[2:]) for c in changed]

    def _replace_columns(self, table: str, columns: Sequence[JsonColumn], new_name: str | None = None) -> None:
        store = self._mine()[table][0]
        others = [r for r in self._meta_rows() if not (r[0] == self.admin_id and r[1] == table)]
        self._save_meta(others + self._column_rows(new_name or table, columns, store))

    def _column_rows(self, table: str, columns: Sequence[JsonColumn], store: str) -> list[tuple]:
        return [
            (self.admin_id, table, c.id, c.name, str(c.type), c.nullable, c.has_default, c.default, store)
            for c in columns
        ]

    def _check_default(self, column: JsonColumn) -> None:
        if column.default is not None:
            self.spark.range(1).select(column.default_value()).collect()

    # statements

    def create(self, table: str, columns: Sequence[JsonColumn]) -> None:
        if table in RESERVED_NAMES:
            raise ValueError(f"invalid table name {table!r}")
        if table in self._mine():
            raise ValueError(f"table {table!r} exists")
        if not columns:
            raise ValueError("a table needs columns")
        if len({c.name for c in columns}) != len(columns):
            raise ValueError("duplicate column name")
        for c in columns:
            self._check_default(c)
        numbered = [replace(c, id=FIRST_COLUMN_ID + i) for i, c in enumerate(columns)]
        store = uuid.uuid4().hex
        spec = TableSpec(_DATA, layout=self._layout)
        empty = self.spark.createDataFrame([], spec.schema)
        VersionedTable(self.spark, f"{self.root}/data/{store}").create(empty, spec, {"last_id": 0})
        self._save_meta(self._meta_rows() + self._column_rows(table, numbered, store))

    def alter(self, table: str, *actions) -> None:
        """Schema changes in order: rows and columns change by one commit."""
        store, columns = self._lookup(table)
        for action in actions:
            if isinstance(action, (AddColumn, ModifyColumn)):
                self._check_default(action.column)
        columns, data = alter_rows(store.read(), columns, actions)
        store.replace(data, attributes={
            **store.attributes, "columns": [(c.name, str(c.type), c.nullable, c.has_default, c.default, c.id) for c in columns]
        })

    def rename(self, table: str, new_name: str) -> None:
        """Rows follow their table: they are stored under an id that does not change."""
        columns = self.columns(table)
        if new_name in RESERVED_NAMES or new_name in self._mine():
            raise ValueError(f"table {new_name!r} exists")
        self._replace_columns(table, columns, new_name)

    def _user(self, user_id: str | None) -> str | None:
        return self.user_id if user_id is None else user_id

    def insert(
        self, table: str, values: Sequence[Sequence] | DataFrame, columns: Sequence[str] | None = None,
        user_id: str | None = None,
    ) -> int:
        """Add rows and return their number.

        ``values`` is a DataFrame, or rows of values in which a string is a SQL
        expression and None is NULL. Without ``columns`` a row names every column.
        """
        user = self._user(user_id)
        if user is None:
            raise ValueError("an insert needs a user id")
        store, declared = self._lookup(table)
        names = list(columns) if columns else [c.name for c in declared]
        if isinstance(values, DataFrame):
            rows, given = values, list(values.columns)
        else:
            rows, given = self._value_rows(values, [find_column(declared, n) for n in names]), names
        self._check_group(self._stored(store, user), user)
        known = store.attributes
        last = known.get("last_id")
        if last is None:
            last = store.read().agg(F.max("jdata_id").alias("m")).first()["m"] or 0
        documents = rows.select(
            F.lit(user).alias("user_id"), F.lit(self.admin_id).alias("admin_id"),
            new_documents(rows, declared, given).alias("jdata"),
        )
        numbered = number_rows(documents, last, "jdata_id")
        count = numbered.count()
        store.append(numbered, {**known, "last_id": last + count})
        return count

    def _partition(self, layout: Layout, user: str) -> str:
        """Name of a tenant's partition."""
        return self.spark.range(1).select(F.lit(user).alias("user_id")).select(layout.first.column()).first()[0]

    def _stored(self, store: VersionedTable, user: str | None) -> DataFrame:
        """Documents of the tenant's partition, or of all; tables of an older form have no partitions."""
        layout = store.spec.layout
        return store.read(None if user is None or layout is None else [self._partition(layout, user)])

    def _change(self, table: str, user: str | None, where, rewrite) -> int:
        """Store ``rewrite(documents, columns)`` for the partitions that hold a touched row; returns the number of these."""
        store, columns = self._lookup(table)
        layout = store.spec.layout
        touched = typed_rows(self._stored(store, user), columns, keep_store=True).where(_touched(where, user, self.admin_id))
        if layout is None:
            count = touched.count()
            if count:
                store.replace(rewrite(store.read(), columns))
            return count
        part = replace(layout.first, columns=("_store.user_id",)).column()
        counts = {r["part"]: r["n"] for r in touched.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
        if counts:
            store.replace_partitions(list(counts), rewrite(store.read(list(counts)), columns))
        return sum(counts.values())

    def _value_rows(self, values: Sequence[Sequence], columns: Sequence[JsonColumn]) -> DataFrame:
        """Rows of expressions, evaluated in one projection."""
        structs = []
        for row in values:
            if len(row) != len(columns):
                raise ValueError(f"{len(columns)} values expected, got {len(row)}")
            cells = []
            for value, c in zip(row, columns):
                cell = F.expr(value) if isinstance(value, str) else F.lit(value)
                cells.append(checked_value(cell, c.type).cast(c.type.spark).alias(c.name))
            structs.append(F.struct(*cells))
        return self.spark.range(1).select(F.inline(F.array(*structs)))

    def _check_group(self, data: DataFrame, user: str) -> None:
        other = scoped(data, user).where(F.col("admin_id") != self.admin_id).select("admin_id").first()
        if other is not None:
            raise ValueError(f"user {user} has rows in group {other['admin_id']}")

    def check_admin(self, user_id: str | None = None) -> bool:
        """True unless the user has rows under another group in any table of the store."""
        user = self._user(user_id)
        stores = {r[8] for r in self._meta_rows()}
        for name in stores:
            data = VersionedTable(self.spark, f"{self.root}/data/{name}")
            if admin_ids(self._stored(data, user), user).where(F.col("admin_id") != self.admin_id).first() is not None:
                return False
        return True

    def update(self, table: str, assignments: Mapping[str, str | Column], where=None, user_id: str | None = None) -> int:
        user = self._user(user_id)
        return self._change(
            table, user, where, lambda data, columns: update_rows(data, columns, assignments, where, user, self.admin_id)
        )

    def delete(self, table: str, where=None, user_id: str | None = None) -> int:
        user = self._user(user_id)
        return self._change(
            table, user, where, lambda data, columns: delete_rows(data, columns, where, user, self.admin_id)
        )

    def read(self, table: str, user_id: str | None = None, with_id: bool = False) -> DataFrame:
        store, columns = self._lookup(table)
        user = self._user(user_id)
        return typed_rows(scoped(self._stored(store, user), user, self.admin_id), columns, with_id)

    def sql(self, query: str, user_id: str | None = None, with_id: bool = False) -> DataFrame:
        """A SELECT over the JSON tables by name, parsed and planned by Spark.

        The tables exist as temporary views only while the statement is analysed;
        with ``with_id`` they lead with ``jdata_id``.
        """
        named = [n for n in self.tables() if n.lower() in query.lower()]
        with views(self.spark, {name: self.read(name, user_id, with_id) for name in named}):
            return self.spark.sql(query)
