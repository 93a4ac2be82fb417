"""Declared table schemas and the check of a DataFrame against them."""

from __future__ import annotations

import json
from dataclasses import dataclass, field as dc_field

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Types a primary key may not have.
_NOT_A_KEY = (
    T.ArrayType, T.MapType, T.StructType, T.FloatType, T.DoubleType, T.VariantType
)
DEFAULT_VARCHAR = 16384
MAX_ARRAY_DEPTH = 6


_SIMPLE = {
    t.simpleString(): t
    for t in (
        T.StringType(), T.BooleanType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(),
        T.FloatType(), T.DoubleType(), T.DateType(), T.TimestampType(), T.TimestampNTZType(),
    )
}


def data_type(dtype: T.DataType | str) -> T.DataType:
    """A type object for a type or its name; simple names need no running session."""
    if isinstance(dtype, T.DataType):
        return dtype
    return _SIMPLE.get(dtype) or T.DataType.fromDDL(dtype)


def field(name: str, dtype: T.DataType | str, nullable: bool = False, **params) -> T.StructField:
    """A field; ``params`` (dim, max_length, srid, json ...) travel as metadata."""
    return T.StructField(name, data_type(dtype), nullable, {k: v for k, v in params.items() if v is not None})


def vector_field(name: str, dim: int, nullable: bool = False) -> T.StructField:
    if not isinstance(dim, int) or dim < 1:
        raise ValueError("a vector field needs a dimension")
    return field(name, T.ArrayType(T.FloatType(), True), nullable, dim=dim)


def sparse_field(name: str, nullable: bool = False) -> T.StructField:
    return field(name, T.MapType(T.IntegerType(), T.FloatType(), True), nullable, sparse=True)


def varchar_field(name: str, max_length: int, nullable: bool = False) -> T.StructField:
    if not isinstance(max_length, int) or max_length < 1:
        raise ValueError("a varchar field needs max_length")
    return field(name, T.StringType(), nullable, max_length=max_length)


def text_field(name: str, nullable: bool = False) -> T.StructField:
    """Unbounded text; may not be a primary key."""
    return field(name, T.StringType(), nullable, text=True)


def json_field(name: str, nullable: bool = False) -> T.StructField:
    return field(name, T.StringType(), nullable, json=True)


def array_field(
    name: str, element: T.DataType | str, depth: int = 1, nullable: bool = False
) -> T.StructField:
    dtype = data_type(element)
    if not 1 <= depth <= MAX_ARRAY_DEPTH:
        raise ValueError(f"arrays nest 1 to {MAX_ARRAY_DEPTH} levels")
    for _ in range(depth):
        dtype = T.ArrayType(dtype, True)
    return field(name, dtype, nullable, depth=depth)


def collection_array_field(name: str, element: T.DataType | str, nullable: bool = False):
    """An array field of a collection, whose elements must be plain scalars."""
    dtype = data_type(element)
    if isinstance(dtype, (T.ArrayType, T.StringType)):
        raise ValueError("collection arrays hold numbers or booleans")
    return array_field(name, dtype, 1, nullable)


def point_field(name: str, srid: int | None = None, nullable: bool = False) -> T.StructField:
    dtype = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
    return field(name, dtype, nullable, srid=srid)


@dataclass
class TableSpec:
    """Fields, primary key, default expressions and the partition layout of a table."""

    fields: list[T.StructField]
    primary_key: tuple[str, ...] = ()
    defaults: dict[str, str] = dc_field(default_factory=dict)
    auto_id: bool = False
    layout: object | None = None

    def __post_init__(self):
        if isinstance(self.primary_key, str):
            self.primary_key = (self.primary_key,)
        self.primary_key = tuple(self.primary_key)
        by_name = {f.name: f for f in self.fields}
        if len(by_name) != len(self.fields):
            raise ValueError("duplicate field name")
        for name in self.primary_key:
            if name not in by_name:
                raise ValueError(f"primary key column {name!r} is not a field")
            f = by_name[name]
            if isinstance(f.dataType, _NOT_A_KEY) or f.metadata.get("text") or f.metadata.get("json"):
                raise ValueError(f"{name!r} may not be a primary key: {f.dataType.simpleString()}")

    @property
    def schema(self) -> T.StructType:
        return T.StructType(list(self.fields))

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def to_json(self) -> str:
        return json.dumps(
            {
                "schema": self.schema.jsonValue(),
                "primary_key": list(self.primary_key),
                "defaults": self.defaults,
                "auto_id": self.auto_id,
                "layout": self.layout.to_dict() if self.layout else None,
            }
        )

    @classmethod
    def from_json(cls, text: str) -> TableSpec:
        from vecspark.operators.partition import Layout

        d = json.loads(text)
        return cls(
            T.StructType.fromJson(d["schema"]).fields,
            tuple(d["primary_key"]),
            d["defaults"],
            d["auto_id"],
            Layout.from_dict(d["layout"]) if d["layout"] else None,
        )


def quick_collection(
    dimension: int,
    id_name: str = "id",
    id_type: T.DataType | None = None,
    vector_name: str = "vector",
    max_length: int = DEFAULT_VARCHAR,
    auto_id: bool = False,
) -> TableSpec:
    """A key and a vector: the short form of a collection."""
    id_type = id_type or T.LongType()
    if isinstance(id_type, T.StringType):
        key = varchar_field(id_name, max_length)
    else:
        key = field(id_name, id_type)
    return TableSpec([key, vector_field(vector_name, dimension)], (id_name,), auto_id=auto_id)


def _try_cast(f: T.StructField, source: T.DataType) -> Column:
    column = F.col(f.name)
    if source == f.dataType or isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return column.cast(f.dataType)
    return column.try_cast(f.dataType)


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``df`` with the declared columns in order, cast; absent ones take their default."""
    unknown = set(df.columns) - set(spec.names)
    if unknown:
        raise ValueError(f"columns not in the schema: {sorted(unknown)}")
    present = dict(zip(df.columns, (f.dataType for f in df.schema.fields)))
    columns = []
    for f in spec.fields:
        if f.name in present:
            column = _try_cast(f, present[f.name])
        elif f.name in spec.defaults:
            column = F.expr(spec.defaults[f.name]).cast(f.dataType)
        else:
            column = F.lit(None).cast(f.dataType)
        columns.append(column.alias(f.name, metadata=dict(f.metadata)))
    return df.select(columns)


def _row_rules(df: DataFrame, spec: TableSpec) -> list[tuple[str, str, Column]]:
    """(field, rule, violated) for every rule a single row can break."""
    types = {f.name: f.dataType for f in df.schema.fields}
    rules = []
    for f in spec.fields:
        if f.name not in types:
            continue
        column = F.col(f.name)
        cast = _try_cast(f, types[f.name])
        if not f.nullable or f.name in spec.primary_key:
            rules.append((f.name, "not_null", column.isNull()))
        if types[f.name] != f.dataType:
            rules.append((f.name, "type", column.isNotNull() & cast.isNull()))
        if "dim" in f.metadata:
            rules.append((f.name, "dim", F.size(column) != f.metadata["dim"]))
            rules.append((f.name, "element_null", F.exists(column, lambda x: x.isNull())))
        if "max_length" in f.metadata:
            rules.append((f.name, "max_length", F.length(cast) > f.metadata["max_length"]))
    return rules


def violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Broken rules as rows ``(field, rule, bad_rows)``.

    Row rules are counted in one pass with a single partial aggregate; only the
    key check shuffles, and it moves (key, count) pairs after a map-side combine.
    """
    rules = _row_rules(df, spec)
    counts = [F.count_if(bad).alias(f"r{i}") for i, (_, _, bad) in enumerate(rules)]
    entries = F.array(
        *[
            F.struct(F.lit(name).alias("field"), F.lit(rule).alias("rule"), F.col(f"r{i}").alias("bad_rows"))
            for i, (name, rule, _) in enumerate(rules)
        ]
    )
    result = df.agg(*counts).select(F.inline(entries)) if rules else None
    if spec.primary_key:
        duplicated = (
            df.groupBy(*spec.primary_key)
            .agg(F.count("*").alias("n"))
            .where("n > 1")
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("bad_rows"))
            .select(F.lit(",".join(spec.primary_key)).alias("field"), F.lit("unique").alias("rule"), "bad_rows")
        )
        result = duplicated if result is None else result.unionByName(duplicated)
    if result is None:
        raise ValueError("the schema has no rules to check")
    return result.where("bad_rows > 0")


def require_valid(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Conform ``df`` or raise with the list of broken rules (at most one row per rule)."""
    broken = violations(df, spec).collect()
    if broken:
        text = ", ".join(f"{r['field']}: {r['rule']} ({r['bad_rows']} rows)" for r in broken)
        raise ValueError(f"rows break the schema: {text}")
    return conform(df, spec)
