"""Point reads, filtered reads and projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from vecspark.operators.partition import in_partitions

# Longer id lists become a semi-join instead of an IN list; both cast the ids to the key's type.
MAX_IN_LIST = 1000

Predicate = Column | str


def as_predicates(where: Predicate | Sequence[Predicate] | None) -> list[Column]:
    """A predicate or a list of them; text is SQL."""
    if where is None:
        return []
    items = where if isinstance(where, (list, tuple)) else [where]
    return [F.expr(p) if isinstance(p, str) else p for p in items]


def conjunction(where: Predicate | Sequence[Predicate] | None) -> Column | None:
    """All predicates joined with AND; None where there are none."""
    result = None
    for p in as_predicates(where):
        result = p if result is None else result & p
    return result


def filtered(df: DataFrame, where: Predicate | Sequence[Predicate] | None) -> DataFrame:
    condition = conjunction(where)
    return df if condition is None else df.where(condition)


def output_columns(
    df: DataFrame,
    names: Sequence[str] | None = None,
    columns: Sequence[Column | str] | None = None,
    extra: Sequence[Column | str] | None = None,
) -> list[Column]:
    """The projection: expressions win over names, nothing means every column."""
    if columns:
        chosen = [F.expr(c) if isinstance(c, str) else c for c in columns]
    else:
        chosen = [F.col(n) for n in (names or [c for c in df.columns if c not in ("_p0", "_p1")])]
    return chosen + [F.expr(c) if isinstance(c, str) else c for c in (extra or [])]


def with_ids(df: DataFrame, ids, primary_key: str | Sequence[str], keep: bool = True) -> DataFrame:
    """Rows whose key is (or, with ``keep=False``, is not) among ``ids``.

    ``ids`` is a key, a list of keys, or a DataFrame with the key column. Spark
    decides from its measured size whether to broadcast a DataFrame of ids.
    """
    key = [primary_key] if isinstance(primary_key, str) else list(primary_key)
    if len(key) != 1:
        raise ValueError("ids need a table with a single key column; use a predicate")
    key = key[0]
    kind = df.schema[key].dataType
    if not isinstance(ids, DataFrame):
        values = list(ids) if isinstance(ids, (list, tuple, set)) else [ids]
        if len(values) <= MAX_IN_LIST:
            test = F.col(f"`{key}`").isin([F.lit(v).cast(kind) for v in values])
            return df.where(test if keep else ~F.coalesce(test, F.lit(False)))
        ids = None
        for python_type in {type(v) for v in values}:
            rows = [(v,) for v in values if type(v) is python_type and v is not None]
            if rows:
                part = df.sparkSession.createDataFrame(rows, ["v"]).select(F.col("v").cast(kind).alias(key))
                ids = part if ids is None else ids.unionByName(part)
    return df.join(ids.select(F.col(f"`{key}`").cast(kind).alias(key)), key, "left_semi" if keep else "left_anti")


def get_rows(
    df: DataFrame,
    ids=None,
    where=None,
    names: Sequence[str] | None = None,
    primary_key: str | Sequence[str] = "id",
    partitions: Sequence[str] | None = None,
    limit: int | None = None,
    columns: Sequence[Column | str] | None = None,
    extra: Sequence[Column | str] | None = None,
    order_by: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Rows by key and/or predicate, projected; ``order_by`` makes a limit repeatable."""
    df = in_partitions(df, partitions)
    if ids is not None:
        df = with_ids(df, ids, primary_key)
    df = filtered(df, where)
    if order_by:
        df = df.orderBy(*order_by)
    if limit is not None:
        df = df.limit(limit)
    return df.select(output_columns(df, names, columns, extra))


def query_rows(df: DataFrame, where=None, names=None, partitions=None, columns=None, extra=None) -> DataFrame:
    return get_rows(df, where=where, names=names, partitions=partitions, columns=columns, extra=extra)


def json_number(document: Column | str, path: str) -> Column:
    """A number inside a JSON text; null where it is absent or not a number."""
    return F.get_json_object(document, path).try_cast("double")
