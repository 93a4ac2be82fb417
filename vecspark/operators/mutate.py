"""Insert, upsert, update and delete as functions from DataFrame to DataFrame.

None of them writes: the result is the new content of the table, for
:class:`vecspark.sources.tables.VersionedTable` to store.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from vecspark.operators.read import conjunction, with_ids


def _key_list(primary_key: str | Sequence[str]) -> list[str]:
    return [primary_key] if isinstance(primary_key, str) else list(primary_key)


def duplicate_keys(base: DataFrame, new: DataFrame, primary_key) -> DataFrame:
    """Keys of ``new`` that ``base`` already has or that ``new`` repeats."""
    key = _key_list(primary_key)
    counted = new.groupBy(*key).agg(F.count("*").alias("n"))
    repeated = counted.where("n > 1").select(*key)
    # The new keys are the side that may be broadcast; the base is only scanned.
    present = base.select(*key).join(counted.select(*key), key, "left_semi")
    return repeated.unionByName(present).distinct()


def insert(base: DataFrame, new: DataFrame, primary_key=None, check: bool = True) -> DataFrame:
    """``base`` and the new rows; a key that is already taken is an error.

    The check runs one job over the key columns only. Columns the new rows lack
    are null.
    """
    if primary_key and check:
        taken = duplicate_keys(base, new, primary_key).first()
        if taken is not None:
            raise ValueError(f"duplicate key {tuple(taken)}")
    return base.unionByName(new.select(*[c for c in base.columns if c in new.columns]), allowMissingColumns=True)


def last_per_key(new: DataFrame, primary_key, order_by: str | Column) -> DataFrame:
    """One row per key: the one latest in ``order_by``.

    An aggregate, so a key repeated very often is reduced before the shuffle.
    """
    key = _key_list(primary_key)
    rest = [c for c in new.columns if c not in key]
    order = F.col(order_by) if isinstance(order_by, str) else order_by
    latest = new.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return latest.select(*key, *[F.col("_row")[c].alias(c) for c in rest]).select(*new.columns)


def upsert(
    base: DataFrame,
    new: DataFrame,
    primary_key,
    order_by: str | Column | None = None,
    defaults: Mapping[str, Column | str] | None = None,
) -> DataFrame:
    """Replace whole rows by key: columns the new rows lack take their default or null.

    With ``order_by``, the last of several new rows with one key wins.
    """
    key = _key_list(primary_key)
    if order_by is not None:
        new = last_per_key(new, key, order_by)
    types = {f.name: f.dataType for f in base.schema.fields}
    columns = []
    for name in base.columns:
        if name in new.columns:
            column = F.col(name).cast(types[name])
        elif defaults and name in defaults:
            value = defaults[name]
            column = (F.expr(value) if isinstance(value, str) else value).cast(types[name])
        else:
            column = F.lit(None).cast(types[name])
        columns.append(column.alias(name))
    return base.join(new.select(*key), key, "left_anti").select(*base.columns).unionByName(new.select(columns))


def _in_scope(where, partition: str | None) -> Column:
    """True for the rows a statement touches; unknown counts as not touched."""
    condition = conjunction(where)
    scope = F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))
    return scope if partition is None else scope & (F.col("_p0") == F.lit(partition))


def update(
    base: DataFrame, values: Mapping[str, Column | str], where=None, partition: str | None = None
) -> DataFrame:
    """Set columns to constants or expressions over the old row; no predicate means all rows.

    A string value is SQL. All expressions see the row as it was.
    """
    scope = _in_scope(where, partition)
    types = {f.name: f.dataType for f in base.schema.fields}
    changed = {
        name: F.when(scope, (F.expr(v) if isinstance(v, str) else v).cast(types[name])).otherwise(F.col(name))
        for name, v in values.items()
    }
    return base.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in base.columns])


def delete(
    base: DataFrame, ids=None, where=None, primary_key="id", partition: str | None = None
) -> DataFrame:
    """Rows that stay after a delete by key and/or predicate; neither deletes all in scope."""
    if ids is None:
        return base.where(~_in_scope(where, partition))
    key = _key_list(primary_key)
    if len(key) != 1:
        raise ValueError("ids need a table with a single key column; use a predicate")
    if conjunction(where) is None and partition is None:
        return with_ids(base, ids, key, keep=False)
    if isinstance(ids, DataFrame):
        hit = ids.select(F.col(key[0]), F.lit(True).alias("_hit")).distinct()
        joined = base.join(hit, key[0], "left")
        gone = F.col("_hit").isNotNull() & _in_scope(where, partition)
        return joined.where(~gone).select(*base.columns)
    values = list(ids) if isinstance(ids, (list, tuple, set)) else [ids]
    gone = F.coalesce(F.col(key[0]).isin(values), F.lit(False)) & _in_scope(where, partition)
    return base.where(~gone)
