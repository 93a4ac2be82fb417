"""Assigning rows to named range, list, hash and key partitions.

A layout has one or two levels and adds the columns ``_p0`` and ``_p1``, which a
write turns into directories, so a read of named partitions prunes the rest.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

LEVEL_COLUMNS = ("_p0", "_p1")


class _Marker:
    def __init__(self, name: str):
        self.name = name

    def __repr__(self) -> str:
        return self.name


MAXVALUE = _Marker("MAXVALUE")
DEFAULT = _Marker("DEFAULT")


def _as_tuple(value) -> tuple:
    return tuple(value) if isinstance(value, (list, tuple)) else (value,)




def _unplaced(kind: str) -> Column:
    return F.raise_error(F.lit(f"a row fits no {kind} partition"))


@dataclass(frozen=True)
class RangePartition:
    """Ascending exclusive upper bounds over an expression or a tuple of columns.

    ``key`` is a SQL expression, or a list of column names for the columns form.
    A null key sorts below every bound.
    """

    key: str | Sequence[str]
    bounds: Sequence[tuple[str, object]]

    def _keys(self) -> list[Column]:
        return [F.expr(k) for k in ([self.key] if isinstance(self.key, str) else self.key)]

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.bounds]

    def column(self) -> Column:
        keys, result = self._keys(), None
        for name, bound in self.bounds:
            values = _as_tuple(bound)
            if len(values) != len(keys):
                raise ValueError("a bound needs one value per key column")
            below = F.coalesce(_below(keys, values), F.lit(True))
            result = F.when(below, name) if result is None else result.when(below, name)
        return result.otherwise(_unplaced("range"))

    def overlapping(self, low=None, high=None) -> list[str]:
        """Names of the partitions that may hold keys in ``[low, high]`` (one key)."""
        kept, lower = [], None
        for name, bound in self.bounds:
            upper = _as_tuple(bound)[0]
            starts_late = high is not None and lower is not None and lower > high
            ends_early = low is not None and upper is not MAXVALUE and upper <= low
            if not starts_late and not ends_early:
                kept.append(name)
            lower = None if upper is MAXVALUE else upper
        return kept


def _below(keys: list[Column], bound: tuple) -> Column:
    """Tuple comparison ``keys < bound``, column by column."""
    key, value = keys[0], bound[0]
    if value is MAXVALUE:
        return F.lit(True)
    less = key < F.lit(value)
    if len(keys) == 1:
        return less
    return less | ((key == F.lit(value)) & _below(keys[1:], bound[1:]))


@dataclass(frozen=True)
class ListPartition:
    """Value lists over an expression or a tuple of columns, with an optional DEFAULT."""

    key: str | Sequence[str]
    items: Sequence[tuple[str, object]]

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.items]

    def column(self) -> Column:
        keys = [F.expr(k) for k in ([self.key] if isinstance(self.key, str) else self.key)]
        fallback, result = _unplaced("list"), None
        for name, values in self.items:
            if values is DEFAULT or values == [DEFAULT]:
                fallback = F.lit(name)
                continue
            hit = None
            for value in values if isinstance(values, (list, tuple)) else [values]:
                parts = _as_tuple(value)
                same = keys[0].eqNullSafe(F.lit(parts[0]))
                for key, part in zip(keys[1:], parts[1:]):
                    same = same & key.eqNullSafe(F.lit(part))
                hit = same if hit is None else hit | same
            result = F.when(hit, name) if result is None else result.when(hit, name)
        return fallback if result is None else result.otherwise(fallback)

    def holding(self, value) -> list[str]:
        """Names of the partitions that hold ``value``."""
        for name, values in self.items:
            if values is not DEFAULT and values != [DEFAULT] and value in values:
                return [name]
        return [n for n, v in self.items if v is DEFAULT or v == [DEFAULT]]


class _Numbered:
    """Partitions numbered by a modulus; a count wins over a list of names."""

    @property
    def names(self) -> list[str]:
        if self.count:
            return [f"p{i}" for i in range(self.count)]
        if not self.part_names:
            raise ValueError("give a partition count or names")
        return list(self.part_names)

    def _named(self, slot: Column) -> Column:
        if self.count or not self.part_names:
            return F.concat(F.lit("p"), slot.cast("string"))
        return F.element_at(F.lit(list(self.part_names)), slot.cast("int") + 1)


@dataclass(frozen=True)
class HashPartition(_Numbered):
    """Integer modulus of an expression; a null key counts as zero."""

    expr: str
    count: int | None = None
    part_names: Sequence[str] | None = None

    def column(self) -> Column:
        key = F.coalesce(F.expr(self.expr).cast("bigint"), F.lit(0))
        return self._named(F.pmod(key, F.lit(len(self.names))))

    def holding(self, value: int) -> list[str]:
        return [self.names[int(value) % len(self.names)]]


@dataclass(frozen=True)
class KeyPartition(_Numbered):
    """A 64-bit hash of one or more columns, modulo the number of partitions."""

    columns: Sequence[str]
    count: int | None = None
    part_names: Sequence[str] | None = None

    def column(self) -> Column:
        return self._named(F.pmod(F.xxhash64(*self.columns), F.lit(len(self.names))))


_KINDS = {
    "range": RangePartition, "list": ListPartition, "hash": HashPartition, "key": KeyPartition
}


@dataclass(frozen=True)
class Layout:
    """One partitioning, or a first level with a second applied inside each part."""

    first: object
    second: object | None = None

    def __post_init__(self):
        for level in (self.first, self.second):
            if isinstance(level, Layout):
                raise ValueError("partitions nest two levels at most")

    @property
    def columns(self) -> list[str]:
        return list(LEVEL_COLUMNS[: 1 if self.second is None else 2])

    def assign(self, df: DataFrame) -> DataFrame:
        parts = {"_p0": self.first.column()}
        if self.second is not None:
            parts["_p1"] = self.second.column()
        return df.withColumns(parts)

    def to_dict(self) -> dict:
        def dump(level):
            if level is None:
                return None
            kind = next(k for k, c in _KINDS.items() if isinstance(level, c))
            return {"kind": kind, **{k: _plain(v) for k, v in vars(level).items()}}

        return {"first": dump(self.first), "second": dump(self.second)}

    @classmethod
    def from_dict(cls, d: dict) -> Layout:
        def load(level):
            if level is None:
                return None
            level = dict(level)
            return _KINDS[level.pop("kind")](**{k: _unplain(v) for k, v in level.items()})

        return cls(load(d["first"]), load(d["second"]))


def _plain(value):
    if isinstance(value, _Marker):
        return {"$": value.name}
    if isinstance(value, datetime):
        return {"$": "datetime", "v": value.isoformat()}
    if isinstance(value, date):
        return {"$": "date", "v": value.isoformat()}
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return value


def _unplain(value):
    if isinstance(value, dict):
        if value["$"] == "datetime":
            return datetime.fromisoformat(value["v"])
        if value["$"] == "date":
            return date.fromisoformat(value["v"])
        return {"MAXVALUE": MAXVALUE, "DEFAULT": DEFAULT}[value["$"]]
    if isinstance(value, list):
        return [_unplain(v) for v in value]
    return value


def in_partitions(df: DataFrame, names: Sequence[str] | None) -> DataFrame:
    """Rows of the named partitions of either level; on a written table this prunes."""
    if not names:
        return df
    wanted = list(names)
    test = F.col("_p0").isin(wanted)
    if "_p1" in df.columns:
        test = test | F.concat(F.col("_p0"), F.lit("s"), F.col("_p1")).isin(wanted)
    return df.where(test)
