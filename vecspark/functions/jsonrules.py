"""Types and conversions of JSON-table columns."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from vecspark.functions import rules

# Sizes of types written without any.
DEFAULT_VARCHAR = 255
DEFAULT_DECIMAL = (10, 0)
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

_ALIASES = {
    "INT": "INT", "INTEGER": "INT", "BIGINT": "INT", "SMALLINT": "INT",
    "TINYINT": "TINYINT", "BOOL": "TINYINT", "BOOLEAN": "TINYINT",
    "VARCHAR": "VARCHAR", "DECIMAL": "DECIMAL",
    "TIMESTAMP": "TIMESTAMP", "TIMESTAMPTZ": "TIMESTAMP",
}


@dataclass(frozen=True)
class JsonType:
    """A declared type: INT, TINYINT (boolean), VARCHAR(n), DECIMAL(p,s) or TIMESTAMP."""

    name: str
    args: tuple[int, ...] = ()

    @classmethod
    def parse(cls, text: str) -> JsonType:
        m = re.fullmatch(r"\s*(\w+)\s*(?:\(\s*(\d+(?:\s*,\s*\d+)*)\s*\))?\s*", text)
        if not m or m[1].upper() not in _ALIASES:
            raise ValueError(f"unknown JSON column type {text!r}")
        args = tuple(int(a) for a in m[2].split(",")) if m[2] else ()
        name = _ALIASES[m[1].upper()]
        allowed = {"VARCHAR": (0, 1), "DECIMAL": (0, 1, 2)}.get(name, (0,))
        if len(args) not in allowed:
            raise ValueError(f"wrong number of parameters in {text!r}")
        return cls(name, args)

    def __str__(self) -> str:
        return self.name + (f"({','.join(map(str, self.args))})" if self.args else "")

    @property
    def size(self) -> tuple[int, ...]:
        if self.name == "VARCHAR":
            return self.args or (DEFAULT_VARCHAR,)
        if self.name == "DECIMAL":
            return (self.args + (0,))[:2] if self.args else DEFAULT_DECIMAL
        return ()

    @property
    def spark(self) -> str:
        if self.name == "DECIMAL":
            return "decimal({},{})".format(*self.size)
        return {"INT": "bigint", "TINYINT": "boolean", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz"}[self.name]


def checked_value(value: Column, dtype: JsonType) -> Column:
    """A new value as its column type; what does not fit is an error, never cut silently.

    Decimals are the exception: surplus digits are truncated.
    """
    if dtype.name == "INT":
        return rules.int_value(value)
    if dtype.name == "VARCHAR":
        return rules.varchar_value(value, dtype.size[0])
    if dtype.name == "DECIMAL":
        return rules.decimal_value(value, *dtype.size)
    if dtype.name == "TINYINT":
        truth = value.cast("string").isin("0", "1", "true", "false")
        wrong = F.raise_error(F.concat(F.lit("not a truth value: "), value.cast("string"))).cast("boolean")
        return F.when(value.isNull() | truth, value.cast("boolean")).otherwise(wrong)
    return value.cast(dtype.spark)


def converted_value(value: Column, old: JsonType, new: JsonType) -> Column:
    """A stored value under a new type: numbers round, text is cut, misfits become null."""
    if old.name == "TIMESTAMP" and new.name in ("INT", "DECIMAL", "TINYINT"):
        return F.lit(None).cast(new.spark)
    if new.name == "INT":
        if old.name == "TINYINT":
            return value.cast("bigint")
        return F.round(value.try_cast("decimal(38,10)"), 0).try_cast("bigint")
    if new.name == "VARCHAR":
        return F.substring(value.cast("string"), 1, new.size[0])
    if new.name == "DECIMAL":
        return (value.cast("int") if old.name == "TINYINT" else value).try_cast(new.spark)
    if new.name == "TINYINT":
        return value.try_cast("boolean") if old.name != "DECIMAL" else (value != 0)
    if old.name in ("INT", "DECIMAL", "TINYINT"):
        return F.lit(None).cast(new.spark)
    return value.try_cast(new.spark)


def json_value(document: Column | str, path: str, type_text: str) -> Column:
    """The scalar at ``path`` of a JSON text, cast to a column type; null where it misfits.

    Booleans and INT give integers, TIMESTAMP a timestamp, VARCHAR(n) at most n
    characters, DECIMAL(p,s) a rounded decimal.
    """
    dtype = JsonType.parse(type_text)
    text = F.get_json_object(document, path)
    if dtype.name == "TINYINT":
        number = F.round(text.try_cast("decimal(38,10)"), 0).try_cast("int")
        return F.when(F.lower(text) == "true", 1).when(F.lower(text) == "false", 0).otherwise(number)
    if dtype.name == "INT":
        number = F.round(text.try_cast("decimal(38,10)"), 0).try_cast("bigint")
        flag = F.when(F.lower(text) == "true", F.lit(1)).when(F.lower(text) == "false", F.lit(0))
        return F.coalesce(number, flag.cast("bigint"))
    return converted_value(text, JsonType("VARCHAR"), dtype)
