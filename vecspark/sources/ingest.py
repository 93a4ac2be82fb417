"""Parsing vectors, sparse vectors and nested arrays from text columns, and back."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from vecspark.sources.schema import data_type


def _raise_unless(ok: Column, value: Column, message: str) -> Column:
    dtype_error = F.raise_error(F.lit(message))
    return F.when(F.coalesce(ok, F.lit(False)), value).otherwise(dtype_error)


def vector_from_text(text: Column | str, dim: int | None = None, strict: bool = True) -> Column:
    """``[1,2,3]`` (text or binary) as ``array<float>``.

    A text that is not a flat list of numbers, or has another dimension, is an
    error; with ``strict=False`` it gives null.
    """
    text = (F.col(text) if isinstance(text, str) else text).cast("string")
    parsed = F.from_json(text, "array<double>")
    ok = parsed.isNotNull() & ~F.exists(parsed, lambda x: x.isNull())
    if dim is not None:
        ok = ok & (F.size(parsed) == dim)
    value = parsed.cast("array<float>")
    if not strict:
        return F.when(ok, value)
    return F.when(text.isNotNull(), _raise_unless(ok, value, "not a vector of the declared dimension"))


def vector_to_text(vector: Column | str) -> Column:
    vector = F.col(vector) if isinstance(vector, str) else vector
    body = F.array_join(F.transform(vector, lambda x: x.cast("string")), ",")
    return F.concat(F.lit("["), body, F.lit("]"))


_SPARSE_TEXT = (
    r"^\s*\{\s*(?:\d+\s*:\s*[-+]?[0-9.]+(?:[eE][-+]?\d+)?\s*"
    r"(?:,\s*\d+\s*:\s*[-+]?[0-9.]+(?:[eE][-+]?\d+)?\s*)*)?\}\s*$"
)


def sparse_from_text(text: Column | str, strict: bool = True) -> Column:
    """``{1:1.1, 2:2.2}`` as ``map<int,float>``."""
    text = F.col(text) if isinstance(text, str) else text
    body = F.regexp_replace(text, r"[{}\s]", "")
    pairs = F.filter(F.split(body, ","), lambda p: p != "")
    entries = F.transform(
        pairs,
        lambda p: F.struct(
            F.split_part(p, F.lit(":"), F.lit(1)).try_cast("int").alias("key"),
            F.split_part(p, F.lit(":"), F.lit(2)).try_cast("float").alias("value"),
        ),
    )
    ok = text.rlike(_SPARSE_TEXT)
    value = F.when(ok, F.map_from_entries(entries))
    if not strict:
        return value
    return F.when(text.isNotNull(), _raise_unless(ok, value, "not a sparse vector"))


def sparse_to_text(sparse: Column | str) -> Column:
    """Entries in key order: ``{1:1.1,2:2.2}``."""
    sparse = F.col(sparse) if isinstance(sparse, str) else sparse
    entries = F.array_sort(F.map_entries(sparse))
    parts = F.transform(entries, lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"].cast("string")))
    return F.when(sparse.isNotNull(), F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}")))


def sparse_from_dense(vector: Column | str, threshold: float) -> Column:
    """Keep the positions whose absolute value exceeds ``threshold``."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    entries = F.transform(vector, lambda x, i: F.struct(i.cast("int").alias("key"), x.alias("value")))
    return F.map_from_entries(
        F.filter(entries, lambda e: F.abs(e["value"].cast("double")) > F.lit(float(threshold)))
    )


def array_from_text(
    text: Column | str, element: T.DataType | str, depth: int = 1, strict: bool = True
) -> Column:
    """A JSON list as a nested array of the declared depth.

    A value of another depth or element type is an error, or null unless strict.
    """
    text = F.col(text) if isinstance(text, str) else text
    dtype = data_type(element)
    for _ in range(depth):
        dtype = T.ArrayType(dtype, True)
    parsed = F.from_json(text, dtype)
    if not strict:
        return parsed
    return F.when(text.isNotNull(), _raise_unless(parsed.isNotNull(), parsed, "not an array of the declared depth"))
