"""The library's functions for SQL text, as temporary SQL functions of a session.

Spark inlines their bodies, so a query that calls them plans like one written with
the built-in functions they consist of.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from vecspark.functions import geo

_DOT = "aggregate(zip_with({a}, {b}, (x, y) -> x * y), 0D, (s, x) -> s + x)"
_SAME = "CASE WHEN size(a) <> size(b) THEN CAST(raise_error('vectors have different dimensions') AS DOUBLE) ELSE {value} END"

_VECTOR_ARGS = "a ARRAY<DOUBLE>, b ARRAY<DOUBLE>"
_POINT = "STRUCT<x: DOUBLE, y: DOUBLE>"
_WKT = "r'" + geo.WKT_POINT + "'"


def _let(values: dict[str, str], body: str) -> str:
    """SQL of ``body`` over named values (``v.name``) that are computed once."""
    row = ", ".join(f"'{name}', {value}" for name, value in values.items())
    return f"get(transform(array(named_struct({row})), v -> {body}), 0)"


#: Metres between two points (latitude, longitude), by the formula of ``functions.geo.distance``.
_DISTANCE = _let(
    {"m": "radians((a.x + b.x) / 2D)", "g": "radians((a.x - b.x) / 2D)", "l": "radians((a.y - b.y) / 2D)"},
    _let(
        {
            "s": "pow(sin(v.g), 2) * pow(cos(v.l), 2) + pow(cos(v.m), 2) * pow(sin(v.l), 2)",
            "c": "pow(cos(v.g), 2) * pow(cos(v.l), 2) + pow(sin(v.m), 2) * pow(sin(v.l), 2)",
            "north": "pow(sin(v.m), 2) * pow(cos(v.g), 2)", "south": "pow(cos(v.m), 2) * pow(sin(v.g), 2)",
        },
        _let(
            {
                "s": "v.s", "c": "v.c", "north": "v.north", "south": "v.south",
                "w": "atan2(sqrt(v.s), sqrt(v.c))", "r": "3D * sqrt(v.s * v.c)",
            },
            f"CASE WHEN v.s = 0D THEN 0D WHEN v.c = 0D THEN {2 * geo.EQUATORIAL_RADIUS!r}D * v.w "
            f"WHEN v.s IS NOT NULL THEN {2 * geo.EQUATORIAL_RADIUS!r}D * v.w * (1D + {geo.FLATTENING!r}D * "
            "((v.r / v.w - 1D) / (2D * v.c) * v.north - (v.r / v.w + 1D) / (2D * v.s) * v.south)) END",
        ),
    ),
)

_FUNCTIONS = {
    "l2_distance": (
        _VECTOR_ARGS, "DOUBLE",
        _SAME.format(value="sqrt(aggregate(zip_with(a, b, (x, y) -> (x - y) * (x - y)), 0D, (s, x) -> s + x))"),
    ),
    "inner_product": (_VECTOR_ARGS, "DOUBLE", _SAME.format(value=_DOT.format(a="a", b="b"))),
    "negative_inner_product": (_VECTOR_ARGS, "DOUBLE", _SAME.format(value="0D - " + _DOT.format(a="a", b="b"))),
    "cosine_distance": (
        _VECTOR_ARGS, "DOUBLE",
        _SAME.format(
            value="1D - {ab} / nullif(sqrt({aa} * {bb}), 0D)".format(
                ab=_DOT.format(a="a", b="b"), aa=_DOT.format(a="a", b="a"), bb=_DOT.format(a="b", b="b")
            )
        ),
    ),
    "sparse_inner_product": (
        "a MAP<INT, FLOAT>, b MAP<INT, FLOAT>", "DOUBLE",
        "CAST(CAST(aggregate(map_entries(a), 0D, (s, e) -> s + CAST(e.value AS DOUBLE) * "
        "coalesce(CAST(try_element_at(b, e.key) AS DOUBLE), 0D)) AS FLOAT) AS DOUBLE)",
    ),
    "st_point": ("x DOUBLE, y DOUBLE", _POINT, "named_struct('x', x, 'y', y)"),
    "st_astext": (f"p {_POINT}", "STRING", "concat('POINT(', p.x, ' ', p.y, ')')"),
    "st_geomfromtext": (
        "wkt STRING", _POINT,
        f"CASE WHEN wkt RLIKE {_WKT} THEN named_struct('x', try_cast(regexp_extract(wkt, {_WKT}, 1) AS DOUBLE), "
        f"'y', try_cast(regexp_extract(wkt, {_WKT}, 2) AS DOUBLE)) END",
    ),
    "st_distance": (f"a {_POINT}, b {_POINT}", "DOUBLE", _DISTANCE),
    "st_dwithin": (f"a {_POINT}, b {_POINT}, metres DOUBLE", "BOOLEAN", f"{_DISTANCE} <= metres"),
    "json_extract": ("document STRING, path STRING", "STRING", "get_json_object(document, path)"),
    "match_words": (
        "content STRING, query STRING", "BOOLEAN",
        r"arrays_overlap(regexp_extract_all(lower(content), '([\\p{L}\\p{N}]+)', 1), "
        r"regexp_extract_all(lower(query), '([\\p{L}\\p{N}]+)', 1))",
    ),
}


def register(spark: SparkSession) -> list[str]:
    """Define the functions in the session and return their names."""
    for name, (args, returns, body) in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {returns} RETURN {body}")
    return list(_FUNCTIONS)
