"""Value rules of typed JSON columns as Spark Columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: 2^27 + 1, which splits a double into two halves of 26 bits.
_SPLITTER = 134217729.0


def truncate_decimal(value: Column, scale: int) -> Column:
    """Truncate a double's exact binary value to ``scale`` digits, as a double.

    57.9 stays 57.9 only if its binary value is not below 57.9; 12.3 + 45.6 is, and
    gives 57.89. The product with 10^scale is corrected by its rounding error, taken
    from an error-free product, before the floor.
    """
    m = F.lit(float(10**scale))
    a = F.abs(value.cast("double"))
    p = a * m
    c = F.lit(_SPLITTER) * a
    hi = c - (c - a)
    lo = a - hi
    err = (hi * m - p) + lo * m
    whole = F.floor(p).cast("double")
    whole = whole - F.when((whole == p) & (err < 0), 1.0).otherwise(0.0)
    return F.when(value.cast("double") < 0, -whole / m).otherwise(whole / m)


def decimal_value(value: Column, precision: int, scale: int) -> Column:
    """A number as ``decimal(precision, scale)``: extra digits cut, overflow raised."""
    number = value.cast("double")
    target = f"decimal({precision},{scale})"
    cut = truncate_decimal(number, scale).try_cast(target)
    digits = F.length(F.format_string("%.0f", F.floor(F.abs(number)).cast("double")))
    # A leading zero counts as a digit, so 0.5 does not fit decimal(1, 1).
    shown = F.least(decimal_digits(number), F.lit(scale))
    misfit = (digits + shown > precision) | (cut.isNull() & number.isNotNull())
    return F.when(misfit, _raise(number, target)).otherwise(cut)


def decimal_digits(number: Column) -> Column:
    """Digits after the point of a double's exact value, at most 40 of them counted.

    Whole numbers have none; otherwise the exact binary expansion of a decimal
    fraction is long unless the value is a short multiple of a power of two, which
    the shortest text form then shows in full.
    """
    short = F.length(F.regexp_extract(number.cast("string"), r"\.(\d*[1-9])0*(?:E|$)", 1))
    dyadic = (number * F.lit(float(2**20))) == F.floor(number * F.lit(float(2**20))).cast("double")
    return F.when(number == F.floor(number).cast("double"), 0).when(dyadic, short).otherwise(40)


def varchar_value(value: Column, length: int) -> Column:
    text = value.cast("string")
    return F.when(F.length(text) > length, _raise(text, f"varchar({length})")).otherwise(text)


def int_value(value: Column) -> Column:
    """A whole number as bigint; a fraction is an error."""
    number = value.cast("double")
    fraction = number != F.floor(number).cast("double")
    return F.when(fraction, _raise(number, "int")).otherwise(value.cast("bigint"))


def _raise(value: Column, type_text: str) -> Column:
    return F.raise_error(F.concat(F.lit("value "), value.cast("string"), F.lit(f" does not fit {type_text}")))
