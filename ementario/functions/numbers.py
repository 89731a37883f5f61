"""Lenient and strict readings of numbers held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ementario.functions.text import strip

# --- fixed values: number syntax and the date-time shapes the profiler knows --------
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
NUMBER = rf"\A[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\z"
INTEGER = rf"\A[+-]?{_DIGITS}\z"
PROFILE_DATES = {
    r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z": "yyyy-M-d",
    r"\A[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z": "d/M/yyyy",
}
PROFILE_TIMESTAMP = (
    r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} +[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}\z"
)
# --- end of fixed values -----------------------------------------------------------


def number_or_null(c: Column) -> Column:
    """Text as a double, null unless it is a plain number (no ``nan``, ``inf``, ``1d``)."""
    t = strip(c)
    value = F.replace(t, F.lit("_"), F.lit("")).try_cast("double")
    return F.when(t.rlike(NUMBER), F.when(F.abs(value) < float("inf"), value))


def int_lenient(c: Column) -> Column:
    """Whole part of a number: ``12.7`` is 12, ``1e5`` is 100000; otherwise null."""
    return number_or_null(c).try_cast("bigint")


def int_strict(c: Column) -> Column:
    """Like :func:`int_lenient`, but text with a ``.`` is never an integer."""
    return F.when(~F.contains(c, F.lit(".")), int_lenient(c))


def int_id(primary: Column, fallback: Column) -> Column:
    """A 64-bit id: the first column's where that holds an integer, else the second's.

    An integer that does not fit 64 bits gives null, not the fallback: the row has another id than that.
    """

    def as_int(c: Column) -> Column:
        return F.replace(strip(c), F.lit("_"), F.lit("")).try_cast("bigint")

    return F.when(F.coalesce(strip(primary).rlike(INTEGER), F.lit(False)), as_int(primary)).when(
        strip(fallback).rlike(INTEGER), as_int(fallback)
    )


def is_date_text(c: Column) -> Column:
    """Whether stripped text reads as a date or a date-time in one of the known shapes."""
    t = strip(c)
    plain = [
        F.when(t.rlike(shape), F.try_to_date(t, fmt)).isNotNull()
        for shape, fmt in PROFILE_DATES.items()
    ]
    stamp = F.when(
        t.rlike(PROFILE_TIMESTAMP),
        F.try_to_timestamp(F.regexp_replace(t, " +", " "), F.lit("yyyy-M-d H:m:s")),
    ).isNotNull()
    return plain[0] | plain[1] | stamp


# Kind codes are small integers so that min/max_by on them keep to hash aggregation.
KIND_INT, KIND_FLOAT, KIND_DATE, KIND_STRING, KIND_BOOL = 1, 2, 3, 4, 5
KIND_NAMES = {
    KIND_INT: "int",
    KIND_FLOAT: "float",
    KIND_DATE: "date",
    KIND_STRING: "string",
    KIND_BOOL: "boolean",
}


def kind_code(c: Column) -> Column:
    """Kind of one text value: integer, float, date or string, tried in that order.

    All but strings start with a sign, a point or a digit, so one byte settles most text.
    """
    readable = F.left(strip(c), F.lit(1)).between("+", "9")
    number = (
        F.when(number_or_null(c).isNotNull(), F.when(F.contains(c, F.lit(".")), KIND_FLOAT).otherwise(KIND_INT))
        .when(is_date_text(c), KIND_DATE)
        .otherwise(KIND_STRING)
    )
    return F.when(readable, number).when(c.isNotNull(), KIND_STRING)


def kind_name(code: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in KIND_NAMES.items() for x in pair])
    return F.try_element_at(names, code)


def value_kind(c: Column) -> Column:
    return kind_name(kind_code(c))


def decimal_places(value: Column) -> Column:
    """Digits after the point in the shortest plain form of a double (``12.0`` has 1)."""
    text = value.cast("string")
    mantissa = F.regexp_extract(text, r"\.([0-9]+)", 1)
    exponent = F.regexp_extract(text, r"E(-?[0-9]+)\z", 1).try_cast("int")
    digits = F.when(mantissa == "0", 0).otherwise(F.char_length(mantissa))
    # Only very large and very small values are written with an exponent.
    return F.when(
        F.contains(text, F.lit("E")), F.greatest(digits - exponent, F.lit(1))
    ).otherwise(F.char_length(F.substring_index(text, ".", -1)))
