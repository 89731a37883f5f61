"""Dates in the mixed formats found in publication and judgment fields.

Each format is guarded by its shape, so ``try_to_date`` rarely meets text it cannot
parse: a failed parse costs a Java exception per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ementario.functions.text import WS_CLASS, strip
from ementario.schemas import DATE_FIELDS

# --- fixed values: shape -> pattern -------------------------------------------------
TOKEN_FORMATS = {
    r"\A[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z": "d/M/yyyy",
    r"\A[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}\z": "d-M-yyyy",
    r"\A[0-9]{8}\z": "yyyyMMdd",
    r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z": "yyyy-M-d",
    r"\A[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}\z": "yyyy/M/d",
}
# --- end of fixed values -----------------------------------------------------------


def _parsed(c: Column, shape: str, pattern: str) -> Column:
    """The date, null in the year 0000: the shape refuses it, so that the text is parsed once."""
    year = next(digits for digits in ("[0-9]{8}", "[0-9]{4}") if digits in shape)
    return F.when(c.rlike(shape.replace(year, f"(?!0000){year}")), F.try_to_date(c, pattern))


def date_token(c: Column) -> Column:
    """The first whitespace-delimited token after ``DATA:`` (any case), else the text."""
    bare = strip(c)
    token = F.regexp_extract(bare, rf"(?is)DATA:[{WS_CLASS}]*([^{WS_CLASS}]*?)(?=[{WS_CLASS}]|DATA:|\z)", 1)
    return F.when(bare.rlike("(?i)DATA:"), token).otherwise(bare)


def date_multi_format(c: Column) -> Column:
    """ISO date text where one of the formats fits, else the stripped input."""
    token = date_token(c)
    parsed = F.coalesce(*[_parsed(token, shape, fmt) for shape, fmt in TOKEN_FORMATS.items()])
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), strip(c))


def apply_date_fields(df: DataFrame, fields: tuple[str, ...] = DATE_FIELDS) -> DataFrame:
    """:func:`date_multi_format` on the date columns, matched in any case."""
    hit = [c for c in df.columns if c.lower() in fields]
    return df.withColumns({c: date_multi_format(F.col(c)) for c in hit}) if hit else df


def date_typed(c: Column) -> Column:
    """A date: 8 digits, else the first ``DATA:dd/mm/yyyy``, else an ISO date, else null."""
    after_label = F.regexp_extract(c, r"DATA:([0-9]{2}/[0-9]{2}/[0-9]{4})", 1)
    return F.coalesce(
        _parsed(c, r"\A[0-9]{8}\z", "yyyyMMdd"),
        _parsed(after_label, r"\A[0-9]{2}/[0-9]{2}/[0-9]{4}\z", "dd/MM/yyyy"),
        _parsed(c, r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z", "yyyy-M-d"),
    )
