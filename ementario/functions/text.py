"""Whitespace, truncation and templating on string columns.

Unicode whitespace is spelt out as a character class instead of using ``(?U)\\s``: it
also holds U+001C..U+001F, and it is cheaper than Java's Unicode mode. Text without any
of the rare spaces above U+00FF, which a byte search rules out quickly, uses a Latin-1
class that Java matches by table; on long texts that halves the time.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ementario.schemas import DEFAULT_LOAD_LIMIT, LOAD_LIMITS, LONG_FIELDS, STAGING_WIDTHS

# --- fixed values: Unicode whitespace, as regex class bodies and as characters ------
# One by one and not as ranges: Java looks single Latin-1 characters up in a table, but tests range after range.
WS_LATIN1 = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20\x85\xa0"
WS_CLASS = r"\t-\r\x1c-\x20\x85\xa0" + r"\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WS_CHARS = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
         0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)
# The UTF-8 bytes that every space above U+00FF starts with.
RARE_SPACE_BYTES = (b"\xe1\x9a", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80")
# --- end of fixed values -----------------------------------------------------------


def _may_hold_rare_space(c: Column) -> Column:
    raw = c.cast("binary")
    return reduce(Column.__or__, [F.contains(raw, F.lit(b)) for b in RARE_SPACE_BYTES])


def strip(c: Column) -> Column:
    """Trim all Unicode whitespace (``trim`` alone only knows U+0020)."""
    return F.btrim(c, F.lit(WS_CHARS))


def ws_normalize(c: Column) -> Column:
    """Runs of two or more whitespace characters, and any CR/LF/TAB, become one space.

    A lone other whitespace character (NBSP, form feed) inside the text stays.
    """
    return strip(
        F.when(
            _may_hold_rare_space(c), F.regexp_replace(c, rf"[{WS_CLASS}]{{2,}}|[\r\n\t]", " ")
        ).otherwise(F.regexp_replace(c, rf"[{WS_LATIN1}](?:[{WS_LATIN1}]+|(?<=[\r\n\t]))", " "))
    )


def ws_normalize_full(c: Column, long: bool = True) -> Column:
    """Every whitespace run becomes one space; null becomes the empty string.

    ``long=False`` leaves out the search for rare spaces: on codes and names it costs more
    than it saves, and it keeps the generated code of wide projections small.
    """
    spaced = F.regexp_replace(c, rf"[{WS_CLASS}]+", " ")
    if long:
        spaced = F.when(_may_hold_rare_space(c), spaced).otherwise(
            # A lone space is no match: it stays as it is.
            F.regexp_replace(c, rf"[{WS_LATIN1}](?:[{WS_LATIN1}]+|(?<! ))", " ")
        )
    return F.coalesce(F.trim(spaced), F.lit(""))


def ws_normalize_joined(arr: Column) -> Column:
    """:func:`ws_normalize_full` of an array's items joined by a space, nulls skipped."""
    return ws_normalize_full(F.array_join(arr, " "))


def clean_array(arr: Column) -> Column:
    """Clean every item; a null array is empty, a null item is the empty string."""
    return F.coalesce(
        F.transform(arr, lambda x: F.coalesce(ws_normalize(x), F.lit(""))),
        F.array().cast("array<string>"),
    )


def clean_array_if_text(arr: Column) -> Column:
    """Clean every item, but leave the array alone when any item is not a string."""
    return F.when(F.exists(arr, lambda x: x.isNull()), arr).otherwise(
        F.transform(arr, ws_normalize)
    )


def clean_json_array(c: Column) -> Column:
    """:func:`clean_array_if_text` of an array held as JSON text; other text is cleaned whole."""
    items = F.from_json(c, "array<variant>")
    all_text = F.forall(items, lambda v: F.schema_of_variant(v) == "STRING")
    cleaned = F.to_json(F.transform(F.from_json(c, "array<string>"), ws_normalize))
    return (
        F.when(~F.startswith(c, F.lit("[")), ws_normalize(c))
        .when(items.isNull(), ws_normalize(c))
        .when(all_text, cleaned)
        .otherwise(c)
    )


def load_limits(columns: list[str], widths: str = "schema") -> dict[str, int]:
    """Truncation limit per column outside the long fields.

    ``widths="schema"`` uses the declared column widths, so a value always fits its
    column; ``"load"`` uses the looser limits 50/300/255.
    """
    limits = {}
    for name in columns:
        if name in LONG_FIELDS:
            continue
        loose = LOAD_LIMITS.get(name.lower(), DEFAULT_LOAD_LIMIT)
        limits[name] = STAGING_WIDTHS.get(name, loose) if widths == "schema" else loose
    return limits


def truncate_columns(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Cut each listed string column to its limit, counted in code points."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cut = {
        name: F.substring(F.col(name), 1, limit)
        for name, limit in limits.items()
        if isinstance(kinds.get(name), T.StringType)
    }
    return df.withColumns(cut) if cut else df


def split_terms(c: Column) -> Column:
    """``;``-separated terms: cleaned, trimmed, empties dropped. Null gives no terms."""
    parts = F.split(ws_normalize_full(c), ";", -1)
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def embed_text(ementa: Column, decisao: Column) -> Column:
    """The text handed to the embedding model."""
    return F.concat(
        F.lit("Ementa: "), F.coalesce(ementa, F.lit("")),
        F.lit("\n\nDecisão: "), F.coalesce(decisao, F.lit("")),
    )


def long_enough(text: Column, minimum: int = 50) -> Column:
    return F.char_length(strip(text)) >= minimum
