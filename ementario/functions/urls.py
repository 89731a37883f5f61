"""Links and file names of crawled index pages.

URLs are taken apart with the RFC 3986 component pattern, which accepts any text;
``parse_url`` fails on characters that real pages contain.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: URL syntax ------------------------------------------------------
URL = r"(?s)\A(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?\z"
FALLBACK_NAME = "downloaded_file"
# --- end of fixed values -----------------------------------------------------------

_SCHEME, _AUTHORITY, _PATH, _QUERY = 1, 2, 3, 4


def _piece(url: Column, group: int) -> Column:
    return F.regexp_extract(url, URL, group)


def last_segment(url: Column) -> Column:
    """Everything after the last ``/``: the folder a page's files go to."""
    return F.substring_index(url, "/", -1)


def _without_dots(path: Column) -> Column:
    """Path with ``.`` and ``..`` segments resolved."""
    parts = F.split(path, "/", -1)
    last = F.element_at(parts, -1)
    kept = F.aggregate(
        F.when(last.isin(".", ".."), F.concat(parts, F.array(F.lit("")))).otherwise(parts),
        F.array().cast("array<string>"),
        lambda acc, seg: F.when(seg == ".", acc)
        .when(seg == "..", F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.concat(acc, F.array(seg))),
    )
    return F.when(F.contains(path, F.lit("/.")) , F.array_join(kept, "/")).otherwise(path)


def resolve_link(base: Column, href: Column) -> Column:
    """Absolute URL of ``href`` as found on the page ``base``."""
    scheme, authority = _piece(base, _SCHEME), _piece(base, _AUTHORITY)
    base_path = _piece(base, _PATH)
    origin = F.concat(scheme, F.lit("://"), authority)
    folder = F.when(base_path == "", F.lit("/")).otherwise(F.regexp_replace(base_path, r"[^/]*\z", ""))
    href_path = _piece(href, _PATH)
    tail = F.substring(href, F.char_length(href_path) + 1, F.char_length(href))
    without_fragment = F.substring_index(base, "#", 1)
    return (
        F.when(href == "", base)
        .when(_piece(href, _SCHEME) != "", href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
        .when(F.startswith(href, F.lit("#")), F.concat(without_fragment, href))
        .when(F.startswith(href, F.lit("?")), F.concat(origin, base_path, href))
        .when(F.startswith(href, F.lit("/")), F.concat(origin, _without_dots(href_path), tail))
        .otherwise(F.concat(origin, _without_dots(F.concat(folder, href_path)), tail))
    )


def file_name(url: Column) -> Column:
    """Last path segment, reduced to letters, digits and ``. _ -``."""
    path = F.regexp_replace(_piece(url, _PATH), r";[^/]*\z", "")
    base = F.substring_index(path, "/", -1)
    return F.regexp_replace(
        F.when(base == "", F.lit(FALLBACK_NAME)).otherwise(base), r"[^\p{L}\p{N}._\-]", ""
    )


def relative_path(file_uri: Column, base: str) -> Column:
    """Decoded path below ``base`` of a ``_metadata.file_path`` URI."""
    bare = r"\A[A-Za-z][A-Za-z0-9+.\-]*:/+"
    plus_kept = F.replace(file_uri, F.lit("+"), F.lit("%2B"))
    full = F.regexp_replace(F.coalesce(F.try_url_decode(plus_kept), file_uri), bare, "/")
    root = F.regexp_replace(F.lit(base.rstrip("/") + "/"), bare, "/")
    return F.when(
        F.startswith(full, root), F.substring(full, F.char_length(root) + 1, F.char_length(full))
    ).otherwise(full)
