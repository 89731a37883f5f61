"""Index pages -> what to download."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ementario.functions.urls import file_name, last_segment, resolve_link
from ementario.sources.manifest import pending


def resolve_links(links: DataFrame) -> DataFrame:
    """``page_id, pos, page_url, url`` with absolute URLs; links without a target are skipped."""
    return links.filter(F.col("href") != "").select(
        "page_id", "pos", "page_url", resolve_link(F.col("page_url"), F.col("href")).alias("url")
    )


def url_parts(resolved: DataFrame) -> DataFrame:
    """Target folder (from the page) and file name (from the link)."""
    return resolved.select(
        "page_id",
        "pos",
        "url",
        last_segment(F.col("page_url")).alias("folder"),
        file_name(F.col("url")).alias("name"),
    )


def download_plan(parts: DataFrame, control: DataFrame) -> DataFrame:
    """First link per (folder, name) not yet in the control list.

    ``min_by`` combines on the map side, so a name repeated on millions of pages does not
    gather in one task.
    """
    first = parts.groupBy("folder", "name").agg(
        F.min_by(F.struct("page_id", "url"), F.struct("page_id", "pos")).alias("f")
    )
    plan = first.select("folder", "name", "f.page_id", "f.url")
    return pending(plan, control, ["folder", "name"])
