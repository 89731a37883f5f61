"""Links in crawled HTML pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.entities import name2codepoint
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: link syntax and the place of resource links on an index page -----
HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
COMMENT = r"(?s)<!--.*?(?:-->|\z)"
#: What is text to a browser, whatever it looks like.
RAW = r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)"
ENTITY = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
RESOURCE_ROOT_ID = "dataset-resources"
RESOURCE_PATH = ("ul", "li", "div", "ul", "li", "a")
RESOURCE_ITEM = 2
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# --- end of fixed values -----------------------------------------------------------


def unescape_entities(text: Column) -> Column:
    """Named and numeric character references resolved, once each; what is no reference stays as it is."""
    names = F.create_map(*(F.lit(x) for n, c in sorted(name2codepoint.items()) for x in (n, chr(c))))

    def char(code: Column) -> Column:  # the character of a number, from its four bytes
        fits = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        return F.when(fits, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    def resolved(name: Column) -> Column:
        number = F.when(F.lower(name.substr(2, 1)) == "x", F.conv(name.substr(3, 6), 16, 10)).otherwise(name.substr(2, 7))
        return F.when(name.startswith("#"), char(number.try_cast("int"))).otherwise(F.coalesce(F.try_element_at(names, name), F.when(name == "apos", "'")))

    # The ampersand last, so that nothing is resolved twice.
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(1)))
    pairs = F.transform(found, lambda n: F.struct((resolved(n) == "&").alias("last"), n.alias("name"), resolved(n).alias("char")))
    pairs = F.array_sort(F.filter(pairs, lambda p: p["char"].isNotNull()))
    one = F.aggregate(pairs, text, lambda acc, p: F.replace(acc, F.concat(F.lit("&"), p["name"], F.lit(";")), p["char"]))
    return F.when(F.contains(text, F.lit("&")), one).otherwise(text)


def page_links(pages: DataFrame) -> DataFrame:
    """``page_id, page_url, pos, href`` for every anchor, in page order, inside the JVM.

    Quoted and bare values count, comments, scripts and style sheets do not, and character references are resolved.
    """
    shown = F.when(F.contains("html", F.lit("<!--")), F.regexp_replace("html", COMMENT, " ")).otherwise(F.col("html"))
    shown = F.when(F.regexp_like(shown, F.lit("(?i)<(script|style)")), F.regexp_replace(shown, RAW, " ")).otherwise(shown)

    def value(raw: Column) -> Column:
        return F.when(raw.substr(1, 1).isin('"', "'"), F.substring(raw, F.lit(2), F.char_length(raw) - 2)).otherwise(raw)

    hrefs = pages.select(
        "page_id",
        F.col("url").alias("page_url"),
        F.posexplode(F.transform(F.regexp_extract_all(shown, F.lit(HREF), 1), value)).alias("pos", "href"),
    )
    return hrefs.withColumn("href", unescape_entities(F.col("href")))


class _ResourceLinks(HTMLParser):
    """Collects the anchors found at the resource path of one page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[list] = []  # [tag, element children so far, 1-based index, id]
        self.hrefs: list[str] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        index = 1
        if self.open:
            self.open[-1][1] += 1
            index = self.open[-1][1]
        found = dict(attrs)
        if tag == "a" and self._at_resource():
            if found.get("href"):
                self.hrefs.append(found["href"])
        if tag not in VOID_TAGS:
            self.open.append([tag, 0, index, found.get("id")])

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                del self.open[depth:]
                return

    def _at_resource(self) -> bool:
        parents = self.open[-len(RESOURCE_PATH):]
        if len(parents) < len(RESOURCE_PATH):
            return False
        root, *inner = parents
        return (
            root[3] == RESOURCE_ROOT_ID
            and tuple(p[0] for p in inner) == RESOURCE_PATH[:-1]
            and inner[-1][2] == RESOURCE_ITEM
        )


_LINK_SCHEMA = pa.schema(
    [("page_id", pa.int64()), ("page_url", pa.string()), ("pos", pa.int32()), ("href", pa.string()), ("error", pa.string())]
)


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {name: [] for name in _LINK_SCHEMA.names}
        for page in batch.to_pylist():
            parser, error = _ResourceLinks(), None
            try:
                parser.feed(page["html"] or "")
                parser.close()
            except Exception as err:  # noqa: BLE001  (the parser asserts on some broken markup)
                error = f"{type(err).__name__}: {err}"[:300]
            found = [(k, href, None) for k, href in enumerate(parser.hrefs)] + [(None, None, error)] * (error is not None)
            for pos, href, why in found:
                row = (page["page_id"], page["url"], pos, href, why)
                for name, cell in zip(out, row, strict=True):
                    out[name].append(cell)
        yield pa.RecordBatch.from_pydict(out, schema=_LINK_SCHEMA)


def scan_resources(pages: DataFrame) -> DataFrame:
    """``page_id, page_url, pos, href, error``: the resource links, and a row with ``error`` for a page that cannot be
    parsed to its end; the links found before that stay.

    The position in nested lists is beyond a regular expression, so each page goes
    through the standard library's HTML parser; pages without such links give no rows.
    """
    return pages.select("page_id", "url", "html").mapInArrow(
        _parse_batches, "page_id bigint, page_url string, pos int, href string, error string"
    )


def resource_links(pages: DataFrame) -> DataFrame:
    """``page_id, page_url, pos, href`` of the second entry of each resource's inner list."""
    return scan_resources(pages).filter(F.col("error").isNull()).drop("error")
