"""Markup: character references, links and price elements."""

from __future__ import annotations

import html.entities
import json
import re
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A reference as HTML reads it: a number, or a name of up to 32 characters; the stop may be missing.
REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def literal_map(pairs: dict[str, str]) -> Column:
    """A map as one constant, which is parsed when the plan is made."""
    return F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) where value is computed once, however often it stands in it.

    An inner `use` must not refer to the value of an outer one: Spark then fails to part Python functions from the plan.
    """
    return F.get(F.transform(F.array(value), use), 0)


def decode_references(text: Column) -> Column:
    """Text with all character references decoded as HTML 5 does, each once; what is none stays as it is.

    Names come from Python's table of HTML 5. A name without its stop is matched longest-first. Numbers of no character
    become U+FFFD, those of control characters nothing, and those of the C1 range the characters of Windows-1252.
    """
    names = html.entities.html5
    open_names = sorted((n for n in names if not n.endswith(";")), key=lambda n: (-len(n), n))
    known = literal_map({n: names[n] for n in sorted(names)})
    # Numbers below 256 that are not the character of that number: read from the same rule.
    odd = literal_map({str(n): unescape(f"&#{n};") for n in range(256) if unescape(f"&#{n};") != chr(n)})

    def number(ref: Column) -> Column:
        hexadecimal = F.lower(F.substr(ref, F.lit(2), F.lit(1))) == "x"
        digits = F.regexp_replace(F.regexp_replace(ref, "^#[xX]?0*", ""), ";$", "")
        digits = F.when(digits == "", "0").otherwise(digits)
        # More digits than the last character has: no character.
        value = F.when(F.length(digits) > 8, F.lit(0x110000).cast("long")).when(hexadecimal, F.conv(digits, 16, 10).cast("long")).otherwise(F.conv(digits, 10, 10).cast("long"))
        return once(value, character)

    def character(value: Column) -> Column:
        plane = value % 0x10000
        none = (plane >= 0xFFFE) | value.between(0xFDD0, 0xFDEF)
        char = F.decode(F.unhex(F.lpad(F.hex(value), 8, "0")), "UTF-32")
        special = F.when(value < 256, F.try_element_at(odd, value.cast("string")))
        return F.when(special.isNotNull(), special).when((value > 0x10FFFF) | value.between(0xD800, 0xDFFF), "�").when(none, "").otherwise(char)

    def one(ref: Column) -> Column:
        start = F.regexp_extract(ref, "^(" + "|".join(open_names) + ")", 1)
        named = F.coalesce(F.try_element_at(known, ref), F.when(start != "", F.concat(F.try_element_at(known, start), F.substr(ref, F.length(start) + 1))), F.concat(F.lit("&"), ref))
        return F.when(ref.startswith("#"), number(ref)).otherwise(named)

    def decoded(t: Column) -> Column:
        found = F.struct(F.split(t, REFERENCE, -1).alias("pieces"), F.regexp_extract_all(t, F.lit(REFERENCE), 1).alias("refs"))
        rest = lambda f: F.zip_with(f["refs"], F.slice(f["pieces"], 2, F.size(f["refs"])), lambda r, p: F.concat(one(r), p))
        return F.when(t.contains("&"), once(found, lambda f: F.concat(F.get(f["pieces"], 0), F.array_join(rest(f), "")))).otherwise(t)

    return once(text, decoded)


def without_dots(path: Column) -> Column:
    """A path that starts with a slash, without its `.` and `..` segments."""
    parts = F.split(F.substr(path, F.lit(2)), "/", -1)
    none = F.array().cast("array<string>")
    kept = F.aggregate(parts, none, lambda acc, p: F.when(p == ".", acc).when(p == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.array_append(acc, p)))
    ends_open = F.element_at(parts, -1).isin(".", "..")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(ends_open & (F.size(kept) > 0), "/").otherwise(""))


def resolve_link(href: Column, base: Column) -> Column:
    """href against an absolute page URL by RFC 3986: absolute, //host, /path, ?query and relative paths; the fragment goes."""
    h = F.regexp_replace(href, "#.*$", "")
    scheme, root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1), F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    page = F.when(page == "", "/").otherwise(page)
    path, query = F.regexp_extract(h, r"^([^?]*)", 1), F.regexp_extract(h, r"^[^?]*(\?.*)$", 1)
    rooted = F.when(path.startswith("/"), path).otherwise(F.concat(F.regexp_extract(page, "^(.*/)", 1), path))
    local = F.concat(root, F.when(path == "", page).otherwise(without_dots(rooted)), query)
    return F.when(h.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), h).when(h.startswith("//"), F.concat(scheme, h)).otherwise(local)


# href="...", href='...' and href=... of any tag.
HREF = r"""(?i)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def harvest_links(pages: DataFrame, html: str, url: str, suffix: str = "") -> DataFrame:
    """page_url and its distinct links whose path or query ends with the suffix (any case), resolved against the page's URL.

    Values may be in double, single or no quotes and hold character references. Empty links and links to a place in the
    page itself are left out. Null pages and URLs have none.
    """
    quoted = [F.regexp_extract_all(html, F.lit(HREF), i) for i in (1, 2, 3)]
    both = lambda a, b: F.concat(a, b)
    hrefs = F.zip_with(F.zip_with(quoted[0], quoted[1], both), quoted[2], both)
    d = pages.select(F.col(url).alias("page_url"), F.explode(hrefs).alias("href"))
    d = d.withColumn("href", F.trim(decode_references(F.col("href")))).where("href <> '' and not startswith(href, '#')")
    link = resolve_link(F.col("href"), F.col("page_url"))
    return d.select("page_url", link.alias("link")).where(F.lower("link").endswith(suffix.lower())).distinct()


# Words in a class that mark a price, and elements that have no end.
PRICE = re.compile("price|rate|value", re.I)
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


class Elements(HTMLParser):
    """Texts of the elements of a page: each stripped piece goes to the element that it stands in and to all around it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[dict] = [{"tag": "", "class": "", "text": [], "parent": None}]
        self.marked: list[dict] = []

    def handle_starttag(self, tag, attrs):
        element = {"tag": tag, "class": next((v or "" for k, v in attrs if k == "class"), ""), "text": [], "parent": self.open[-1]}
        if any(PRICE.search(c) for c in element["class"].split()):
            self.marked.append(element)
        if tag not in VOID:
            self.open.append(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i]["tag"] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        piece = data.strip()
        if piece and self.open[-1]["tag"] not in ("script", "style"):
            for element in self.open:
                element["text"].append(piece)


def price_elements(html: str) -> list[tuple[str, str]]:
    """(material, price text) of each element whose class names a price: what its parent holds besides."""
    page = Elements()
    page.feed(html)
    page.close()
    out = []
    for e in page.marked:
        text, around = "".join(e["text"]), "".join(e["parent"]["text"])
        out.append(((around.replace(text, "") if text else around).strip(), text))
    return out


def extract_price_elements(pages: DataFrame, html: str) -> DataFrame:
    """pages' columns, material and price_text of elements with a class that holds price, rate or value, in any depth.

    Only pages with such a class are read by Python; null pages have none. Elements without a text have an empty one.
    """
    some = pages.where(F.col(html).rlike(r"""(?is)\sclass\s*=\s*["']?[^>]*?(?:price|rate|value)"""))
    fields = [f for f in pages.schema.fields if f.name not in ("material", "price_text")]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                found = price_elements(b.column(html)[i].as_py())
                if found:
                    own = [b.column(n).take(pa.array([i] * len(found))) for n in names]
                    yield pa.RecordBatch.from_arrays([*own, pa.array([m for m, _ in found], pa.string()), pa.array([p for _, p in found], pa.string())], names=[*names, "material", "price_text"])

    from pyspark.sql.types import StringType, StructField, StructType

    return some.select(*names).mapInArrow(run, StructType([*fields, StructField("material", StringType()), StructField("price_text", StringType())]))
