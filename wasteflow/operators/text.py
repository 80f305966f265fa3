"""Text and HTML cleaning as column expressions.

Unicode forms need Python; it gets the few characters of a text that a form may change, never whole texts.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import rules as R
from ..sources.markup import decode_references, once


def strip_noise_elements(html: Column) -> Column:
    for p in R.NOISE_ELEMENTS:
        html = F.regexp_replace(html, "(?is)" + p, "")
    return html


def strip_html_basic(html: Column) -> Column:
    """Tags become spaces; then all character references their characters."""
    return decode_references(F.regexp_replace(html, "<[^>]+>", " "))


# For each pattern of NOISE_TEXT, in order: the words of which every match holds one. Texts without them are not searched.
NOISE_WORDS = (("cookie",), ("skip to", "jump to navigation", "back to top"), ("follow us on", "share this", "share on", "like us on facebook"), ("all rights reserved", "©", "privacy policy"))


def remove_text_noise(text: Column) -> Column:
    for pattern, words in zip(R.NOISE_TEXT, NOISE_WORDS, strict=True):
        text = once(text, without(pattern, words))
    return text


def without(pattern: str, words: tuple[str, ...]):
    """Removes the matches of a pattern, of which every one holds one of the words."""

    def removed(t: Column) -> Column:
        low = F.lower(t)
        some = low.contains(words[0])
        for w in words[1:]:
            some = some | low.contains(w)
        return F.when(some, F.regexp_replace(t, "(?i)" + pattern, "")).otherwise(t)

    return removed


def plain_chars(text: Column) -> Column:
    for a, b in R.PLAIN_CHARS:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


@cache
def unsettled(form: str) -> str:
    """Pattern class of the characters that a form changes, orders, or joins to the one before; it may hold others beside them.

    A form can be taken of each part by itself if a text is cut before characters outside of it.
    """
    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    found = {c for c in points if unicodedata.combining(chr(c)) or unicodedata.normalize(form, chr(c)) != chr(c)}
    pairs = (unicodedata.decomposition(chr(c)).split() for c in points)
    found |= {int(p[1], 16) for p in pairs if len(p) == 2 and p[0][0] != "<"} | {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}
    ranges: list[list[int]] = []
    for c in sorted(found):
        if ranges and c - ranges[-1][1] <= 8:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    span = lambda low, high: f"\\x{{{low:X}}}-\\x{{{high:X}}}"
    lots = [ranges[i : i + 16] for i in range(0, len(ranges), 16)]  # a character is sought in one lot only, one below all in none
    within = "".join(f"[{span(lot[0][0], lot[-1][1])}&&[{''.join(span(*r) for r in lot)}]]" for lot in lots)
    return f"[{span(ranges[0][0], ranges[-1][1])}&&[{within}]]"


def unicode_form(form: str):
    @F.arrow_udf("array<string>")
    def normal(a: pa.Array) -> pa.Array:
        runs = a.flatten().dictionary_encode()
        changed = pa.array([unicodedata.normalize(form, x) for x in runs.dictionary.to_pylist()], runs.dictionary.type)
        ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(a), 0)).cast(pa.int32())
        starts = pa.concat_arrays([pa.array([0], pa.int32()), ends])
        return pa.ListArray.from_arrays(starts, changed.take(runs.indices), mask=a.is_null())

    return normal


def in_form(text: Column, form: str) -> Column:
    """The text is cut around runs of unsettled characters with the one before; Python gives the form of the runs."""
    some = unsettled(form)
    run = f"(?s).?{some}+"

    def cut(t: Column) -> Column:
        pieces = F.struct(F.split(t, run, -1).alias("between"), F.regexp_extract_all(t, F.lit(run), F.lit(0)).alias("runs"))
        whole = F.struct(F.array(t).alias("between"), F.lit(None).cast("array<string>").alias("runs"))
        return F.when(t.rlike(r"[^\x00-\x7F]") & t.rlike(some), pieces).when(t.isNotNull(), whole)

    parts = once(text, cut)
    between, runs = parts["between"], unicode_form(form)(parts["runs"])
    joined = F.array_join(F.zip_with(between, runs, lambda b, r: F.concat(b, F.coalesce(r, F.lit("")))), "")
    return F.coalesce(joined, between[0])


def normalize_unicode(text: Column) -> Column:
    return plain_chars(in_form(text, "NFC"))


def clean_whitespace(text: Column) -> Column:
    text = F.regexp_replace(F.replace(text, F.lit("\t"), F.lit(" ")), " +", " ")
    return F.regexp_replace(text, "\n{3,}", "\n\n")


def remove_control_chars(text: Column) -> Column:
    return F.regexp_replace(text, r"[\p{C}\p{Zl}\p{Zp}&&[^\n\t]]", "")


def clean_text(text: Column) -> Column:
    text = remove_text_noise(fix_mojibake(text))
    return F.trim(remove_control_chars(clean_whitespace(normalize_unicode(text))))


def main_block(html: Column) -> Column:
    """The article's content, else the paragraphs', else the whole."""

    def main(h: Column) -> Column:
        article = F.regexp_extract(h, r"(?is)<article[^>]*>(.*?)</article>", 1)
        paragraphs = F.array_join(F.regexp_extract_all(h, F.lit(r"(?is)<p[^>]*>(.*?)</p>"), 1), "\n")
        return F.coalesce(once(article, lambda a: F.when(a != "", a)), once(paragraphs, lambda p: F.when(p != "", p)), h)

    return once(html, main)


def clean_html(html: Column) -> Column:
    return clean_text(strip_html_basic(main_block(strip_noise_elements(html))))


def training_clean(text: Column) -> Column:
    text = in_form(text, "NFKC")
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"[\p{C}&&[^\n\t]]", ""), r"\s+", " "))


def mojibake_flag(text: Column) -> Column:
    return text.rlike("Ã|ï¿½|â€")


def fix_mojibake(text: Column) -> Column:
    """UTF-8 read as Latin-1 is read again as UTF-8 where that gives valid text."""

    def fixed(t: Column) -> Column:
        latin = ~t.rlike("[^\\x00-\\xFF]")
        raw = F.encode(F.regexp_replace(t, "[^\\x00-\\xFF]", ""), "ISO-8859-1").cast("string")
        return F.coalesce(F.when(mojibake_flag(t) & latin, once(raw, lambda r: F.when(F.is_valid_utf8(r), r))), t)

    return once(text, fixed)


def content_dedup(df: DataFrame, column: str, order: str) -> DataFrame:
    """First row (by order) of each content hash, with the hash."""
    h = df.withColumn("content_hash", F.sha2(F.coalesce(column, F.lit("")), 256))
    return h.withColumn("_r", F.row_number().over(Window.partitionBy("content_hash").orderBy(order))).where("_r = 1").drop("_r")
