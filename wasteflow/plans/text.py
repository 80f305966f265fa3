"""Queries of text cleaning (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import text as T
from .catalog import query

NOISE = "html"
for _p in T.R.NOISE_ELEMENTS:
    NOISE = f"regexp_replace({NOISE}, '{_p.replace(chr(39), chr(39) * 2)}', '', 'gis')"


@query("c1_strip_noise_elements", f"SELECT page_id, {NOISE} AS html FROM {{pages}}")
def _(t):
    return t.pages.select("page_id", T.strip_noise_elements(F.col("html")).alias("html"))


# References of all kinds, and what they stand for.
REFERENCES = "&eacute;&#233;&#xE9;&#XE9 &copy 2024 &amp;lt;&notit;&unknown; & &#x80;&#0;&#x1F600;&#xD800;&lt;b&gt;&ZeroWidthSpace;"
DECODED = "éééé © 2024 &lt;¬it;&unknown; & €\ufffd😀\ufffd<b>\u200b"


@query("c2_strip_html_basic", f"SELECT page_id, replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&') || ' {DECODED}' AS text FROM {{pages}}")
def _(t):
    return t.pages.select("page_id", T.strip_html_basic(F.concat("html", F.lit(f" {REFERENCES}"))).alias("text"))


QUIET = "'Skip to content. ' || text || ' Follow us on'"
for _p in T.R.NOISE_TEXT:
    QUIET = f"regexp_replace({QUIET}, '{_p}', '', 'gi')"


@query("c3_remove_text_noise", "SELECT doc_id, " + QUIET + " AS text FROM {documents}")
def _(t):
    return t.documents.select("doc_id", T.remove_text_noise(F.concat(F.lit("Skip to content. "), F.col("text"), F.lit(" Follow us on"))).alias("text"))


@query("c4_normalize_unicode", "SELECT doc_id, nfc_normalize(replace(replace(text, '—', '-'), '…', '...')) || '\"-' AS text FROM {documents}")
def _(t):
    return t.documents.select("doc_id", T.normalize_unicode(F.concat(F.col("text"), F.lit("”—"))).alias("text"))


@query("c5_clean_whitespace", "SELECT doc_id, regexp_replace(regexp_replace(replace(text, chr(9), ' '), ' +', ' ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g') AS text FROM {documents}")
def _(t):
    return t.documents.select("doc_id", T.clean_whitespace(F.col("text")).alias("text"))


@query("c6_remove_control_chars", "SELECT doc_id, text || 'ab' AS text FROM {documents}")
def _(t):
    return t.documents.select("doc_id", T.remove_control_chars(F.concat(F.col("text"), F.lit("a\x07​b"))).alias("text"))


def clean_sql(text: str) -> str:
    """clean_text of texts without mojibake."""
    for p in T.R.NOISE_TEXT:
        text = f"regexp_replace({text}, '{p}', '', 'gi')"
    text = f"nfc_normalize({text})"
    for a, b in T.R.PLAIN_CHARS:
        text = f"replace({text}, '{a.replace(chr(39), chr(39) * 2)}', '{b.replace(chr(39), chr(39) * 2)}')"
    text = f"regexp_replace(regexp_replace(replace({text}, chr(9), ' '), ' +', ' ', 'g'), '\\n{{{{3,}}}}', chr(10) || chr(10), 'g')".replace("{{", "{").replace("}}", "}")
    return f"trim(regexp_replace({text}, '[^\\P{{C}}\\n\\t]|[\\p{{Zl}}\\p{{Zp}}]', '', 'g'))"


NOISY = "text || ' Skip to content.  \t \u201cÅ\u201d\u2014\u200b\u2028x Follow us on '"


@query("c7_clean_text", f"SELECT doc_id, {clean_sql('(' + NOISY + ')')} AS text FROM {{documents}}")
def _(t):
    return t.documents.select("doc_id", T.clean_text(F.concat("text", F.lit(NOISY.split("'")[1]))).alias("text"))


MAIN = """CASE WHEN regexp_extract(h, '<article[^>]*>(.*?)</article>', 1, 'is') <> '' THEN regexp_extract(h, '<article[^>]*>(.*?)</article>', 1, 'is')
    WHEN array_to_string(regexp_extract_all(h, '<p[^>]*>(.*?)</p>', 1, 'is'), chr(10)) <> '' THEN array_to_string(regexp_extract_all(h, '<p[^>]*>(.*?)</p>', 1, 'is'), chr(10)) ELSE h END"""
PLAIN = "replace(replace(replace(replace(regexp_replace(m, '<[^>]+>', ' ', 'g'), '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&')"


@query("c8_clean_html", f"WITH n AS (SELECT page_id, {NOISE} AS h FROM {{pages}}), b AS (SELECT page_id, {MAIN} AS m FROM n) SELECT page_id, {clean_sql(PLAIN)} AS text FROM b")
def _(t):
    return t.pages.select("page_id", T.clean_html(F.col("html")).alias("text"))


@query("c9_training_clean", "SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM {documents}")
def _(t):
    return t.documents.select("doc_id", T.training_clean(F.col("text")).alias("text"))


@query("c10_mojibake_flag", "SELECT id, regexp_matches(source_quote, 'Ã|ï¿½|â€') AS flag FROM {faulty}")
def _(t):
    return t.faulty.select("id", T.mojibake_flag(F.col("source_quote")).alias("flag"))


@query("c11_fix_mojibake", "SELECT id, replace(source_quote, 'cafÃ©', 'café') AS text FROM {faulty}")
def _(t):
    return t.faulty.select("id", T.fix_mojibake(F.col("source_quote")).alias("text"))


@query("c12_content_dedup", "SELECT min(doc_id) AS doc_id, sha256(text) AS content_hash FROM {documents} GROUP BY text")
def _(t):
    return T.content_dedup(t.documents, "text", "doc_id").select("doc_id", "content_hash")
