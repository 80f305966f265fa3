"""Fact extraction and validation."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules as R


def any_word(text: Column, words) -> Column:
    return text.rlike("|".join(re.escape(w) for w in words))


def detect_schema(text: Column) -> Column:
    t = F.lower(text)
    return F.coalesce(*[F.when(any_word(t, words), name) for name, words in R.FACT_SCHEMAS], F.lit("waste_listing"))


def number(text: Column) -> Column:
    return F.regexp_replace(text, ",", "").try_cast("double")


# Patterns that decide a fact's quote.
WASTE = r"(?i)([^.]*?([\d,]+\.?\d*)\s*(metric\s*tons?|tonnes?|tons?|kg|mt)[^.]*\.)"
CARBON = r"(?i)([^.]*?([\d,]+\.?\d*)\s*(?:million\s*)?(?:tonnes?|tons?|mt)\s*(?:of\s*)?(?:CO2|carbon)[^.]*\.)"
VOLUME = r"(?i)([\d,]+\.?\d*)\s*(?:tonnes?|tons?|mt)\b"


def or_null(c: Column) -> Column:
    return F.when(c != "", c)


def extract_waste(text: Column) -> Column:
    """Struct source_quote, quantity, unit, year, material, confidence by rules."""
    t = F.lower(text)
    material = F.coalesce(*[F.when(t.contains(m), m) for m in R.FACT_MATERIALS])
    return F.struct(
        or_null(F.trim(F.regexp_extract(text, WASTE, 1))).alias("source_quote"), number(F.regexp_extract(text, WASTE, 2)).alias("quantity"), or_null(F.lower(F.regexp_extract(text, WASTE, 3))).alias("unit"),
        F.regexp_extract(text, r"\b((?:19|20)\d{2})\b", 1).try_cast("int").alias("year"), material.alias("material"), F.lit(0.6).alias("confidence"),
    )


def extract_carbon(text: Column) -> Column:
    """Struct source_quote, co2_tons (times 1e6 where the sentence says million), year."""
    quote = F.regexp_extract(text, CARBON, 1)
    tons = number(F.regexp_extract(text, CARBON, 2)) * F.when(F.lower(quote).contains("million"), 1e6).otherwise(1.0)
    return F.struct(or_null(F.trim(quote)).alias("source_quote"), tons.alias("co2_tons"), F.regexp_extract(text, r"\b(20[0-2]\d)\b", 1).try_cast("int").alias("year"))


def extract_exchange(text: Column) -> Column:
    """Struct eco_park, source_quote, volume, year."""
    t = F.lower(text)
    park = F.coalesce(*[F.when(t.contains(p), p) for p in R.ECO_PARKS])
    quote = F.coalesce(*[F.when(t.contains(p), F.trim(F.regexp_extract(text, rf"(?i)([^.]*{p}[^.]*\.)", 1))) for p in R.ECO_PARKS])
    return F.struct(F.initcap(park).alias("eco_park"), or_null(quote).alias("source_quote"), number(F.regexp_extract(text, VOLUME, 1)).alias("volume"), F.regexp_extract(text, r"\b((?:19|20)\d{2})\b", 1).try_cast("int").alias("year"))


def violations(rules: list[tuple[str, Column]]) -> Column:
    """Sorted codes of the rules broken; a null outcome breaks none."""
    return F.array_sort(F.array_compact(F.array(*[F.when(bad, F.lit(code)) for code, bad in rules]).cast("array<string>")))


def outside(c: str, low, high) -> Column:
    return F.col(c).isNull() | ~F.col(c).between(low, high)


def validate_waste(df: DataFrame, first: int = 1970, last: int = 2026) -> DataFrame:
    """df with violations: material 2-100 characters, 0 < quantity <= 1e8, year, quote of 10 and more, confidence 0-1; price and currency if there."""
    m = F.length(F.trim("material"))
    rules = [
        ("material", m.isNull() | ~m.between(2, 100)), ("quantity", F.col("quantity_tons").isNull() | (F.col("quantity_tons") <= 0) | (F.col("quantity_tons") > 1e8)), ("year", outside("year", first, last)),
        ("quote", F.coalesce(F.length("source_quote"), F.lit(0)) < 10), ("confidence", outside("extraction_confidence", 0, 1)),
    ]
    if "price" in df.columns:
        rules.append(("price", (F.col("price") <= 0) | (F.col("price") > 1e6)))
    if "currency" in df.columns:
        rules.append(("currency", ~F.col("currency").rlike("^[A-Z]{3}$")))
    return df.withColumn("violations", violations(rules))


def validate_carbon(df: DataFrame) -> DataFrame:
    rules = [("company", F.coalesce(F.length(F.trim("company")), F.lit(0)) < 2), ("year", outside("year", 1970, 2026)), ("co2", F.col("co2_tons").isNull() | (F.col("co2_tons") <= 0) | (F.col("co2_tons") > 1e10))]
    rules += [(c, F.col(c) < 0) for c in ("scope1", "scope2", "scope3") if c in df.columns]
    return df.withColumn("violations", violations(rules))


def scope_check(total: Column, scope1: Column, scope2: Column) -> Column:
    """Whether scopes 1 and 2 exceed the total by more than a tenth, where all three are there and not zero."""
    return F.coalesce((total != 0) & (scope1 != 0) & (scope2 != 0) & (scope1 + scope2 > total * 1.1), F.lit(False))


def validate_exchange(df: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    rules = [(c, F.coalesce(F.length(F.trim(c)), F.lit(0)) < 2) for c in ("source_company", "target_company", "material")]
    rules += [("volume", F.col("volume_tons") <= 0), ("year", outside("year", 1970, 2026)), ("kind", ~F.coalesce("exchange_type", F.lit("")).isin(*kinds))]
    return df.withColumn("violations", violations(rules))


def citation_check(quote: Column, text: Column) -> Column:
    return F.coalesce(F.lower(text).contains(F.lower(F.trim(quote))), F.lit(False))


def review_flag(confidence: Column, least: float = 0.9) -> Column:
    return confidence < least


def route_results(df: DataFrame, kind: str = "record_type") -> dict[str, DataFrame]:
    """Valid rows by record type, and `rejected` with their reasons."""
    good = df.where(F.size("violations") == 0)
    return {k: good.where(F.col(kind) == k).drop("violations") for k in ("waste_listing", "carbon_emission", "symbiosis_exchange")} | {"rejected": df.where(F.size("violations") > 0)}


# A scan takes so many texts at a time and gives so many rows at most; it keeps the rows of so many texts of so many characters.
TEXTS, ROWS, KEPT, KEPT_LENGTH = 256, 4096, 1 << 15, 500


def scan_texts(df: DataFrame, find, schema: str, key: str, text: str) -> DataFrame:
    """Rows of find(text) -> tuples for every text, with its key; null texts give none. Arrow batches, no shuffle.

    A task keeps what it found in the short texts that it met last, as rendered ones come again. Texts and rows pass in small
    lots, so a task's memory depends on neither the batch nor how much a text holds.
    """
    names, kinds = zip(*[s.split() for s in schema.split(", ")])
    types = [{"string": pa.string(), "double": pa.float64()}[k] for k in kinds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lru_cache(KEPT)(lambda t: tuple(find(t)))

        def made(keys: pa.Array, at: list[int], hits: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([keys.take(pa.array(at)), *[pa.array(c, t) for c, t in zip(zip(*hits), types)]], names=[key, *names])

        for b in batches:
            for start in range(0, b.num_rows, TEXTS):
                part = b.slice(start, TEXTS)
                at, hits = [], []
                for i, t in enumerate(part.column(1)):
                    t = t.as_py()
                    for r in () if t is None else known(t) if len(t) <= KEPT_LENGTH else find(t):
                        at.append(i)
                        hits.append(r)
                        if len(hits) == ROWS:
                            yield made(part.column(0), at, hits)
                            at, hits = [], []
                if hits:
                    yield made(part.column(0), at, hits)

    return df.select(key, text).mapInArrow(run, f"{key} {dict(df.dtypes)[key]}, {schema}")


def process_context(df: DataFrame, words: list[str], around: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """keyword, context of every hit (any case) with `around` characters on both sides, white space squashed."""

    def find(t: str):
        low = t.lower()
        for w in words:
            at = low.find(w.lower())
            while at >= 0:
                yield w, " ".join(t[max(0, at - around) : at + len(w) + around].split())
                at = low.find(w.lower(), at + 1)

    return scan_texts(df, find, "keyword string, context string", key, text)


def cas_numbers(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"\b([1-9]\d{1,5}-\d{2}-\d)\b"), 1)


def volume_mentions(text: Column, around: int = 50) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"(?is)(.{{0,{around}}}\d[\d,.]*\s*(?:tonnes|tons|barrels|gallons).{{0,{around}}})"), 1)


def keyword_coverage(df: DataFrame, groups: dict[str, list[str]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score (groups hit), hits (comma-joined, in group order)."""
    t = F.lower(text)
    hits = F.array_compact(F.array(*[F.when(any_word(t, words), F.lit(g)) for g, words in groups.items()]))
    return df.select(key, hits.alias("h")).select(key, F.size("h").cast("long").alias("score"), F.array_join("h", ",").alias("hits"))


def parse_json_reply(reply: Column) -> Column:
    """The reply's JSON text: plain, from a fenced block, or its first {...}; null if none parses."""
    fenced, braces = F.regexp_extract(reply, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1), F.regexp_extract(reply, r"(?s)(\{.*\})", 1)
    return F.coalesce(*[F.to_json(F.try_parse_json(c)) for c in (F.trim(reply), fenced, braces)])
