"""Sources: delimited listings, registers, series, snapshots, price tables, links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Header aliases of a release register.
RELEASE_ALIASES = {"year": ["1. year", "year", "reporting year"], "company": ["4. facility name", "facility name"], "material": ["37. chemical", "chemical"], "unit": ["50. unit of measure", "unit of measure"]}
HEADER_WORDS = ("material", "price", "type", "grade", "item", "name", "description", "category")


def read_listing_csv(spark: SparkSession, path: str, schema: str, delimiter: str = ",", ragged: str = "keep") -> DataFrame:
    """Header CSV with a schema; bad bytes replaced; ragged rows kept with nulls, or dropped."""
    return spark.read.csv(path, schema=schema, header=True, sep=delimiter, encoding="UTF-8", mode="PERMISSIVE" if ragged == "keep" else "DROPMALFORMED")


def map_headers(df: DataFrame, maps: list[dict[str, list[str]]], least: int = 3) -> DataFrame:
    """Renames by the first alias map with at least `least` hits, any case; raises if none fits."""
    have = {c.lower().strip(): c for c in df.columns}
    for m in maps:
        found = {field: have[a.lower()] for field, aliases in m.items() for a in aliases[::-1] if a.lower() in have}
        if len(found) >= least:
            return df.select(*[F.col(f"`{c}`").alias(field) for field, c in found.items()])
    raise ValueError(f"no source map fits {df.columns}")


def guess_column(columns: list[str], words: list[str], by: str = "columns") -> str | None:
    """First column that holds a keyword, going by columns or by keywords."""
    pairs = ((c, w) for c in columns for w in words) if by == "columns" else ((c, w) for w in words for c in columns)
    return next((c for c, w in pairs if w.lower() in c.lower()), None)


def unpivot_fates(df: DataFrame, ids: list[str], fates: dict[str, str]) -> DataFrame:
    """One row for each positive fate column (column -> treatment)."""
    d = df.select(*ids, *[F.col(c).cast("double").alias(t) for c, t in fates.items()])
    return d.unpivot(ids, list(fates.values()), "treatment", "quantity").where("quantity > 0")


def parse_quantity(text: Column, mode: str = "strip") -> Column:
    """Number without `,` and `<`; or of digits and points alone; null if there is none."""
    return F.regexp_replace(text, "[,<]" if mode == "strip" else r"[^\d.]", "").try_cast("double")


def decode_eu_transfers(df: DataFrame) -> DataFrame:
    """HW and NONHW, D and R codes in words; city and country as location; a citation text."""
    material = F.when(F.col("waste_class") == "HW", "Hazardous waste").when(F.col("waste_class") == "NONHW", "Non-hazardous waste").otherwise(F.col("waste_class"))
    treatment = F.when(F.col("treatment") == "D", "Disposal").when(F.col("treatment") == "R", "Recovery").otherwise("Unknown")
    quote = F.concat_ws(" ", F.lit("Facility"), "facility", F.lit("transferred"), F.col("quantity").cast("string"), F.lit("t of"), material)
    return df.select("*", material.alias("material"), treatment.alias("treatment_method"), F.concat_ws(", ", "city", "country").alias("location"), F.substring(quote, 1, 500).alias("citation"))


def read_series_json(df: DataFrame, column: str) -> DataFrame:
    """year, variable, value of JSON lists; totals are left out, as they count twice."""
    rows = df.select("*", F.inline(F.from_json(column, "array<struct<year:string,variable:string,value:double>>")))
    return rows.where(F.lower("variable") != "total")


def mine_row_pair(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each row's first positive number and first text of more than three characters."""
    cells = F.array(*[F.col(c).cast("string") for c in columns])
    numbers = F.filter(F.transform(cells, lambda x: F.regexp_replace(x, ",", "").try_cast("double")), lambda x: x > 0)
    texts = F.filter(cells, lambda x: (F.length(F.trim(x)) > 3) & F.regexp_replace(x, ",", "").try_cast("double").isNull())
    return df.select("*", F.get(numbers, 0).alias("number"), F.get(texts, 0).alias("label"))


def region_from_name(name: Column, rules: list[tuple[str, str]], default: str) -> Column:
    return F.coalesce(*[F.when(F.lower(name).contains(k), v) for k, v in rules], F.lit(default))


def register_documents(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Documents by content hash: known ones take the new url, keep a path they have, and merge metadata (the new value wins)."""
    n = new.select("content_hash", F.col("url").alias("n_url"), F.col("path").alias("n_path"), F.col("metadata").alias("n_meta"))
    j = existing.join(n, "content_hash", "full_outer")
    empty = F.create_map().cast("map<string,string>")
    old, fresh = F.coalesce("metadata", empty), F.coalesce("n_meta", empty)
    merged = F.map_concat(F.map_filter(old, lambda k, v: ~F.array_contains(F.map_keys(fresh), k)), fresh)
    return j.select("content_hash", F.coalesce("n_url", "url").alias("url"), F.coalesce("path", "n_path").alias("path"), merged.alias("metadata"))


def fingerprint(name: Column, size: Column) -> Column:
    return F.sha2(F.concat(name, size.cast("string")), 256)


def skip_seen(files: DataFrame, seen: DataFrame) -> DataFrame:
    return files.withColumn("fingerprint", fingerprint(F.col("name"), F.col("size"))).join(seen.select("fingerprint"), "fingerprint", "left_anti")


def select_snapshots(index: DataFrame, least: int = 500) -> DataFrame:
    """Archive index rows with status 200, html, a length of at least `least` or unreadable: the first of each url and month."""
    from pyspark.sql import Window

    good = index.where((F.col("statuscode") == "200") & F.col("mimetype").contains("html") & (F.coalesce(F.col("length").try_cast("long"), F.lit(least)) >= least))
    first = Window.partitionBy("original", F.substring("timestamp", 1, 6)).orderBy("timestamp")
    return good.withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r")


def extract_price_rows(pages: DataFrame, html: str) -> DataFrame:
    """material (first cell) and price_text (last) of table rows with two cells or more."""
    row = F.explode(F.regexp_extract_all(html, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)).alias("row")
    cells = F.transform(F.regexp_extract_all("row", F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), 1), lambda c: F.trim(F.regexp_replace(c, "<[^>]+>", "")))
    d = pages.select("*", row).withColumn("cells", cells).where("size(cells) >= 2")
    return d.select("*", F.get("cells", 0).alias("material"), F.element_at("cells", -1).alias("price_text")).drop("row", "cells")


def parse_price_cell(text: Column) -> Column:
    """Struct price, currency (USD unless another sign), unit."""
    t = F.lower(text)
    unit = F.when(t.rlike(r"lb|pound"), "lb").when(t.rlike(r"kg|kilo"), "kg").when(t.contains("cwt"), "cwt").when(t.rlike(r"ton|/mt\b"), "metric_ton").otherwise("per_unit")
    price = F.regexp_replace(F.regexp_extract(text, r"([\d,]+(?:\.\d+)?)", 1), ",", "").try_cast("double")
    return F.struct(price.alias("price"), F.when(text.contains("€"), "EUR").when(text.contains("£"), "GBP").otherwise("USD").alias("currency"), unit.alias("unit"))


def is_valid_material(c: Column) -> Column:
    return F.coalesce(F.length(F.trim(c)).between(2, 100) & ~F.lower(F.trim(c)).isin(*HEADER_WORDS), F.lit(False))


def year_from_name(name: Column, text: Column) -> Column:
    """20[0-2]x in the name, else the last one in the whole text."""
    inside = F.regexp_extract_all(text, F.lit(r"(20[0-2]\d)"), 1)
    return F.coalesce(F.regexp_extract(name, r"(20[0-2]\d)", 1).try_cast("int"), F.try_element_at(inside, F.lit(-1)).try_cast("int"))


def year_from_url(url: Column, since: int = 2000) -> Column:
    """The last year in a URL: of 2000 to 2029, or with since=1980 of 1980 to 2029."""
    pattern = r"(20[0-2]\d)" if since >= 2000 else r"(19[89]\d|20[0-2]\d)"
    return F.try_element_at(F.regexp_extract_all(url, F.lit(pattern), 1), F.lit(-1)).try_cast("int")


# The kind of register that a source's files are read as; others are release registers.
SOURCE_TYPES = (("government", "epa_tri"), ("gov", "epa_tri"), ("eprtr", "eprtr"), ("mena", "generic"), ("bayanat", "generic"), ("saudi", "generic"))


def source_type(source: Column) -> Column:
    return F.coalesce(*[F.when(source == name, kind) for name, kind in SOURCE_TYPES], F.lit("epa_tri"))


def route_documents(kind: Column, path: Column) -> Column:
    """csv, pdf, html or text."""
    p = F.lower(F.coalesce(path, F.lit("")))
    return F.when((kind == "csv") | p.endswith(".csv"), "csv").when((kind == "pdf") | p.endswith(".pdf"), "pdf").when((kind == "html") | p.rlike(r"\.html?$"), "html").otherwise("text")


def profile_csv(text: Column, delimiter: str = ",") -> Column:
    """Struct rows (without the header), columns, header of a text CSV."""
    lines = F.filter(F.split(text, "\r?\n"), lambda x: x != "")
    header = F.split(F.get(lines, 0), delimiter)
    return F.struct((F.size(lines) - 1).cast("long").alias("rows"), F.size(header).cast("long").alias("columns"), F.array_join(header, "|").alias("header"))


def company_from_path(path: Column, known: list[str]) -> Column:
    """First known name that the path holds, else the file name up to its first underscore."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.coalesce(*[F.when(F.lower(path).contains(k.lower()), k) for k in known], F.split_part(name, F.lit("_"), F.lit(1)))
