"""Units, dates, ids and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import material_tables as T
from .. import rules as R
from ..sources.markup import once
from .classify import classify

MANY = 1 << 30
QUANTITY = r"(?i)([\d,]+(?:\.\d+)?)\s*(metric[ _]tons?|tonnes?|tons?|mt|kilograms?|kg|pounds?|lbs?)\b"


def lookup(table: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def unit_key(unit: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(unit)), r"[\s.]+", "_")


def to_metric_tons(value: Column, unit: Column, units: dict = R.UNITS) -> Column:
    """Struct value, unit: tons rounded half-even to 4 places; an unknown unit leaves both as they are."""
    factor = F.try_element_at(lookup(units), unit_key(unit))
    known = factor.isNotNull()
    return F.struct(F.when(known, F.bround(value * factor, 4)).otherwise(value).alias("value"), F.when(known, F.lit("metric_ton")).otherwise(unit).alias("unit"))


def gov_to_tons(value: Column, unit: Column) -> Column:
    """Tons as government feeds count them: `tons` is metric, unknown units count as tons."""
    return value * F.coalesce(F.try_element_at(lookup(R.GOV_UNITS), F.lower(F.trim(unit))), F.lit(1.0))


def extract_quantities(text: Column) -> Column:
    """array<struct<value, unit, tons>> of all number-unit pairs, in order."""
    values, units = F.regexp_extract_all(text, F.lit(QUANTITY), 1), F.regexp_extract_all(text, F.lit(QUANTITY), 2)

    def one(v, u):
        number = F.regexp_replace(v, ",", "").try_cast("double")
        return F.struct(number.alias("value"), F.lower(u).alias("unit"), to_metric_tons(number, u)["value"].alias("tons"))

    return F.filter(F.zip_with(values, units, one), lambda q: q["value"].isNotNull())


def rewrite_quantities(text: Column) -> Column:
    """Text with every quantity of a known unit as metric tons, rounded to 4 places; other quantities stay as they are."""

    def one(whole: Column, number: Column, unit: Column) -> Column:
        tons = F.bround(F.regexp_replace(number, ",", "").try_cast("double") * F.try_element_at(lookup(R.UNITS), unit_key(unit)), 4)
        return F.coalesce(F.concat(F.regexp_replace(F.format_string("%.4f", tons), r"\.?0+$", ""), F.lit(" metric_ton")), whole)

    def rewritten(t: Column) -> Column:
        found = [F.regexp_extract_all(t, F.lit(QUANTITY), i) for i in (0, 1, 2)]
        put = F.transform(F.arrays_zip(*[f.alias(n) for f, n in zip(found, "wnu")]), lambda q: one(q["w"], q["n"], q["u"]))
        pieces = F.split(t, QUANTITY, -1)
        return F.concat(F.get(pieces, 0), F.array_join(F.zip_with(put, F.slice(pieces, 2, MANY), lambda a, b: F.concat(a, b)), ""))

    return F.when(text.rlike(QUANTITY), once(text, rewritten)).otherwise(text)


def parse_date(text: Column) -> Column:
    """Date by the formats in order, else January 1 of the first 19xx or 20xx year, else null."""
    t = F.trim(text)
    shapes = (
        (r"^\d{4}-\d{1,2}-\d{1,2}$", "y-M-d"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/y"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/y"), (r"^\d{4}/\d{1,2}/\d{1,2}$", "y/M/d"),
        (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-y"), (r"^[A-Za-z]+ \d{1,2}, \d{4}$", "MMMM d, y"), (r"^\d{1,2} [A-Za-z]+ \d{4}$", "d MMMM y"),
    )
    tried = [F.when(t.rlike(shape), F.try_to_timestamp(t, F.lit(f)).cast("date")) for shape, f in shapes]
    year = F.regexp_extract(t, r"((?:19|20)\d{2})", 1).try_cast("int")
    return F.coalesce(*tried, F.make_date(year, F.lit(1), F.lit(1)))


def material_type_id(name: Column) -> Column:
    """Abbreviation and up to 8 characters, or the first 12."""
    n = F.upper(F.replace(name, F.lit(" "), F.lit("")))
    parts = []
    for full, short in R.TYPE_PREFIXES:
        rest = F.substring(n, len(full) + 1, 8)
        parts.append(F.when(n.startswith(full), F.when(rest == "", F.lit(short)).otherwise(F.concat(F.lit(f"{short}-"), rest))))
    return F.coalesce(*parts, F.substring(n, 1, 12))


def title_material(key: Column) -> Column:
    return F.initcap(F.replace(key, F.lit("_"), F.lit(" ")))


def extract_country(location: Column) -> Column:
    """ISO code of the first country keyword; EUR for other places; null for none."""
    return F.when(location.isNotNull() & (location != ""), classify(location, R.COUNTRIES, "EUR"))


def texts(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def chemical_profile(material: Column, profiles=T.CHEMICAL_PROFILES) -> Column:
    """Struct composition (component, percent_range), hazards, potential_uses of the first profile whose keyword the material holds."""
    lower = F.lower(material)

    def one(components, hazards, uses):
        parts = F.array(*[F.struct(F.lit(c).alias("component"), F.lit(p).alias("percent_range")) for c, p in components])
        return F.struct(parts.alias("composition"), texts(hazards).alias("hazards"), texts(uses).alias("potential_uses"))

    return F.coalesce(*[F.when(lower.contains(keyword), one(*rest)) for keyword, *rest in profiles])


def receiver_type(category: Column, material: Column, types=T.RECEIVER_TYPES, default: str = T.OTHER_RECEIVER) -> Column:
    """Receiver of a listing: the first type whose word the category or the material holds. Nulls hold none."""
    c, m = F.lower(F.coalesce(category, F.lit("Industrial Waste"))), F.lower(F.coalesce(material, F.lit("")))
    return F.coalesce(*[F.when(c.contains(a) | m.contains(b), F.lit(name)) for name, a, b in types], F.lit(default))


def receiver_lookup(category: Column, table=T.RECEIVERS, default=T.OTHER_RECEIVERS) -> Column:
    """Struct receivers, carbon_offset of a category."""
    one = lambda names, offset: F.struct(texts(names).alias("receivers"), F.lit(offset).alias("carbon_offset"))
    return F.coalesce(*[F.when(category == name, one(names, offset)) for name, names, offset in table], one(*default))


def industry_categories(industry: Column, table=T.INDUSTRY_CATEGORIES, default=("mixed",)) -> Column:
    """Waste categories of an industry."""
    return F.coalesce(*[F.when(industry == name, texts(categories)) for name, categories in table], texts(default))
