"""Prices, valuations and industry profiles. Dimensions (profiles, prices, tiers, regions) are DataFrames of the caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import rules as R
from .classify import classify, classify_best, classify_tiered
from .normalize import lookup, material_type_id


def price_per_ton(price: Column, unit: Column, units: dict = R.PRICE_UNITS) -> Column:
    """Price of a ton; an unknown unit counts as a ton."""
    return price / F.coalesce(F.try_element_at(lookup(units), F.lower(unit)), F.lit(1.0))


def price_key(name: Column) -> Column:
    return F.trim(F.translate(F.lower(name), "_-", "  "))


def aggregate_prices(prices: DataFrame) -> DataFrame:
    """Mean price a ton by material, the pound price from it, number of prices, confidence min(1, n / 3)."""
    per = price_per_ton(F.col("price_value"), F.col("price_unit"))
    out = prices.groupBy("material_name").agg(F.avg(per).alias("price_per_ton"), F.count("*").alias("source_count"))
    return out.withColumn("price_per_lb", F.col("price_per_ton") * 0.000453592).withColumn("confidence", F.least(F.lit(1.0), F.col("source_count") / 3))


def aggregate_prices_weighted(prices: DataFrame) -> DataFrame:
    """Confidence-weighted mean, least, greatest, number of prices, confidence min(.99, .5 + .1 * distinct sources)."""
    per = price_per_ton(F.col("price_value"), F.col("price_unit"))
    p = prices.select(price_key(F.col("material_name")).alias("material"), per.alias("p"), "confidence", "source")
    weighted = F.try_divide(F.sum(F.col("p") * F.col("confidence")), F.sum("confidence"))
    return p.groupBy("material").agg(weighted.alias("price_per_ton"), F.min("p").alias("price_low"), F.max("p").alias("price_high"), F.count("*").alias("source_count"), F.least(F.lit(0.99), 0.5 + 0.1 * F.count_distinct("source")).alias("confidence"))


def valuations(prices: DataFrame) -> DataFrame:
    """One row a material type id, ready for an upsert: of materials that share an id, the first by name."""
    a = aggregate_prices(prices).withColumn("material_type_id", material_type_id(F.col("material_name")))
    first = Window.partitionBy("material_type_id").orderBy("material_name")
    return a.withColumn("rn", F.row_number().over(first)).where("rn = 1").select("material_type_id", "material_name", F.round("price_per_ton", 2).alias("price_per_ton_usd"), "source_count")


def map_materials(df: DataFrame, material: str, mode: str, rules, default: str | None = None) -> DataFrame:
    """Distinct material, material_type_id, match_confidence by rules: first (fixed .85), best, tiered or smart (.9, else default at .4)."""
    m = df.select(F.col(material).alias("material")).where("material is not null").distinct()
    c = F.col("material")
    if mode == "first":
        found = F.struct(classify(c, rules).alias("label"), F.lit(0.85).alias("confidence"))
    elif mode == "best":
        found = classify_best(c, rules)
    elif mode == "tiered":
        found = classify_tiered(c, rules)
    else:
        label = classify(c, rules)
        found = F.struct(F.coalesce(label, F.lit(default or "UNCLASSIFIED")).alias("label"), F.when(label.isNull(), 0.4).otherwise(0.9).alias("confidence"))
    return m.withColumn("f", found).where("f.label is not null").select("material", F.col("f.label").alias("material_type_id"), F.col("f.confidence").alias("match_confidence"))


def industry_calculator(profiles: DataFrame, prices: DataFrame, tiers: DataFrame, regions: DataFrame) -> DataFrame:
    """Every industry, tier and region: tons, value and CO2 of its profile (industry, material, percent) at mid prices.

    tiers (tier, tons) and regions (region, modifier) are short lists of the caller.
    """
    p = profiles.join(prices, "material").groupBy("industry").agg(
        F.sum(F.col("percent") / 100).alias("share"),
        F.sum(F.col("percent") / 100 * (F.col("price_low") + F.col("price_high")) / 2).alias("value"),
        F.sum(F.col("percent") / 100 * F.col("co2_factor")).alias("co2"),
    )
    t = F.col("tons")
    grid = tiers.join(regions, F.lit(True))
    return p.join(F.broadcast(grid), F.lit(True)).select("industry", "tier", "region", (t * F.col("share")).alias("tons"), (t * F.col("value") * F.col("modifier")).alias("value"), (t * F.col("co2")).alias("co2"))


def blended_default(profiles: DataFrame, parents: DataFrame, top: int = 5) -> DataFrame:
    """parent, material, percent, rank: the parents' (parent, industry) mean profile, top materials, in percent of all mass."""
    p = profiles.join(parents, "industry").groupBy("parent", "material").agg(F.sum("percent").alias("mass"))
    total = Window.partitionBy("parent")
    order = total.orderBy(F.desc("mass"), "material")
    p = p.withColumn("percent", 100 * F.col("mass") / F.sum("mass").over(total)).withColumn("rank", F.row_number().over(order))
    return p.where(F.col("rank") <= top).select("parent", "material", "percent", "rank")


def build_reference(profiles: DataFrame, parents: DataFrame) -> DataFrame:
    """parent, n_industries, n_entries, document: a JSON document of each parent's industries and their profiles."""
    entry = F.array_sort(F.collect_list(F.struct("material", "percent")))
    sub = profiles.groupBy("industry").agg(entry.alias("profile"))
    p = parents.join(sub, "industry").groupBy("parent").agg(F.array_sort(F.collect_list(F.struct("industry", "profile"))).alias("industries"))
    n = F.aggregate("industries", F.lit(0), lambda s, x: s + F.size(x["profile"]))
    return p.select("parent", F.size("industries").cast("long").alias("n_industries"), n.cast("long").alias("n_entries"), F.to_json(F.struct("parent", "industries")).alias("document"))


def sanity_bounds(expected: DataFrame, bounds: DataFrame) -> DataFrame:
    """expected with a verdict by its tier's bounds (tier, low, high): LOW, HIGH, NEGATIVE_CO2 or OK."""
    verdict = F.when(F.col("value") < F.col("low"), "LOW").when(F.col("value") > F.col("high"), "HIGH").when(F.col("co2") < 0, "NEGATIVE_CO2").otherwise("OK")
    return expected.join(bounds, "tier").withColumn("verdict", verdict).drop("low", "high")


def enrich_price_co2(text: Column, table) -> Column:
    """Struct price, co2 of the first key (underscores as spaces) that text holds; zeros if none. table: (key, price, co2)."""
    t = F.lower(text)
    found = [F.when(t.contains(k.replace("_", " ")), F.struct(F.lit(float(p)).alias("price"), F.lit(float(c)).alias("co2"))) for k, p, c in table]
    return F.coalesce(*found, F.struct(F.lit(0.0).alias("price"), F.lit(0.0).alias("co2")))


def verified_volume(text: Column) -> Column:
    """Tons from the first number of a volume text: barrels * 0.15, gallons * 0.00378; 50 without a number."""
    number = F.regexp_replace(F.regexp_extract(text, r"([\d,]+(?:\.\d+)?)", 1), ",", "").try_cast("double")
    t = F.lower(text)
    return F.coalesce(F.when(t.contains("barrel"), number * 0.15).when(t.contains("gallon"), number * 0.00378).otherwise(number), F.lit(50.0))


def flat_valuation(df: DataFrame, source: str, tons: str, rate: float = 50) -> DataFrame:
    return df.groupBy(source).agg(F.sum(tons).cast("double").alias("tons"), (F.sum(tons).cast("double") * rate).alias("value"))


def regional_price(low: Column, high: Column, region: Column, regions: dict = R.REGIONS) -> Column:
    """Struct low, high, mid at the region's modifier (1 if unknown)."""
    m = F.coalesce(F.try_element_at(lookup(regions), region), F.lit(1.0))
    return F.struct((low * m).alias("low"), (high * m).alias("high"), ((low + high) / 2 * m).alias("mid"))


def compatibility(a: Column, b: Column) -> Column:
    """.95 for one category, .85 and .65 for listed pairs in either order, else .4."""
    pair = lambda pairs: F.greatest(*[((a == x) & (b == y)) | ((a == y) & (b == x)) for x, y in pairs])
    return F.when(a == b, 0.95).when(pair(R.HIGH_PAIRS), 0.85).when(pair(R.MEDIUM_PAIRS), 0.65).otherwise(0.4)


def compatibility_score(a: Column, b: Column, places_a: Column, places_b: Column) -> Column:
    """Struct material, geo, combined (.7 and .3, rounded half-even to 2), kind."""
    material, shared = compatibility(a, b), F.size(F.array_intersect(places_a, places_b))
    geo = F.when(shared > 0, F.least(F.lit(1.0), 0.25 * shared)).otherwise(0.2)
    kind = F.when(a == b, F.concat(a, F.lit(" recycling"))).otherwise(F.concat(F.least(a, b), F.lit(" to "), F.greatest(a, b)))
    return F.struct(material.alias("material"), geo.alias("geo"), F.bround(material * 0.7 + geo * 0.3, 2).alias("combined"), kind.alias("kind"))


def industry_lookup(parents: DataFrame, subs: DataFrame, name: str) -> DataFrame:
    """type, name, members of a parent or sub-industry of that name (any case); none gives no row. Columns: name, members."""
    both = parents.select(F.lit("parent").alias("type"), "name", "members").unionByName(subs.select(F.lit("sub").alias("type"), "name", "members"))
    return both.where(F.lower("name") == name.lower())
