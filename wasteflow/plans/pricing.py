"""Queries of prices and valuation (K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import material_tables as T
from .. import rules as R
from ..operators import pricing as P
from ..operators.classify import classify, sql_case
from .catalog import query

PER_TON = "price_value / CASE price_unit WHEN 'lb' THEN CAST(0.000453592 AS DOUBLE) WHEN 'kg' THEN CAST(0.001 AS DOUBLE) WHEN 'ton' THEN CAST(0.907185 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END"
PROFILE_SQL = "SELECT p_brand AS industry, p_name AS material, CAST(sum(p_size) AS DOUBLE) AS percent FROM {part} GROUP BY 1, 2"
PRICE_SQL = "SELECT p_name AS material, CAST(min(p_retailprice) AS DOUBLE) AS price_low, CAST(max(p_retailprice) AS DOUBLE) AS price_high, CAST(avg(p_size) AS DOUBLE) AS co2_factor FROM {part} GROUP BY 1"
TIER_SQL = "SELECT DISTINCT CASE WHEN p_size % 2 = 0 THEN 'small' ELSE 'medium' END AS tier, CAST(CASE WHEN p_size % 2 = 0 THEN 500 ELSE 5000 END AS DOUBLE) AS tons FROM {part}"
REGION_SQL = "SELECT r_name AS region, CAST(1 + r_regionkey * 0.125 AS DOUBLE) AS modifier FROM {region}"
PARENT_SQL = "SELECT DISTINCT p_brand AS industry, substr(p_brand, 1, 7) AS parent FROM {part}"
CALC_SQL = f"""WITH pr AS ({PROFILE_SQL}), c AS ({PRICE_SQL}), s AS (SELECT industry, sum(percent / 100) AS share, sum(percent / 100 * (price_low + price_high) / 2) AS value, sum(percent / 100 * co2_factor) AS co2 FROM pr JOIN c USING (material) GROUP BY 1),
    e AS (SELECT industry, tier, region, round(tons * share, 3) AS tons, round(tons * value * modifier, 6) AS value, round(tons * co2, 3) AS co2 FROM s, ({TIER_SQL}) t, ({REGION_SQL}) r)"""


def dims(t):
    return t.sql(PROFILE_SQL), t.sql(PRICE_SQL), t.sql(TIER_SQL), t.sql(REGION_SQL)


def expected(t):
    e = P.industry_calculator(*dims(t))
    return e.withColumns({"tons": F.round("tons", 3), "value": F.round("value", 6), "co2": F.round("co2", 3)})


@query("k1_price_per_ton", f"SELECT id, {PER_TON} AS per_ton FROM {{prices}}")
def _(t):
    return t.prices.select("id", P.price_per_ton(F.col("price_value"), F.col("price_unit")).alias("per_ton"))


@query("k2_aggregate_prices", f"""SELECT material_name, round(avg({PER_TON}), 4) AS price_per_ton, round(avg({PER_TON}) * CAST(0.000453592 AS DOUBLE), 6) AS price_per_lb, count(*) AS source_count, least(1.0, count(*) / 3.0)::DOUBLE AS confidence FROM {{prices}} GROUP BY 1""")
def _(t):
    return P.aggregate_prices(t.prices).withColumns({"price_per_ton": F.round("price_per_ton", 4), "price_per_lb": F.round("price_per_lb", 6)})


@query("k3_aggregate_prices_weighted", f"""SELECT translate(lower(material_name), '_-', '  ') AS material, round(sum(({PER_TON}) * confidence) / sum(confidence), 4) AS price_per_ton, round(min({PER_TON}), 4) AS price_low, round(max({PER_TON}), 4) AS price_high,
    count(*) AS source_count, round(least(0.99, 0.5 + 0.1 * count(DISTINCT source)), 4)::DOUBLE AS confidence FROM {{prices}} GROUP BY 1""")
def _(t):
    return P.aggregate_prices_weighted(t.prices).withColumns({c: F.round(c, 4) for c in ("price_per_ton", "price_low", "price_high", "confidence")})


@query("k4_store_valuations", f"""WITH a AS (SELECT material_name, substr(upper(replace(material_name, ' ', '')), 1, 12) AS material_type_id, round(avg({PER_TON}), 2) AS price_per_ton_usd, count(*) AS source_count FROM {{prices}} GROUP BY 1)
    SELECT material_type_id, material_name, price_per_ton_usd, source_count FROM a QUALIFY row_number() OVER (PARTITION BY material_type_id ORDER BY material_name) = 1""")
def _(t):
    return P.valuations(t.prices)


@query("k5_map_materials_first", f"SELECT * FROM (SELECT DISTINCT material, {sql_case('material', R.PART_RULES)} AS material_type_id, CAST(0.85 AS DOUBLE) AS match_confidence FROM {{listings}}) WHERE material_type_id IS NOT NULL")
def _(t):
    return P.map_materials(t.listings, "material", "first", R.PART_RULES)


def worded(rules: list[str]) -> tuple[str, list[str]]:
    """Materials with each keyword of the rules, and some without: DuckDB text, and the words by part key."""
    words = [*rules, "plain", "hot sand"]
    return f"SELECT DISTINCT p_name || ' ' || {words}[CAST(p_partkey % {len(words)} AS INT) + 1] || ' x' AS m FROM {{part}}", words


def materials(t, words: list[str]):
    word = F.element_at(F.array(*[F.lit(w) for w in words]), (F.col("p_partkey") % len(words) + 1).cast("int"))
    return t.part.select(F.concat_ws(" ", "p_name", word, F.lit("x")).alias("material"))


def ordered_sql(rules: list[tuple]) -> str:
    return ", ".join(f"({i}, '{k}', '{label}', {c})" for i, (k, label, c) in enumerate(rules))


BEST_SQL, BEST_WORDS = worded([k for k, _, _ in T.BEST_RULES])
TIERS = [(k, label, c) for rules, c in T.TIERED_RULES[:2] for label, keys in rules for k in keys]
TIER_WORDS_SQL, TIER_WORDS = worded([*[k for k, _, _ in TIERS], "non-hazardous waste"])
SMART = [(k, label, 0.9) for label, keys in T.SMART_RULES for k in keys]
SMART_SQL, SMART_WORDS = worded([k for k, _, _ in SMART])


@query("k6_map_materials_best", f"WITH r(i, k, label, c) AS (VALUES {ordered_sql(T.BEST_RULES)}), n AS ({BEST_SQL}) SELECT m AS material, arg_min(label, (-c, i)) AS material_type_id, max(c)::DOUBLE AS match_confidence FROM n JOIN r ON contains(lower(m), k) GROUP BY m")
def _(t):
    return P.map_materials(materials(t, BEST_WORDS), "material", "best", T.BEST_RULES)


@query("k7_map_materials_tiered", f"WITH r(i, k, label, c) AS (VALUES {ordered_sql(TIERS)}), n AS ({TIER_WORDS_SQL}) SELECT m AS material, coalesce(arg_min(label, i), 'CHEM-NONHAZ') AS material_type_id, coalesce(arg_min(c, i), 0.4)::DOUBLE AS match_confidence FROM n LEFT JOIN r ON contains(lower(m), k) GROUP BY m")
def _(t):
    return P.map_materials(materials(t, TIER_WORDS), "material", "tiered", T.TIERED_RULES)


@query("k8_map_materials_smart", f"""WITH r(i, k, label, c) AS (VALUES {ordered_sql(SMART)}), p(label, price) AS (VALUES {', '.join(f"('{a}', {b})" for a, b in T.CATEGORY_PRICES)}), n AS ({SMART_SQL}),
    f AS (SELECT m AS material, coalesce(arg_min(label, i), 'UNCLASSIFIED') AS material_type_id, (CASE WHEN min(i) IS NULL THEN 0.4 ELSE 0.9 END)::DOUBLE AS match_confidence FROM n LEFT JOIN r ON contains(lower(m), k) GROUP BY m) SELECT f.*, price::DOUBLE AS price_per_ton_usd FROM f JOIN p ON material_type_id = p.label""")
def _(t):
    price = F.coalesce(*[F.when(F.col("material_type_id") == label, float(usd)) for label, usd in T.CATEGORY_PRICES])
    return P.map_materials(materials(t, SMART_WORDS), "material", "smart", T.SMART_RULES).withColumn("price_per_ton_usd", price)


@query("k9_industry_calculator", CALC_SQL + " SELECT * FROM e")
def _(t):
    return expected(t)


@query("k10_blended_default", f"""WITH pr AS ({PROFILE_SQL}), m AS (SELECT parent, material, sum(percent) AS mass FROM pr JOIN ({PARENT_SQL}) USING (industry) GROUP BY 1, 2),
    r AS (SELECT parent, material, round(100 * mass / sum(mass) OVER (PARTITION BY parent), 6) AS percent, CAST(row_number() OVER (PARTITION BY parent ORDER BY mass DESC, material) AS INT) AS rank FROM m) SELECT * FROM r WHERE rank <= 5""")
def _(t):
    return P.blended_default(t.sql(PROFILE_SQL), t.sql(PARENT_SQL)).withColumn("percent", F.round("percent", 6))


@query("k11_build_reference", f"WITH pr AS ({PROFILE_SQL}) SELECT parent, count(DISTINCT industry) AS n_industries, count(*) AS n_entries FROM pr JOIN ({PARENT_SQL}) USING (industry) GROUP BY 1")
def _(t):
    return P.build_reference(t.sql(PROFILE_SQL), t.sql(PARENT_SQL)).drop("document")


@query("k12_expected_values", CALC_SQL + " SELECT industry, tier, value FROM e WHERE region = 'EUROPE'")
def _(t):
    return expected(t).where("region = 'EUROPE'").select("industry", "tier", "value")


@query("k13_sanity_bounds", CALC_SQL + " SELECT industry, tier, region, tons, value, co2, CASE WHEN value < lo THEN 'LOW' WHEN value > hi THEN 'HIGH' WHEN co2 < 0 THEN 'NEGATIVE_CO2' ELSE 'OK' END AS verdict FROM e JOIN (SELECT tier, avg(value) * 0.5 AS lo, avg(value) * 1.5 AS hi FROM e GROUP BY 1) USING (tier)")
def _(t):
    e = expected(t)
    return P.sanity_bounds(e, e.groupBy("tier").agg((F.avg("value") * 0.5).alias("low"), (F.avg("value") * 1.5).alias("high")))


@query("k14_enrich_price_co2", """SELECT id, CAST(CASE WHEN contains(material, 'hot bolt') THEN 150 WHEN contains(material, 'bolt') THEN 120 WHEN contains(material, 'ring') THEN 80 ELSE 0 END AS DOUBLE) AS price,
    CAST(CASE WHEN contains(material, 'hot bolt') THEN 1.5 WHEN contains(material, 'bolt') THEN 1.25 WHEN contains(material, 'ring') THEN 2 ELSE 0 END AS DOUBLE) AS co2 FROM {listings}""")
def _(t):
    e = P.enrich_price_co2(F.col("material"), (("hot_bolt", 150, 1.5), ("bolt", 120, 1.25), ("ring", 80, 2)))
    return t.listings.select("id", e["price"].alias("price"), e["co2"].alias("co2"))


VOLUME = "CASE id % 4 WHEN 0 THEN concat('about ', CAST(year AS STRING), ' barrels') WHEN 1 THEN concat(CAST(year AS STRING), '.5 gallons') WHEN 2 THEN '1,200 tons' ELSE 'unknown' END"


@query("k15_verified_volume", "SELECT id, round(CASE id % 4 WHEN 0 THEN year * CAST(0.15 AS DOUBLE) WHEN 1 THEN (year + 0.5) * CAST(0.00378 AS DOUBLE) WHEN 2 THEN 1200 ELSE 50 END, 6)::DOUBLE AS tons FROM {listings}")
def _(t):
    return t.listings.select("id", F.round(P.verified_volume(F.expr(VOLUME)), 6).alias("tons"))


@query("k16_flat_valuation", "SELECT treatment_method, CAST(sum(quantity_tons) AS DOUBLE) AS tons, CAST(sum(quantity_tons) AS DOUBLE) * 50 AS value FROM {listings} GROUP BY 1")
def _(t):
    return P.flat_valuation(t.listings, "treatment_method", "quantity_tons")


@query("k17_regional_price", """SELECT p_partkey, round(p_retailprice * m, 6) AS low, round(p_retailprice * 2 * m, 6) AS high, round(p_retailprice * 1.5 * m, 6) AS mid FROM (SELECT p_partkey, CAST(p_retailprice AS DOUBLE) AS p_retailprice, CAST(CASE WHEN p_size % 3 = 0 THEN 1.15 WHEN p_size % 3 = 1 THEN 0.85 ELSE 1 END AS DOUBLE) AS m FROM {part})""")
def _(t):
    low = F.col("p_retailprice").cast("double")
    p = P.regional_price(low, low * 2, F.expr("CASE p_size % 3 WHEN 0 THEN 'europe' WHEN 1 THEN 'mena' ELSE 'moon' END"))
    return t.part.select("p_partkey", *[F.round(p[c], 6).alias(c) for c in ("low", "high", "mid")])


@query("k18_compatibility_score", f"""WITH s AS (SELECT source_company AS company, min({sql_case('material', R.PART_RULES, 'mixed')}) AS c, max({sql_case('material', R.PART_RULES, 'mixed')}) AS d, source_country FROM {{listings}} GROUP BY 1, 4)
    SELECT company, CAST(CASE WHEN c = d THEN 0.95 ELSE 0.4 END AS DOUBLE) AS material, CAST(0.25 AS DOUBLE) AS geo, CASE WHEN c = d THEN c || ' recycling' ELSE least(c, d) || ' to ' || greatest(c, d) END AS kind FROM s""")
def _(t):
    c = classify(F.col("material"), R.PART_RULES, "mixed")
    s = t.listings.groupBy(F.col("source_company").alias("company"), "source_country").agg(F.min(c).alias("c"), F.max(c).alias("d"))
    k = P.compatibility_score(F.col("c"), F.col("d"), F.array("source_country"), F.array("source_country"))
    return s.select("company", *[k[x].alias(x) for x in ("material", "geo", "kind")])


@query("k19_industry_lookup", """SELECT 'parent' AS type, substr(p_brand, 1, 7) AS name, count(DISTINCT p_brand) AS members FROM {part} WHERE substr(p_brand, 1, 7) = 'Brand#1' GROUP BY 2
    UNION ALL SELECT 'sub', p_brand, count(DISTINCT p_name) FROM {part} WHERE p_brand = 'Brand#1' GROUP BY 2""")
def _(t):
    parents = t.part.groupBy(F.substring("p_brand", 1, 7).alias("name")).agg(F.count_distinct("p_brand").alias("members"))
    subs = t.part.groupBy(F.col("p_brand").alias("name")).agg(F.count_distinct("p_name").alias("members"))
    return P.industry_lookup(parents, subs, "brand#1")
