"""Queries of projections, filters, joins and keyed writes (B, F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import names
from ..sources.shared import new_folder
from ..sources.versioned import VersionedTable
from .catalog import best_alike_sql, query


@query("b1_clean_filter", "SELECT id, material, quantity_tons::DOUBLE AS quantity_tons, year FROM {faulty} WHERE material <> '' AND quantity_tons > 0 AND year BETWEEN 1970 AND 2025")
def _(t):
    return A.clean_filter(t.faulty).select("id", "material", F.col("quantity_tons").cast("double").alias("quantity_tons"), "year")


@query("b2_full_entries", "SELECT count(*) AS n FROM {faulty} WHERE material IS NOT NULL AND source_company IS NOT NULL AND year IS NOT NULL AND quantity_tons IS NOT NULL")
def _(t):
    return A.full_entries(t.faulty, ["material", "source_company", "year", "quantity_tons"]).agg(F.count("*").alias("n"))


@query("b3_keyword_filter", "SELECT id, material FROM {listings} WHERE material ILIKE '%bolt%' OR material ILIKE '%Ring%'")
def _(t):
    return A.keyword_filter(t.listings, "material", ["bolt", "Ring"]).select("id", "material")


@query("b4_numeric_or_short", "SELECT o_orderkey, regexp_matches(CAST(o_orderkey AS VARCHAR), '^[0-9]+$') OR length(CAST(o_orderkey AS VARCHAR)) < 2 AS suspicious, regexp_matches(o_orderpriority, '^[0-9]+$') OR length(o_orderpriority) < 2 AS suspicious_text FROM {orders}")
def _(t):
    return t.orders.select("o_orderkey", A.numeric_or_short(F.col("o_orderkey").cast("string")).alias("suspicious"), A.numeric_or_short(F.col("o_orderpriority")).alias("suspicious_text"))


@query("b5_source_label", "SELECT label, count(*) AS n FROM (SELECT CASE WHEN source_quote LIKE 'In 1992%' THEN 'US' WHEN source_quote LIKE '%red bolt%' THEN 'EU' ELSE 'other' END AS label FROM {listings}) GROUP BY 1")
def _(t):
    return t.listings.groupBy(A.source_label(F.col("source_quote"), [("In 1992%", "US"), ("%red bolt%", "EU")]).alias("label")).agg(F.count("*").alias("n"))


@query("b6_country_or_location_tail", "SELECT id, CASE WHEN id % 2 = 0 THEN source_country ELSE split_part(source_location, ', ', 2) END AS place FROM {listings}")
def _(t):
    return t.listings.select("id", A.country_or_tail(F.expr("CASE WHEN id % 2 = 0 THEN source_country END"), F.col("source_location")).alias("place"))


@query("b7_column_density", "SELECT 'material' AS \"column\", 100.0::DOUBLE * count(material) / count(*) AS pct FROM {faulty} UNION ALL SELECT 'year', 100.0::DOUBLE * count(year) / count(*) FROM {faulty}")
def _(t):
    return A.column_density(t.faulty.select("material", "year"))


@query("b8_coerce_upload_record", "SELECT id, CASE WHEN id % 3 = 0 THEN 50.0 WHEN id % 3 = 1 THEN 50.0 ELSE quantity_tons END::DOUBLE AS quantity, CASE WHEN id % 2 = 0 THEN 0 ELSE year END::DOUBLE AS price, id % 5 = 0 AS verified FROM {listings}")
def _(t):
    df = t.listings.selectExpr("id", "CASE id % 3 WHEN 0 THEN 'n/a' WHEN 1 THEN '0' ELSE CAST(quantity_tons AS STRING) END AS quantity", "CASE WHEN id % 2 = 1 THEN CAST(year AS STRING) END AS price", "CASE WHEN id % 5 = 0 THEN 'True' ELSE 'no' END AS verified")
    return A.coerce_upload(df, {"quantity": 50, "price": 0}, ["verified"])


@query("b9_require_columns", "SELECT material, year, id FROM {listings}")
def _(t):
    return A.require_columns(t.listings.select("id", "material", "year"), ["material", "year"])


@query("b10_clip_strings", "SELECT id, substr(source_quote, 1, 20) AS source_quote, substr(material, 1, 5) AS material FROM {listings}")
def _(t):
    return A.clip_strings(t.listings.select("id", "source_quote", "material"), {"source_quote": 20, "material": 5})


@query("b11_profile_components", "SELECT id, material || ', ' || source_country AS names, 1::BIGINT AS n_hazards FROM {listings}")
def _(t):
    doc = F.to_json(F.struct(F.array(F.struct(F.col("material").alias("name")), F.struct(F.col("source_country").alias("name"))).alias("composition"), F.array(F.lit("dust")).alias("hazards")))
    p = A.profile_components(doc)
    return t.listings.select("id", p["names"].alias("names"), F.size(p["hazards"]).cast("long").alias("n_hazards"))


VALUED = """SELECT l.id, l.material, m.material_type_id, CAST(round(quantity_tons * price_per_ton_usd, 2) AS DOUBLE) AS estimated_value_usd FROM {listings} l LEFT JOIN {mapping} m ON lower(l.material) = lower(m.waste_material) LEFT JOIN {valuations} v ON m.material_type_id = v.material_type_id WHERE quantity_tons > 0"""


def valued(df):
    return df.select("id", "material", "material_type_id", F.col("estimated_value_usd").cast("double").alias("estimated_value_usd"))


@query("f1_valued_view", VALUED)
def _(t):
    return valued(J.valued_view(t.listings, t.mapping, t.valuations))


@query("f2_priced_listings", VALUED + " AND price_per_ton_usd IS NOT NULL")
def _(t):
    return valued(J.priced_listings(t.listings, t.mapping, t.valuations))


@query("f3_with_document", "SELECT l.id, d.source AS document_source FROM {listings} l LEFT JOIN {docs} d ON l.document_id = d.id")
def _(t):
    return J.with_document(t.listings, t.docs).select("id", "document_source")


@query("f4_orphans", "SELECT id, document_id FROM {listings} WHERE document_id NOT IN (SELECT id FROM {docs})")
def _(t):
    return J.orphans(t.listings, t.docs).select("id", "document_id")


@query("f5_adopt_orphans", "SELECT id, CASE WHEN document_id IN (SELECT id FROM {docs}) THEN document_id ELSE -1 END::BIGINT AS document_id FROM {listings}")
def _(t):
    return J.adopt_orphans(t.listings, t.docs, -1).select("id", F.col("document_id").cast("long").alias("document_id"))


@query("f6_purge_orphans", "SELECT id FROM {listings} WHERE document_id IN (SELECT id FROM {docs})")
def _(t):
    return J.purge_orphans(t.listings, t.docs).select("id")


@query("f7_delete_by_source", "SELECT id FROM {listings} WHERE document_id NOT IN (SELECT id FROM {docs} WHERE source = 'src1')")
def _(t):
    return J.delete_by_source(t.listings, t.docs, "src1").select("id")


@query("f8_contains_join", """WITH n AS (SELECT DISTINCT material AS name FROM {listings}), r AS (SELECT min(p_partkey) AS o, split_part(p_name, ' ', 2) AS k, split_part(p_name, ' ', 2) AS v FROM {part} GROUP BY 2)
    SELECT name, coalesce((SELECT v FROM r WHERE contains(name, k) OR contains(k, name) ORDER BY name <> k, o, k LIMIT 1), 'Unknown') AS value FROM n""")
def _(t):
    ref = t.part.groupBy(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("k")).agg(F.min("p_partkey").alias("o")).withColumn("v", F.col("k"))
    return names.contains_join(t.listings, ref, "material", "k", "v", "o")


@query("f9_fuzzy_join", f"""WITH n AS (SELECT DISTINCT split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1) AS name FROM {{part}}), r AS (SELECT DISTINCT p_name AS match FROM {{part}}),
    {best_alike_sql(">")} SELECT name, match, score FROM best""")
def _(t):
    swapped = t.part.select(F.concat_ws(" ", F.split_part("p_name", F.lit(" "), F.lit(2)), F.split_part("p_name", F.lit(" "), F.lit(1))).alias("name"))
    return names.fuzzy_join(swapped, t.part.select(F.col("p_name").alias("ref")), "name", "ref")


KNOWN = """WITH w AS (SELECT lower(trim(company)) AS k, keyword, min(ord) AS o FROM {knowledge} GROUP BY 1, 2), w5 AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY k ORDER BY o) <= 5),
    c AS (SELECT lower(trim(company)) AS k, context, ord FROM {knowledge} QUALIFY row_number() OVER (PARTITION BY lower(trim(company)) ORDER BY ord) <= 3),
    p AS (SELECT k, keywords, contexts FROM (SELECT k, string_agg(keyword, ', ' ORDER BY o) AS keywords FROM w5 GROUP BY 1) JOIN (SELECT k, string_agg(context, ' | ' ORDER BY ord) AS contexts FROM c GROUP BY 1) USING (k))"""


@query("f10_knowledge_enrich", KNOWN + " SELECT id, keywords, contexts FROM {listings} LEFT JOIN p ON lower(trim(source_company)) = k")
def _(t):
    return J.knowledge_enrich(t.listings.select("id", "source_company"), t.knowledge).select("id", "keywords", "contexts")


@query("f11_knowledge_profile", KNOWN + " SELECT k, keywords, contexts FROM p")
def _(t):
    return J.knowledge_profile(t.knowledge).drop("first")


@query("f12_match_partners", """WITH c AS (SELECT material, consumer FROM (SELECT DISTINCT material, source_company AS consumer FROM {listings} WHERE treatment_method = 'Recycled' AND quantity_tons > 0) QUALIFY row_number() OVER (PARTITION BY material ORDER BY consumer) <= 5)
    SELECT p.material, producer, consumer FROM (SELECT DISTINCT material, source_company AS producer FROM {listings} WHERE treatment_method LIKE '%Disposal%' AND quantity_tons > 0) p JOIN c ON p.material = c.material""")
def _(t):
    return J.match_partners(t.listings)


@query("f13_symbiosis_pairs", """WITH r AS (SELECT material, row_number() OVER (ORDER BY n DESC, material) AS rn FROM (SELECT material, count(*) AS n FROM {listings} GROUP BY 1) ORDER BY n DESC, material LIMIT 500)
    SELECT a.material AS material_a, b.material AS material_b FROM r a JOIN r b ON b.rn > a.rn AND b.rn <= a.rn + 19""")
def _(t):
    g = t.listings.groupBy("material").agg(F.count("*").alias("n"))
    return J.symbiosis_pairs(A.neighbour_rank(g, [F.desc("n"), "material"], 500).select("material", "rn")).select("material_a", "material_b")


@query("f14_facility_merge", "SELECT l_orderkey, l_linenumber, l_partkey, facility_name, country FROM {lineitem} JOIN {facility} ON l_suppkey = facility_id")
def _(t):
    return t.lineitem.join(t.facility, F.col("l_suppkey") == F.col("facility_id")).select("l_orderkey", "l_linenumber", "l_partkey", "facility_name", "country")


@query("f15_semi_join", "SELECT c_custkey FROM {customer} WHERE c_custkey IN (SELECT o_custkey FROM {orders} WHERE o_totalprice > 100000)")
def _(t):
    return t.customer.join(t.orders.where("o_totalprice > 100000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


HAVERSINE = "2 * 6371.0 * asin(least(sqrt(pow(sin(radians(lat - 10) / 2), 2) + cos(radians(10)) * cos(radians(lat)) * pow(sin(radians(lon - 20) / 2), 2)), 1.0))"


@query("f16_radius_search", f"SELECT id, round({HAVERSINE}, 3) AS distance_km FROM {{listings}} WHERE {HAVERSINE} <= 3000")
def _(t):
    return J.radius_search(t.listings, 10, 20, 3000).select("id", F.round("distance_km", 3).alias("distance_km"))


APART = "2 * 6371.0 * asin(least(sqrt(pow(sin(radians(p.lat - c.lat) / 2), 2) + cos(radians(c.lat)) * cos(radians(p.lat)) * pow(sin(radians(p.lon - c.lon) / 2), 2)), 1.0))"
PLACE = "CAST(({key} * 7 % 181) - 90 AS DOUBLE) AS lat, CAST(({key} * {step} % 360) - 180 AS DOUBLE) AS lon"


@query("f16_radius_join", f"""WITH p AS (SELECT s_suppkey AS id, {PLACE.format(key="s_suppkey", step=11)} FROM {{supplier}}), c AS (SELECT c_custkey AS centre_id, {PLACE.format(key="c_custkey", step=17)} FROM {{customer}})
    SELECT centre_id, id, round({APART}, 3) AS distance_km FROM p JOIN c ON {APART} <= 400""")
def _(t):
    p, c = t.sql(f"SELECT s_suppkey AS id, {PLACE.format(key='s_suppkey', step=11)} FROM {{supplier}}"), t.sql(f"SELECT c_custkey AS centre_id, {PLACE.format(key='c_custkey', step=17)} FROM {{customer}}")
    return J.radius_join(p, c, 400).select("centre_id", "id", F.round("distance_km", 3).alias("distance_km"))


@query("f17_industry_location_grid", "SELECT industry, country FROM (SELECT DISTINCT p_type AS industry FROM {part}) CROSS JOIN (SELECT n_name AS country FROM {nation})")
def _(t):
    return t.part.select(F.col("p_type").alias("industry")).distinct().join(F.broadcast(t.nation.select(F.col("n_name").alias("country"))), F.lit(True))


@query("f18_upsert", """WITH s AS (SELECT c_custkey + 500 AS c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name || ' new' END AS c_name FROM {customer} QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY c_custkey) = 1)
    SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, coalesce(s.c_name, t.c_name) AS c_name FROM {customer} t FULL JOIN s ON t.c_custkey = s.c_custkey""")
def _(t):
    source = t.customer.selectExpr("c_custkey + 500 AS c_custkey", "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE concat(c_name, ' new') END AS c_name", "c_custkey AS v")
    return J.upsert(t.customer.select("c_custkey", "c_name"), source, ["c_custkey"], "v", "coalesce")


@query("f18_versioned_upsert", """WITH s AS (SELECT c_custkey + 500 AS c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name || ' new' END AS c_name FROM {customer})
    SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, coalesce(s.c_name, t.c_name) AS c_name, 3::BIGINT AS version FROM (SELECT c_custkey, c_name FROM {customer} UNION ALL SELECT -1, 'appended') t FULL JOIN s ON t.c_custkey = s.c_custkey""")
def _(t):
    """A table written, appended to and upserted, each as a version that readers see whole."""
    table = VersionedTable(t.spark, new_folder(t.spark, "customers"))
    rows = t.customer.select("c_custkey", "c_name")
    table.overwrite(rows)
    table.append(rows.limit(1).select(F.lit(-1).cast(dict(rows.dtypes)["c_custkey"]).alias("c_custkey"), F.lit("appended").alias("c_name")))
    source = t.customer.selectExpr("c_custkey + 500 AS c_custkey", "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE concat(c_name, ' new') END AS c_name", "c_custkey AS v")
    version = table.upsert(source, ["c_custkey"], "v", "coalesce")
    return table.read(version).withColumn("version", F.lit(version).cast("long"))
