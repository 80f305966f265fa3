"""Queries of aggregates, ranking and set operations (G, H, I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules as R
from ..operators import aggregates as A
from ..operators.classify import classify, sql_case
from .catalog import query

CAT = sql_case("material", R.PART_RULES, "other")
def tons():
    return F.sum("quantity_tons").cast("double")




@query("g1_pipeline_stats_view", "SELECT source, status, count(*) AS n, round(sum(size_bytes), 2)::DOUBLE AS total_bytes, min(ingested_at) AS first_at, max(ingested_at) AS last_at FROM {queue} GROUP BY 1, 2")
def _(t):
    return A.grouped(t.queue, ["source", "status"], n=F.count("*"), total_bytes=F.round(F.sum(F.col("size_bytes").cast("double")), 2), first_at=F.min("ingested_at"), last_at=F.max("ingested_at"))


@query("g2_material_summary_view", "SELECT material, material_subcategory, count(*) AS n, sum(quantity_tons)::DOUBLE AS tons, round(avg(extraction_confidence::DOUBLE), 9) AS confidence FROM {listings} GROUP BY 1, 2")
def _(t):
    return A.grouped(t.listings, ["material", "material_subcategory"], n=F.count("*"), tons=tons(), confidence=F.round(F.avg(F.col("extraction_confidence").cast("double")), 9))


@query("g3_company_emissions_view", "SELECT company, year, sum(co2_tons)::DOUBLE AS co2_tons FROM {carbon} GROUP BY 1, 2 ORDER BY 1, 2")
def _(t):
    return A.grouped(t.carbon, ["company", "year"], co2_tons=F.sum("co2_tons").cast("double")).orderBy("company", "year")


@query("g4_global_counts", """SELECT (SELECT count(*) FROM {events}) AS n_documents, (SELECT count(*) FROM {queue} WHERE status = 'pending') AS n_pending, (SELECT count(*) FROM {listings}) AS n_listings,
    (SELECT count(*) FROM {carbon}) AS n_carbon, (SELECT count(*) FROM {exchanges}) AS n_exchanges, (SELECT count(DISTINCT source_company) FROM {listings}) AS n_companies""")
def _(t):
    one = t.queue.agg(F.count("*").alias("n_documents"), F.count_if(F.col("status") == "pending").alias("n_pending"))
    for d in (t.listings.agg(F.count("*").alias("n_listings"), F.count_distinct("source_company").alias("n_companies")), t.carbon.agg(F.count("*").alias("n_carbon")), t.exchanges.agg(F.count("*").alias("n_exchanges"))):
        one = one.join(F.broadcast(d), F.lit(True))
    return one


@query("g5_dataset_counts", "SELECT count(*) AS n, count(DISTINCT material) AS n_material, count(DISTINCT source_company) AS n_source_company, count(DISTINCT source_location) AS n_source_location FROM {listings}")
def _(t):
    return A.distinct_counts(t.listings, ["material", "source_company", "source_location"])


@query("g6_treatment_breakdown", "SELECT treatment_method, count(*) AS n, round(sum(quantity_tons), 2)::DOUBLE AS tons FROM {listings} GROUP BY 1")
def _(t):
    return A.grouped(t.listings, ["treatment_method"], n=F.count("*"), tons=F.round(F.sum("quantity_tons"), 2).cast("double"))


def firsts_sql(value: str, n: int) -> str:
    return f"SELECT material, string_agg(v, '|' ORDER BY v) AS s FROM (SELECT *, row_number() OVER (PARTITION BY material ORDER BY v) AS r FROM (SELECT DISTINCT material, {value} AS v FROM f WHERE {value} IS NOT NULL)) WHERE r <= {n} GROUP BY 1"


@query("g7_material_profile", f"""WITH f AS (SELECT * FROM {{faulty}} WHERE material <> ''), g AS (SELECT material, count(*) AS n, round(avg(quantity_tons::DOUBLE), 6) AS avg_tons, sum(quantity_tons)::DOUBLE AS total_tons, min(year) AS first_year, max(year) AS last_year FROM f GROUP BY 1 HAVING count(*) >= 2 ORDER BY total_tons DESC NULLS LAST, material LIMIT 2000)
    SELECT g.*, coalesce(c.s, '') AS companies, coalesce(l.s, '') AS locations, coalesce(t.s, '') AS treatments FROM g LEFT JOIN ({firsts_sql('substr(source_company, 1, 50)', 10)}) c USING (material) LEFT JOIN ({firsts_sql('source_location', 5)}) l USING (material) LEFT JOIN ({firsts_sql('treatment_method', 100)}) t USING (material)""")
def _(t):
    return A.material_profile(t.faulty).withColumn("avg_tons", F.round("avg_tons", 6))


@query("g8_string_agg_profile", "SELECT material, material_subcategory, sum(quantity_tons)::DOUBLE AS total_tons, round(avg(quantity_tons::DOUBLE), 6) AS avg_tons, string_agg(DISTINCT treatment_method, ', ' ORDER BY treatment_method) AS treatments FROM {faulty} JOIN (SELECT id, material_subcategory FROM {listings}) USING (id) WHERE material IS NOT NULL GROUP BY 1, 2 HAVING sum(quantity_tons) > 0")
def _(t):
    df = t.faulty.where("material is not null").join(t.listings.select("id", "material_subcategory"), "id")
    return A.string_agg_profile(df, ["material", "material_subcategory"]).withColumn("avg_tons", F.round("avg_tons", 6))


@query("g9_value_by_category", f"""SELECT {sql_case('l.material', R.PART_RULES, 'other')} AS category, count(*) AS listings, count(DISTINCT l.material) AS materials, sum(quantity_tons)::DOUBLE AS total_tons, sum(quantity_tons * price_per_ton_usd)::DOUBLE AS value_usd
    FROM {{listings}} l JOIN {{mapping}} m ON lower(l.material) = lower(m.waste_material) JOIN {{valuations}} v ON m.material_type_id = v.material_type_id WHERE quantity_tons > 0 GROUP BY 1""")
def _(t):
    return A.value_by_category(t.listings, t.mapping, t.valuations, classify(F.col("material"), R.PART_RULES, "other"))


@query("g10_value_totals", "SELECT count(*) AS n, sum(quantity_tons)::DOUBLE AS tons, sum(quantity_tons * price_per_ton_usd)::DOUBLE AS value_usd FROM {listings} l JOIN {valuations} v ON l.material = v.material_type_id")
def _(t):
    per = A.grouped(t.listings, ["material"], n=F.count("*"), tons=F.sum("quantity_tons")).join(t.valuations, F.col("material") == F.col("material_type_id"))
    return per.agg(F.sum("n").alias("n"), F.sum("tons").cast("double").alias("tons"), F.sum(F.col("tons") * F.col("price_per_ton_usd")).cast("double").alias("value_usd"))


@query("g11_distinct_years_per_company", "SELECT round(avg(n), 6) AS avg_years FROM (SELECT source_company, count(DISTINCT year) AS n FROM {listings} GROUP BY 1)")
def _(t):
    return A.distinct_years(t.listings, "source_company", "year").agg(F.round(F.avg("n_years"), 6).alias("avg_years"))


@query("g12_long_history", "SELECT company, count(DISTINCT year) AS n_years FROM {carbon} GROUP BY 1 HAVING count(DISTINCT year) >= 5")
def _(t):
    return A.distinct_years(t.carbon, "company", "year").where("n_years >= 5")


@query("g13_region_drift", "SELECT count(*) FILTER (n > 1) AS drifting, count(*) AS companies, 100.0::DOUBLE * count(*) FILTER (n > 1) / count(*) AS pct FROM (SELECT target_company, count(DISTINCT source_company) AS n FROM {exchanges} GROUP BY 1)")
def _(t):
    g = t.exchanges.groupBy("target_company").agg(F.count_distinct("source_company").alias("n"))
    drift = F.count_if(F.col("n") > 1)
    return g.agg(drift.alias("drifting"), F.count("*").alias("companies"), F.try_divide(100.0 * drift, F.count("*")).alias("pct"))


@query("g14_quantity_stats", "SELECT round(avg(quantity_tons::DOUBLE), 6) AS mean, median(quantity_tons::DOUBLE) AS median, min(quantity_tons)::DOUBLE AS low, max(quantity_tons)::DOUBLE AS high, count(*) FILTER (quantity_tons < 0) AS negatives, count(*) FILTER (quantity_tons > 1000000) AS extremes FROM {faulty}")
def _(t):
    return A.quantity_stats(t.faulty, "quantity_tons").withColumn("mean", F.round("mean", 6))


@query("g15_coverage_by_category", f"SELECT {CAT} AS category, count(*) AS n, count(m.material_type_id) AS priced, sum(quantity_tons)::DOUBLE AS tons FROM {{listings}} LEFT JOIN {{mapping}} m ON material = m.material_type_id GROUP BY 1 ORDER BY n DESC, category LIMIT 10")
def _(t):
    j = t.listings.join(t.mapping, F.col("material") == F.col("material_type_id"), "left")
    return j.groupBy(classify(F.col("material"), R.PART_RULES, "other").alias("category")).agg(F.count("*").alias("n"), F.count("material_type_id").alias("priced"), tons().alias("tons")).orderBy(F.desc("n"), "category").limit(10)


@query("g16_tons_priced_unpriced", "SELECT (sum(quantity_tons) FILTER (m.material_type_id IS NOT NULL))::DOUBLE AS priced, (sum(quantity_tons) FILTER (m.material_type_id IS NULL))::DOUBLE AS unpriced, round(100 * (sum(quantity_tons) FILTER (m.material_type_id IS NOT NULL))::DOUBLE / sum(quantity_tons)::DOUBLE, 6) AS pct FROM {listings} LEFT JOIN {mapping} m ON material = m.material_type_id")
def _(t):
    j = t.listings.join(t.mapping, F.col("material") == F.col("material_type_id"), "left")
    q, there = F.col("quantity_tons"), F.col("material_type_id").isNotNull()
    priced = F.sum(F.when(there, q)).cast("double")
    return j.agg(priced.alias("priced"), F.sum(F.when(~there, q)).cast("double").alias("unpriced"), F.round(F.try_divide(100 * priced, tons()), 6).alias("pct"))


@query("g17_conditional_count", "SELECT count(*) FILTER (source_location <> 'Unknown') AS valid, count(*) FILTER (source_location = 'Unknown') AS unknown FROM {faulty}")
def _(t):
    return t.faulty.agg(F.count_if(F.col("source_location") != "Unknown").alias("valid"), F.count_if(F.col("source_location") == "Unknown").alias("unknown"))


@query("g18_industry_breadth", "SELECT source_industry, count(*) AS n, count(DISTINCT material) AS materials FROM {listings} GROUP BY 1 ORDER BY materials DESC, n DESC, source_industry LIMIT 10")
def _(t):
    return A.grouped(t.listings, ["source_industry"], n=F.count("*"), materials=F.count_distinct("material")).orderBy(F.desc("materials"), F.desc("n"), "source_industry").limit(10)


@query("g19_distinct_key_count", "SELECT count(*) AS n, count(DISTINCT {{'a': material, 'b': year, 'c': source_company}}) AS n_keys, 100.0::DOUBLE * (count(*) - count(DISTINCT {{'a': material, 'b': year, 'c': source_company}})) / count(*) AS dup_pct FROM {faulty}".replace("{{", "struct_pack(").replace("}}", ")").replace("'a': ", "a := ").replace("'b': ", "b := ").replace("'c': ", "c := "))
def _(t):
    return A.distinct_key_count(t.faulty, ["material", "year", "source_company"])


@query("g20_value_counts", "SELECT material, count(*) AS count FROM {listings} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def _(t):
    return A.value_counts(t.listings, "material", 10)


@query("g21_token_estimate", "SELECT sum(length(concat(material, source_quote)))::BIGINT AS chars, sum(length(concat(material, source_quote))) / 4.0::DOUBLE AS tokens FROM {listings}")
def _(t):
    return A.token_estimate(t.listings, ["material", "source_quote"])


@query("g22_tier_summary", "SELECT CASE WHEN quantity_tons < 20 THEN 'small' ELSE 'large' END AS tier, round(avg(quantity_tons::DOUBLE), 6) AS mean, min(quantity_tons)::DOUBLE AS low, max(quantity_tons)::DOUBLE AS high FROM {listings} GROUP BY 1")
def _(t):
    q = F.col("quantity_tons").cast("double")
    return t.listings.groupBy(F.when(q < 20, "small").otherwise("large").alias("tier")).agg(F.round(F.avg(q), 6).alias("mean"), F.min(q).alias("low"), F.max(q).alias("high"))


@query("g23_category_distribution", f"""WITH d AS (SELECT DISTINCT material AS v, {CAT} AS label FROM {{listings}}), r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY v) AS rn FROM d)
    SELECT label, count(*) AS n, string_agg(CASE WHEN rn <= 2 THEN v END, ', ' ORDER BY v) AS samples, 100.0::DOUBLE * count(*) / (SELECT count(*) FROM d) AS pct FROM r GROUP BY 1""")
def _(t):
    return A.category_distribution(t.listings, "material", classify(F.col("v"), R.PART_RULES, "other"))


@query("g24_records_per_document", "SELECT round(count(*)::DOUBLE / count(DISTINCT document_id), 6) AS per_document, count(DISTINCT document_id) * 8 AS in_eight_hours FROM {listings}")
def _(t):
    d = F.count_distinct("document_id")
    return t.listings.agg(F.round(F.count("*") / d, 6).alias("per_document"), (d * 8).alias("in_eight_hours"))


@query("g25_training_volume", "SELECT count(DISTINCT material) * 6 AS pairs, count(DISTINCT source_industry) * count(DISTINCT source_country) * 10 AS routes FROM {listings}")
def _(t):
    return t.listings.agg((F.count_distinct("material") * 6).alias("pairs"), (F.count_distinct("source_industry") * F.count_distinct("source_country") * 10).alias("routes"))


@query("g26_queue_counts", "SELECT source, status, count(*) AS n, count(*) FILTER (status = 'processing') AS in_progress FROM {queue} GROUP BY 1, 2")
def _(t):
    return A.grouped(t.queue, ["source", "status"], n=F.count("*"), in_progress=F.count_if(F.col("status") == "processing"))


@query("h1_distinct_on", "SELECT id, material, source_company, year FROM {faulty} QUALIFY row_number() OVER (PARTITION BY material, source_company, year, quantity_tons ORDER BY id) = 1")
def _(t):
    return A.distinct_on(t.faulty, ["material", "source_company", "year", "quantity_tons"], ["id"]).select("id", "material", "source_company", "year")


@query("h2_cumulative_share", "WITH g AS (SELECT material, count(*) AS count FROM {listings} GROUP BY 1), top AS (SELECT * FROM g ORDER BY count DESC, material LIMIT 50) SELECT material, count, (sum(count) OVER (ORDER BY count DESC, material ROWS UNBOUNDED PRECEDING))::BIGINT AS running, round(100.0::DOUBLE * (sum(count) OVER (ORDER BY count DESC, material ROWS UNBOUNDED PRECEDING)) / (SELECT sum(count) FROM g), 6) AS running_pct FROM top")
def _(t):
    return A.cumulative_share(t.listings, "material", 50).withColumn("running_pct", F.round("running_pct", 6))


@query("h3_neighbour_rank", "SELECT id, CAST(row_number() OVER (ORDER BY quantity_tons DESC, id) AS INT) AS rn FROM {listings} ORDER BY quantity_tons DESC, id LIMIT 500")
def _(t):
    return A.neighbour_rank(t.listings, [F.desc("quantity_tons"), "id"], 500).select("id", "rn")


@query("h4_top_n_by", "SELECT id, quantity_tons::DOUBLE AS quantity_tons FROM {listings} ORDER BY quantity_tons DESC, id LIMIT 20")
def _(t):
    return t.listings.orderBy(F.desc("quantity_tons"), "id").limit(20).select("id", F.col("quantity_tons").cast("double").alias("quantity_tons"))


@query("h5_top_n_per_group", "SELECT id, source_country, CAST(row_number() OVER (PARTITION BY source_country ORDER BY quantity_tons DESC, id) AS INT) AS rn FROM {listings} QUALIFY rn <= 3")
def _(t):
    return A.top_n_per_group(t.listings, "source_country", [F.desc("quantity_tons"), "id"], 3).select("id", "source_country", "rn")


@query("h6_sample_rows", "SELECT id, material FROM {listings} ORDER BY md5(id::VARCHAR || ':42'), id LIMIT 100")
def _(t):
    return A.sample_rows(t.listings, "id", 100).select("id", "material")


@query("h7_top_contributor_skew", "SELECT arg_max(source_company, (n, source_company)) AS top, max(n) AS n, 100.0::DOUBLE * max(n) / sum(n) AS pct, CASE WHEN 100.0 * max(n) / sum(n) > 50 THEN 'WARN' ELSE 'OK' END AS status FROM (SELECT source_company, count(*) AS n FROM {listings} GROUP BY 1)")
def _(t):
    return A.top_contributor(t.listings, "source_company")


@query("h8_year_histogram", "SELECT year, count(*) AS n FROM {listings} GROUP BY 1 ORDER BY 1 DESC")
def _(t):
    return A.grouped(t.listings, ["year"], n=F.count("*")).orderBy(F.desc("year"))


@query("h9_bounded_per_category", f"WITH p AS (SELECT material, {CAT} AS category, sum(quantity_tons)::DOUBLE AS tons FROM {{listings}} GROUP BY 1, 2), k AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY category ORDER BY tons DESC, material) <= 3) SELECT * FROM k ORDER BY tons DESC, material LIMIT 5")
def _(t):
    p = t.listings.groupBy("material", classify(F.col("material"), R.PART_RULES, "other").alias("category")).agg(tons().alias("tons"))
    return A.bounded_per_category(p, "category", [F.desc("tons"), "material"])


@query("i1_unified_export", """SELECT 'waste' AS record_type, material || ' ' || treatment_method AS content, source_company, year FROM {listings} UNION ALL SELECT 'carbon', 'CO2 ' || co2_tons::VARCHAR, company, year FROM {carbon}
    UNION ALL SELECT 'exchange', source_company || ' to ' || target_company, source_company, year FROM {exchanges}""")
def _(t):
    return A.unified_export(t.listings, t.carbon, t.exchanges)


@query("i2_company_overlap", "SELECT (SELECT count(*) FROM (SELECT source_company FROM {listings} INTERSECT SELECT company FROM {knowledge})) AS exact, (SELECT count(*) FROM (SELECT lower(trim(source_company)) FROM {listings} INTERSECT SELECT lower(trim(company)) FROM {knowledge})) AS loose")
def _(t):
    return A.overlap(t.listings, t.knowledge, "source_company", "company")


@query("i3_union_of_companies", "SELECT count(*) AS n FROM (SELECT source_company FROM {listings} UNION SELECT company FROM {carbon})")
def _(t):
    return A.union_count(t.listings, t.carbon, "source_company", "company")


@query("i4_distinct_values", "SELECT DISTINCT material FROM {listings}")
def _(t):
    return t.listings.select("material").distinct()
