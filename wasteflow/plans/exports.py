"""Queries of exports (M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules as R
from ..operators import csr
from ..operators import exports as X
from ..operators import joins as J
from ..operators.classify import classify, sql_case
from ..sources.shared import written
from .catalog import query
from .facts import reports


def category():
    return classify(F.col("material"), R.PART_RULES, "other")


CAT_SQL = sql_case("material", R.PART_RULES, "other")


@query("m1_export", "SELECT company, year, co2_tons::DOUBLE AS co2_tons FROM {carbon} ORDER BY year DESC, company")
def _(t):
    return t.carbon.select("company", "year", F.col("co2_tons").cast("double").alias("co2_tons")).orderBy(F.desc("year"), "company")


@query("m2_corpus_lines", "SELECT id, printf('%s generated %.2f tons of %s in %d (%s).', source_company, quantity_tons::DOUBLE, material, year, treatment_method) AS line FROM {listings}")
def _(t):
    return X.corpus_lines(t.listings)


@query("m3_chat_examples", f"""SELECT DISTINCT material, '{{"messages":[{{"role":"user","content":"Classify: ' || material || '"}},{{"role":"assistant","content":"' || {CAT_SQL} || '"}}]}}' AS messages FROM {{listings}}""")
def _(t):
    return X.chat_examples(t.listings, category())


@query("m4_graph_edges", f"""WITH l AS (SELECT * FROM {{listings}} WHERE quantity_tons > 10) SELECT source_company AS source, 'GENERATES' AS relation, material AS target, sum(quantity_tons)::DOUBLE AS weight FROM l GROUP BY 1, 3
    UNION ALL SELECT DISTINCT material, 'IS_CATEGORY', {CAT_SQL}, 1.0::DOUBLE FROM l UNION ALL SELECT DISTINCT source_company, 'LOCATED_IN', source_location, 1.0::DOUBLE FROM l""")
def _(t):
    return X.graph_edges(t.listings, category())


@query("m5_qa_pairs", """WITH n AS (SELECT DISTINCT material, source_company FROM {listings}), k AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY material ORDER BY source_company) <= 50)
    SELECT material, 'Who generates ' || material || '?' AS question, string_agg(source_company, ', ' ORDER BY source_company) AS answer FROM k GROUP BY 1 UNION ALL SELECT material, 'How much ' || material || ' is there?', printf('%.2f tons', sum(quantity_tons)::DOUBLE) FROM {listings} GROUP BY 1""")
def _(t):
    return X.qa_pairs(t.listings)


@query("m6_listing_jsonl", """SELECT '{"id":"' || id::VARCHAR || '","material":' || CASE WHEN material IS NULL THEN 'null' ELSE '"' || material || '"' END || ',"year":"' || year::VARCHAR || '"}' AS line FROM {faulty}""")
def _(t):
    return X.listing_jsonl(t.faulty.select("id", "material", "year"))


@query("m7_portfolio_qa", """WITH p AS (SELECT material, sum(quantity_tons) AS t FROM {listings} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5), a AS (SELECT string_agg(material, ', ' ORDER BY t DESC, material) AS answer FROM p)
    SELECT industry, country, answer FROM (SELECT DISTINCT p_type AS industry FROM {part}), (SELECT n_name AS country FROM {nation}), a""")
def _(t):
    grid = t.part.select(F.col("p_type").alias("industry")).distinct().join(F.broadcast(t.nation.select(F.col("n_name").alias("country"))), F.lit(True))
    top = t.listings.groupBy("material").agg(F.sum("quantity_tons").cast("double").alias("total_tons")).orderBy(F.desc("total_tons"), "material").limit(5)
    return X.portfolio_qa(grid, top)


@query("m8_pairs_jsonl", """WITH c AS (SELECT material, consumer FROM (SELECT DISTINCT material, source_company AS consumer FROM {listings} WHERE treatment_method = 'Recycled') QUALIFY row_number() OVER (PARTITION BY material ORDER BY consumer) <= 5),
    g AS (SELECT material, string_agg('"' || consumer || '"', ',' ORDER BY consumer) AS cs FROM c GROUP BY 1)
    SELECT '{"material":"' || p.material || '","producer":"' || producer || '","consumers":[' || cs || ']}' AS line FROM (SELECT DISTINCT material, source_company AS producer FROM {listings} WHERE treatment_method LIKE '%Disposal%') p JOIN g ON p.material = g.material""")
def _(t):
    return X.pairs_jsonl(J.match_partners(t.listings))


@query("m9_csr_exports", "SELECT f AS fact, count(*) AS n FROM {listings}, (VALUES ('waste'), ('emission'), ('energy'), ('financial'), ('carbon_credit')) v(f) GROUP BY 1")
def _(t):
    # Reports that read the same are scanned once, for all tables in one pass; their facts count as often as the report comes.
    texts = reports(t, dealt=False).groupBy("text").agg(F.count("*").alias("times"))
    facts = written(csr.csr_facts(texts, key="times").select("fact", "times"), "csr-facts")
    parts = [d.agg(F.sum("times").alias("n")).where("n is not null").select(F.lit(k).alias("fact"), "n") for k, d in X.csr_exports(facts).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).unionByName(parts[4])


@query("m11_export_counts", f"WITH l AS (SELECT * FROM {{listings}} WHERE quantity_tons > 10) SELECT 'corpus' AS name, count(*) AS n FROM {{listings}} UNION ALL SELECT 'edges', (SELECT count(*) FROM (SELECT DISTINCT source_company, material FROM l)) + (SELECT count(*) FROM (SELECT DISTINCT material, {CAT_SQL} FROM l)) + (SELECT count(*) FROM (SELECT DISTINCT source_company, source_location FROM l))")
def _(t):
    n = lambda name, d: d.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
    return n("corpus", X.corpus_lines(t.listings)).unionByName(n("edges", X.graph_edges(t.listings, category())))
