"""Queries of fact extraction and validation (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import csr
from ..operators import facts as E
from .catalog import query
from .views import dealt_quotes


@query("e1_detect_schema", """SELECT doc_id, CASE WHEN regexp_matches(lower(text), 'co2|carbon|emission|ghg|greenhouse') THEN 'carbon_emission' WHEN regexp_matches(lower(text), 'symbiosis|exchange|industrial park|eco-park') THEN 'symbiosis_exchange' ELSE 'waste_listing' END AS schema FROM {documents}""")
def _(t):
    return t.documents.select("doc_id", E.detect_schema(F.col("text")).alias("schema"))


@query("e2_extract_waste", "SELECT id, source_quote, quantity_tons::INT::DOUBLE AS quantity, 'tonnes' AS unit, year FROM {listings}")
def _(t):
    w = E.extract_waste(F.col("source_quote"))
    return dealt_quotes(t).select("id", w["source_quote"].alias("source_quote"), w["quantity"].alias("quantity"), w["unit"].alias("unit"), w["year"].alias("year"))


@query("e3_extract_carbon", "SELECT o_orderkey, 'In ' || year(o_orderdate)::VARCHAR || ' we emitted 1,' || (100 + o_orderkey % 900)::VARCHAR || ' million tonnes of CO2 in all.' AS source_quote, (1100 + o_orderkey % 900)::DOUBLE * 1000000 AS co2_tons, CASE WHEN year(o_orderdate) >= 2000 THEN year(o_orderdate)::INT END AS year FROM {orders}")
def _(t):
    text = F.expr("concat('In ', year(o_orderdate), ' we emitted 1,', 100 + o_orderkey % 900, ' million tonnes of CO2 in all. More text.')")
    c = E.extract_carbon(text)
    return t.orders.select("o_orderkey", c["source_quote"].alias("source_quote"), c["co2_tons"].alias("co2_tons"), c["year"].alias("year"))


@query("e4_extract_exchange", "SELECT id, CASE WHEN id % 2 = 0 THEN 'Kalundborg' END AS eco_park, CASE WHEN id % 2 = 0 THEN 'Kalundborg did it.' END AS source_quote, quantity_tons::INT::DOUBLE AS volume, year FROM {listings}")
def _(t):
    e = E.extract_exchange(F.concat("source_quote", F.expr("CASE WHEN id % 2 = 0 THEN ' Kalundborg did it.' ELSE '' END")))
    return t.listings.select("id", *[e[c].alias(c) for c in ("eco_park", "source_quote", "volume", "year")])


WASTE_SQL = """array_to_string(list_sort(list_filter([CASE WHEN material IS NULL OR length(trim(material)) NOT BETWEEN 2 AND 100 THEN 'material' END, CASE WHEN quantity_tons IS NULL OR quantity_tons <= 0 OR quantity_tons > 100000000 THEN 'quantity' END,
    CASE WHEN year IS NULL OR year NOT BETWEEN 1970 AND 2026 THEN 'year' END, CASE WHEN coalesce(length(source_quote), 0) < 10 THEN 'quote' END, CASE WHEN extraction_confidence IS NULL OR extraction_confidence NOT BETWEEN 0 AND 1 THEN 'confidence' END], lambda x: x IS NOT NULL)), ',')"""


@query("e5_validate_waste", f"SELECT id, {WASTE_SQL} AS violations FROM {{faulty}}")
def _(t):
    return E.validate_waste(t.faulty).select("id", F.array_join("violations", ",").alias("violations"))


@query("e6_validate_carbon", "SELECT company, year, CASE WHEN co2_tons <= 0 OR co2_tons > 10000000000 THEN 'co2' ELSE '' END AS violations FROM (SELECT company, year, CASE WHEN year % 3 = 0 THEN -co2_tons ELSE co2_tons END AS co2_tons FROM {carbon})")
def _(t):
    c = t.carbon.withColumn("co2_tons", F.expr("CASE WHEN year % 3 = 0 THEN -co2_tons ELSE co2_tons END"))
    return E.validate_carbon(c).select("company", "year", F.array_join("violations", ",").alias("violations"))


@query("e7_scope_check", "SELECT company, year, (year % 5) * 0.15 * 2 > 1.1 AND year % 5 <> 0 AS review FROM {carbon}")
def _(t):
    scope = F.col("co2_tons").cast("double") * (F.col("year") % 5) * 0.15
    return t.carbon.select("company", "year", E.scope_check(F.col("co2_tons").cast("double"), scope, scope).alias("review"))


@query("e8_validate_exchange", "SELECT source_company, target_company, material, year, CASE WHEN year % 4 = 0 THEN 'kind' ELSE '' END AS violations FROM {exchanges}")
def _(t):
    x = t.exchanges.withColumn("exchange_type", F.expr("CASE WHEN year % 4 = 0 THEN 'gift' ELSE 'material' END"))
    return E.validate_exchange(x, ("material", "energy", "water")).select("source_company", "target_company", "material", "year", F.array_join("violations", ",").alias("violations"))


@query("e9_citation_check", "SELECT id, contains(lower(source_quote), lower(trim(material || ' away'))) AND id % 3 <> 0 AS cited FROM {listings}")
def _(t):
    quote = F.expr("CASE WHEN id % 3 = 0 THEN 'not there' ELSE concat(' ', upper(material), ' away') END")
    return t.listings.select("id", E.citation_check(quote, F.col("source_quote")).alias("cited"))


@query("e10_review_flag", "SELECT id, extraction_confidence < 0.9 AS review FROM {listings}")
def _(t):
    return t.listings.select("id", E.review_flag(F.col("extraction_confidence")).alias("review"))


@query("e11_route_results", f"SELECT CASE WHEN v <> '' THEN 'rejected' ELSE 'waste_listing' END AS route, count(*) AS n FROM (SELECT {WASTE_SQL} AS v FROM {{faulty}}) GROUP BY 1")
def _(t):
    routes = E.route_results(E.validate_waste(t.faulty).withColumn("record_type", F.lit("waste_listing")))
    parts = [d.groupBy(F.lit(k).alias("route")).agg(F.count("*").alias("n")) for k, d in routes.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def reports(t, dealt: bool = True):
    """Report texts rendered from the listings. Narrow rows are dealt by id first: the patterns cost far more than this
    shuffle, and a file of one row group would leave them to one task. Not dealt for a caller that groups them anyway."""
    text = "concat('recycled ', CAST(quantity_tons AS INT), ',000 tonnes of ', material, '. Scope 1: ', year, ' tCO2e. Electricity consumption: ', CAST(quantity_tons AS INT), ' MWh. EUR ', year, ' million. purchased ', year, ' carbon credits.')"
    rows = t.listings.select("id", "source_company", "year", "quantity_tons", "material")
    rows = rows.repartition("id") if dealt else rows
    return rows.select("id", "source_company", "year", F.expr(text).alias("text"))


# A line for each pattern of each table, with the fact that it holds: kind, item, value, unit. {q} is the listing's quantity.
LINES = {
    "waste": (
        ("recycled {q},000 tonnes of {material}.", "'recycled'", "material", "q * 1000", "'tonnes'"), ("Steel waste: {q}.5 tons.", "NULL", "'steel waste'", "q + 0.5", "'tons'"), ("{q} mt of copper wire recycled", "'recycled'", "'copper wire'", "q", "'mt'"),
        ("total waste {q},250 tonnes", "NULL", "NULL", "q * 1000 + 250", "'tonnes'"), ("waste to landfill | {q}", "NULL", "NULL", "q", "NULL"), ("hazardous waste | {q}", "NULL", "NULL", "q", "NULL"), ("glass waste {q} tons", "NULL", "'glass'", "q", "'tons'"),
    ),
    "emission": (
        ("GHG emissions: {q} million tonnes", "'ghg'", "NULL", "q * 1000000", "'tonnes'"), ("Scope 2 emissions = {year} tCO2e", "'scope 2'", "NULL", "year", "'tco2e'"), ("reduced emissions by {q}%", "NULL", "NULL", "q", "'%'"),
        ("carbon footprint of {q} million", "NULL", "NULL", "q * 1000000", "NULL"), ("methane: {q} kg", "'methane'", "NULL", "q", "'kg'"),
    ),
    "energy": (
        ("Electricity consumption: {q} MWh.", "'consumption'", "NULL", "q", "'mwh'"), ("saved {q} kWh of energy", "'savings'", "NULL", "q", "'kwh'"), ("{q} TWh of clean energy", "'renewable'", "NULL", "q", "'twh'"),
        ("renewable energy: {q} percent", "'renewable'", "NULL", "q", "'percent'"), ("solar capacity {q} GW", "'renewable'", "NULL", "q", "'gw'"),
    ),
    "financial": (
        ("$ {q} million in savings", "'savings'", "NULL", "q * 1000000", "'usd'"), ("${q} billion revenue", "'revenue'", "NULL", "q * 1000000000", "'usd'"), ("$ {q} million invested", "'investment'", "NULL", "q * 1000000", "'usd'"), ("$ {q},500 cost", "'cost'", "NULL", "q * 1000 + 500", "'usd'"),
        ("expense reduction: $ {q} million", "'savings'", "NULL", "q * 1000000", "'usd'"), ("recycling revenue = {q} million", "'revenue'", "NULL", "q * 1000000", "'usd'"), ("EUR {q} million.", "'other'", "NULL", "q * 1000000", "'usd'"), ("$ {q} per ton", "'unit cost'", "NULL", "q", "'usd/ton'"),
    ),
    "carbon_credit": (
        ("purchased {q} carbon credits", "'purchased'", "NULL", "q", "'credits'"), ("{q} offsets bought", "'purchased'", "NULL", "q", "'credits'"), ("offset {q} tonnes of CO2", "'offset'", "NULL", "q", "'credits'"), ("{q} tCO2e of carbon offset", "'offset'", "NULL", "q", "'credits'"),
        ("$ {q} million on carbon credits", "'spend'", "NULL", "q * 1000000", "'usd'"), ("carbon cost: $ {q} million", "'spend'", "NULL", "q * 1000000", "'usd'"), ("invested ${q} million in carbon credits", "'spend'", "NULL", "q * 1000000", "'usd'"), ("carbon price of EUR {q} per tonne", "'price'", "NULL", "q", "'usd'"),
        ("€{q} per tonne of carbon", "'price'", "NULL", "q", "'usd'"), ("EUA: {q}", "'allowances'", "NULL", "q", "'credits'"), ("retired {q} allowances", "'retired'", "NULL", "q", "'credits'"), ("carbon trading income: $ {q} million", "'trading'", "NULL", "q * 1000000", "'usd'"),
        ("sold {q} carbon credits", "'sold'", "NULL", "q", "'credits'"), ("Verra credits: {q}", "'certified'", "NULL", "q", "'credits'"), ("net zero by 20{q50}", "'target'", "NULL", "2050 + q % 50", "'year'"),
    ),
}


def csr_query(row: str, name: str, fact: str):
    """Every listing has the line of one pattern, by its id; all patterns of the table come up."""
    lines = LINES[fact]
    numbered = f"(SELECT id, material, year, quantity_tons::INT::BIGINT AS q, id % {len(lines)} AS line FROM {{listings}})"
    sql = " UNION ALL ".join(f"SELECT id, {kind} AS kind, {item}::VARCHAR AS item, ({value})::DOUBLE AS value, {unit}::VARCHAR AS unit FROM {numbered} WHERE line = {i}" for i, (_, kind, item, value, unit) in enumerate(lines))

    @query(f"{row}_{name}", sql)
    def _(t):
        text = F.element_at(F.array(*[F.lit(line[0]) for line in lines]), (F.col("id") % len(lines) + 1).cast("int"))
        q = F.col("quantity_tons").cast("int")
        for mark, value in (("{q}", q), ("{q50}", 50 + q % 50), ("{year}", F.col("year")), ("{material}", F.col("material"))):
            text = F.replace(text, F.lit(mark), value.cast("string"))
        # The patterns cost far more than this shuffle; a file of one row group would leave them to one task.
        rows = t.listings.select("id", "year", "quantity_tons", "material").repartition("id").select("id", text.alias("text"))
        return csr.csr_facts(rows, (fact,), "id").select("id", "kind", "item", "value", "unit")


csr_query("e12", "csr_waste", "waste")
csr_query("e13", "csr_emissions", "emission")
csr_query("e14", "csr_energy", "energy")
csr_query("e15", "csr_financials", "financial")
csr_query("e16", "csr_carbon_credits", "carbon_credit")


@query("e17_process_context", "SELECT doc_id, 'the' AS keyword, ((length(text) - length(replace(lower(text), 'the', ''))) // 3)::BIGINT AS n FROM {documents} WHERE contains(lower(text), 'the')")
def _(t):
    return E.process_context(t.documents, ["the"]).groupBy("doc_id", "keyword").agg(F.count("*").alias("n"))


@query("e18_cas_numbers", "SELECT id, (100 + id % 900)::VARCHAR || '-' || (10 + id % 90)::VARCHAR || '-' || (id % 10)::VARCHAR AS cas FROM {listings}")
def _(t):
    text = F.expr("concat(source_quote, ' CAS ', 100 + id % 900, '-', 10 + id % 90, '-', id % 10, '.')")
    return t.listings.select("id", F.explode(E.cas_numbers(text)).alias("cas"))


@query("e19_volume_mentions", """WITH q AS (SELECT id, source_quote, strpos(source_quote, ' tonnes') AS p FROM {listings})
    SELECT id, substr(source_quote, greatest(0, p - 52) + 1, p + 56 - greatest(0, p - 52)) AS mention FROM q WHERE p > 0""")
def _(t):
    return t.listings.select("id", F.explode(E.volume_mentions(F.col("source_quote"))).alias("mention"))


GROUPS = {"words": ["the", "and"], "wide": ["que", "der"], "secret": ["password", "akia"], "licence": ["license"]}


@query("e20_keyword_coverage", "WITH h AS (SELECT doc_id, [CASE WHEN regexp_matches(lower(text), 'the|and') THEN 'words' END, CASE WHEN regexp_matches(lower(text), 'que|der') THEN 'wide' END, CASE WHEN regexp_matches(lower(text), 'password|akia') THEN 'secret' END, CASE WHEN contains(lower(text), 'license') THEN 'licence' END] AS h FROM {documents}) SELECT doc_id, len(list_filter(h, lambda x: x IS NOT NULL))::BIGINT AS score, array_to_string(list_filter(h, lambda x: x IS NOT NULL), ',') AS hits FROM h")
def _(t):
    return E.keyword_coverage(t.documents, GROUPS)


@query("e21_extract_many", "SELECT id, count(*) AS facts FROM (SELECT id FROM {listings} UNION ALL SELECT id FROM {listings} WHERE year >= 1995) GROUP BY 1")
def _(t):
    f = csr.csr_facts(reports(t), ("waste", "emission"), "id").where("fact = 'waste' or value >= 1995")
    return f.groupBy("id").agg(F.count("*").alias("facts"))


@query("e22_parse_json_reply", "SELECT id, '{\"id\":' || id::VARCHAR || '}' AS reply FROM {listings}")
def _(t):
    text = F.expr("CASE id % 3 WHEN 0 THEN concat('{\"id\": ', id, '}') WHEN 1 THEN concat('Here:\\n```json\\n{\"id\": ', id, '}\\n```') ELSE concat('so {\"id\": ', id, '} it is') END")
    return t.listings.select("id", E.parse_json_reply(text).alias("reply"))


@query("e23_csr_to_tables", "SELECT source_company, sum(quantity_tons::INT * 1000)::DOUBLE AS tons, sum(year)::DOUBLE AS co2_tons FROM {listings} GROUP BY 1")
def _(t):
    r = reports(t)
    f = csr.csr_facts(r, ("waste", "emission"), "source_company").withColumnRenamed("source_company", "company").withColumn("year", F.lit(None).cast("int"))
    waste, carbon = csr.csr_to_tables(f)
    a = waste.groupBy("source_company").agg(F.sum("quantity_tons").alias("tons"))
    return a.join(carbon.groupBy(F.col("company").alias("source_company")).agg(F.sum("co2_tons").alias("co2_tons")), "source_company")
