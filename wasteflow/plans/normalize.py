"""Queries of units, dates, ids and classification (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import material_tables as T
from .. import rules as R
from ..operators import names as names_of
from ..operators import normalize as N
from ..operators.classify import backfill, by_value, classify, sql_case
from .catalog import best_alike_sql, query
from .views import dealt_quotes

UNIT = "CASE l_linenumber % 5 WHEN 0 THEN 'kg' WHEN 1 THEN 'tons' WHEN 2 THEN 'lbs' WHEN 3 THEN 'tonnes' ELSE 'barrels' END"


def factor_sql(unit: str, table: dict, default: str) -> str:
    return f"CASE {unit} " + " ".join(f"WHEN '{k}' THEN CAST({v!r} AS DOUBLE)" for k, v in table.items()) + f" ELSE {default} END"


@query("d1_to_metric_tons", f"""WITH u AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS v, {UNIT} AS u FROM {{lineitem}})
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN u = 'barrels' THEN v ELSE round(round(v * ({factor_sql('u', R.UNITS, 'NULL')}), 4), 3) END AS value,
    CASE WHEN u = 'barrels' THEN u ELSE 'metric_ton' END AS unit FROM u""")
def _(t):
    q = N.to_metric_tons(F.col("l_quantity").cast("double"), F.expr(UNIT))
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.round(q["value"], 3).alias("value"), q["unit"].alias("unit"))


@query("d2_gov_to_tons", f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS DOUBLE) * ({factor_sql(UNIT, {k: v for k, v in R.GOV_UNITS.items() if k in ('kg', 'tons', 'lbs', 'tonnes')}, '1.0').replace('CASE CASE', 'CASE (CASE', 1).replace("ELSE 'barrels' END", "ELSE 'barrels' END)", 1)}) AS tons FROM {{lineitem}}""")
def _(t):
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", N.gov_to_tons(F.col("l_quantity").cast("double"), F.expr(UNIT)).alias("tons"))


@query("d3_extract_quantities", """SELECT id, len(v) AS n_quantities, CAST(v[1] AS DOUBLE) AS value, 'tonnes' AS unit, round(CAST(v[1] AS DOUBLE), 4) AS tons
    FROM (SELECT id, regexp_extract_all(source_quote, '([0-9]+) tonnes', 1) AS v FROM {listings})""")
def _(t):
    q = t.listings.select("id", N.extract_quantities(F.col("source_quote")).alias("q"))
    first = F.get("q", 0)
    return q.select("id", F.size("q").cast("long").alias("n_quantities"), first["value"].alias("value"), first["unit"].alias("unit"), first["tons"].alias("tons"))


@query("d4_rewrite_quantities", "SELECT id, regexp_replace(source_quote, '([0-9]+) tonnes', '\\1 metric_ton') AS text FROM {listings}")
def _(t):
    return dealt_quotes(t).select("id", N.rewrite_quantities(F.col("source_quote")).alias("text"))


@query("d5_classify", f"SELECT id, material, {sql_case('material', R.PART_RULES, 'other')} AS category FROM {{listings}}")
def _(t):
    return by_value(t.listings.select("id", "material"), "material", "category", classify(F.col("wf_value"), R.PART_RULES, "other"))


@query("d6_extract_country", f"SELECT id, {sql_case('source_location', R.COUNTRIES, 'EUR')} AS country FROM {{listings}}")
def _(t):
    return by_value(t.listings.select("id", "source_location"), "source_location", "country", N.extract_country(F.col("wf_value"))).drop("source_location")


@query("d7_backfill", f"""SELECT id, CASE WHEN id % 2 = 0 THEN material_subcategory ELSE {sql_case('material', R.PART_RULES, 'industrial_waste')} END AS category,
    {sql_case('source_location', R.COUNTRIES, 'EUR')} AS country FROM {{listings}}""")
def _(t):
    df = t.listings.withColumn("category", F.expr("CASE WHEN id % 2 = 0 THEN material_subcategory END")).withColumn("country", F.lit(None).cast("string"))
    df = by_value(df.select("id", "category", "country", "material", "source_location"), "material", "by_material", classify(F.col("wf_value"), R.PART_RULES, "industrial_waste"))
    df = by_value(df, "source_location", "by_place", N.extract_country(F.col("wf_value")))
    return backfill(backfill(df, "category", F.col("by_material")), "country", F.col("by_place")).select("id", "category", "country")


DATE_TEXT = """CASE o_orderkey % 4 WHEN 0 THEN {iso} WHEN 1 THEN {dmy} WHEN 2 THEN concat('FY', CAST(year(o_orderdate) AS STRING), ' report') ELSE 'none' END"""


@query("d8_parse_date", """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN CAST(o_orderdate AS DATE) WHEN 2 THEN make_date(year(o_orderdate), 1, 1) END AS parsed FROM {orders}""")
def _(t):
    text = F.expr(DATE_TEXT.format(iso="date_format(o_orderdate, 'yyyy-MM-dd')", dmy="date_format(o_orderdate, 'dd/MM/yyyy')"))
    return t.orders.select("o_orderkey", N.parse_date(text).alias("parsed"))


@query("d9_material_type_id", """SELECT DISTINCT p_name AS material, substr(upper(replace(p_name, ' ', '')), 1, 12) AS type_id FROM {part}""")
def _(t):
    return t.part.select(F.col("p_name").alias("material"), N.material_type_id(F.col("p_name")).alias("type_id")).distinct()


@query("d10_title_material", """SELECT DISTINCT p_name AS material, concat(upper(substr(p_name, 1, 1)), substr(split_part(p_name, ' ', 1), 2), ' ', upper(substr(split_part(p_name, ' ', 2), 1, 1)), substr(split_part(p_name, ' ', 2), 2)) AS title FROM {part}""")
def _(t):
    return t.part.select(F.col("p_name").alias("material"), N.title_material(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("title")).distinct()


@query("d11_resolve_company", f"""WITH n AS (SELECT DISTINCT regexp_replace(c_name, 'Customer#0*', 'Supplier ') AS name FROM {{customer}}), r AS (SELECT DISTINCT regexp_replace(s_name, '#0*', ' ') AS match FROM {{supplier}}),
    {best_alike_sql(">=")} SELECT n.name, coalesce(match, n.name) AS company, coalesce(score / 100, 0) AS confidence FROM n LEFT JOIN best ON n.name = best.name""")
def _(t):
    names = t.customer.select(F.regexp_replace("c_name", "Customer#0*", "Supplier ").alias("name"))
    return names_of.resolve_company(names, t.supplier.select(F.regexp_replace("s_name", "#0*", " ").alias("known")), "name", "known")


def profile_sql(part: str) -> str:
    value = {"hazards": lambda p: ", ".join(p[2]), "uses": lambda p: ", ".join(p[3]), "composition": lambda p: "; ".join(f"{c} {share}" for c, share in p[1])}[part]
    return "CASE " + " ".join(f"WHEN contains(lower(m), '{p[0]}') THEN '{value(p)}'" for p in T.CHEMICAL_PROFILES) + " END"


#: A material for each profile by the listing's id, and one without.
KEYS = [p[0].title() for p in T.CHEMICAL_PROFILES] + ["Clean sand"]
KEYED = f"material || ' ' || {KEYS}[CAST(id % {len(KEYS)} AS INT) + 1]"


@query("d12_chemical_profile", f"SELECT id, {profile_sql('composition')} AS composition, {profile_sql('hazards')} AS hazards, {profile_sql('uses')} AS uses FROM (SELECT id, {KEYED} AS m FROM {{listings}})")
def _(t):
    key = F.element_at(N.texts(KEYS), (F.col("id") % len(KEYS) + 1).cast("int"))
    p = N.chemical_profile(F.concat_ws(" ", "material", key))
    parts = F.transform(p["composition"], lambda c: F.concat_ws(" ", c["component"], c["percent_range"]))
    return t.listings.select("id", F.array_join(parts, "; ").alias("composition"), F.array_join(p["hazards"], ", ").alias("hazards"), F.array_join(p["potential_uses"], ", ").alias("uses"))


@query("d13_industry_label", """WITH n AS (SELECT DISTINCT source_company AS name FROM {listings}), r AS (SELECT s_suppkey AS o, substr(s_name, 1, 17) AS k, concat('industry ', CAST(s_nationkey AS STRING)) AS v FROM {supplier})
    SELECT n.name, coalesce((SELECT v FROM r WHERE contains(lower(n.name), lower(k)) OR contains(lower(k), lower(n.name)) ORDER BY lower(n.name) <> lower(k), o, k LIMIT 1), 'Unknown') AS value FROM n""")
def _(t):
    ref = t.supplier.select(F.col("s_suppkey").alias("o"), F.substring("s_name", 1, 17).alias("k"), F.concat(F.lit("industry "), F.col("s_nationkey").cast("string")).alias("v"))
    return names_of.contains_join(t.listings, ref, "source_company", "k", "v", "o")


@query("d14_region_of", """SELECT id, r_name AS region, CAST(r_regionkey * 10 AS DOUBLE) AS region_lat, CAST(r_regionkey * 20 - 40 AS DOUBLE) AS region_lon FROM {listings} JOIN {nation} ON source_country = n_name JOIN {region} ON n_regionkey = r_regionkey""")
def _(t):
    regions = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("source_country"), F.col("r_name").alias("region"), (F.col("r_regionkey") * 10).cast("double").alias("region_lat"), (F.col("r_regionkey") * 20 - 40).cast("double").alias("region_lon"))
    return t.listings.select("id", "source_country").join(regions, "source_country").drop("source_country")


CATEGORIES = [r[0] for r in T.RECEIVERS] + ["other"]
INDUSTRIES = [i[0] for i in T.INDUSTRY_CATEGORIES] + ["fishing"]
MATERIALS = ["food", "zinc", "polymer", "toxic", "sand"]


def pick(values: list[str], by: str) -> str:
    return f"{values}[CAST({by} % {len(values)} AS INT) + 1]"


@query("d15_receiver_lookup", f"""WITH r AS (SELECT id, {pick(CATEGORIES, 'id')} AS category, {pick(INDUSTRIES, 'id')} AS industry, {pick(MATERIALS, 'id // 7')} || ' ' || material AS m FROM {{listings}})
    SELECT id, CASE {' '.join(f"WHEN contains(category, '{a}') OR contains(m, '{b}') THEN '{name}'" for name, a, b in T.RECEIVER_TYPES)} ELSE '{T.OTHER_RECEIVER}' END AS receiver,
    CASE category {' '.join(f"WHEN '{c}' THEN '{'|'.join(names)}'" for c, names, _ in T.RECEIVERS)} ELSE 'general recycling' END AS receivers, CASE category {' '.join(f"WHEN '{c}' THEN '{o}'" for c, _, o in T.RECEIVERS)} ELSE '1.0 tons CO2/ton' END AS carbon_offset,
    CASE industry {' '.join(f"WHEN '{i}' THEN '{'|'.join(c)}'" for i, c in T.INDUSTRY_CATEGORIES)} ELSE 'mixed' END AS categories FROM r""")
def _(t):
    of = lambda values, by: F.element_at(N.texts(values), (by % len(values) + 1).cast("int"))
    category, industry, material = of(CATEGORIES, F.col("id")), of(INDUSTRIES, F.col("id")), F.concat_ws(" ", of(MATERIALS, F.floor(F.col("id") / 7)), "material")
    found = N.receiver_lookup(category)
    return t.listings.select("id", N.receiver_type(category, material).alias("receiver"), F.array_join(found["receivers"], "|").alias("receivers"), found["carbon_offset"].alias("carbon_offset"), F.array_join(N.industry_categories(industry), "|").alias("categories"))
