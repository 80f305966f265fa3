"""Canonical views of the driver's tables: the shapes that the operators read. One text serves Spark and the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "listings": """SELECT l_orderkey*1000000000 + l_partkey*100000 + l_suppkey*10 + l_linenumber AS id,
      l_orderkey AS document_id, p_name AS material, p_brand AS material_subcategory, CAST(l_quantity AS DECIMAL(15,2)) AS quantity_tons,
      CASE l_returnflag WHEN 'R' THEN 'Recycled' WHEN 'A' THEN 'Disposal/Released' ELSE 'Treated' END AS treatment_method,
      s_name AS source_company, p_type AS source_industry, concat(n_name, ', ', r_name) AS source_location, n_name AS source_country,
      CAST(year(l_shipdate) AS INT) AS year, CAST(l_discount*10 AS DECIMAL(3,2)) AS extraction_confidence,
      concat('In ', CAST(year(l_shipdate) AS STRING), ' ', s_name, ' sent ', CAST(CAST(l_quantity AS INT) AS STRING), ' tonnes of ', p_name, ' away.') AS source_quote,
      CAST((l_suppkey % 180) - 90 AS DOUBLE) AS lat, CAST((l_suppkey * 7 % 360) - 180 AS DOUBLE) AS lon
      FROM {lineitem} JOIN {part} ON l_partkey=p_partkey JOIN {supplier} ON l_suppkey=s_suppkey
      JOIN {nation} ON s_nationkey=n_nationkey JOIN {region} ON n_regionkey=r_regionkey""",
    "faulty": """SELECT id + copy * 1000000000000000 AS id, document_id, CASE WHEN copy = 0 AND id % 97 = 0 THEN NULL ELSE material END AS material,
      CASE WHEN copy = 0 AND id % 101 = 0 THEN -quantity_tons ELSE quantity_tons END AS quantity_tons, treatment_method, source_company, source_industry,
      CASE WHEN copy = 0 AND id % 89 = 0 THEN 'Unknown' ELSE source_location END AS source_location, source_country,
      CAST(CASE WHEN copy = 0 AND id % 103 = 0 THEN 2031 ELSE year END AS INT) AS year, extraction_confidence,
      CASE WHEN copy = 0 AND id % 107 = 0 THEN concat('caf', chr(195), chr(169), ' ', source_quote) ELSE source_quote END AS source_quote, lat, lon
      FROM {listings} CROSS JOIN (VALUES (0), (1)) AS c(copy) WHERE copy = 0 OR id % 50 = 0""",
    "queue": """SELECT event_id AS id, concat('src', CAST(user_id%5 AS STRING)) AS source,
      CASE event_type WHEN 'view' THEN 'pending' WHEN 'click' THEN 'processing' WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'completed_no_data' ELSE 'completed' END AS status,
      ts AS ingested_at, value AS size_bytes FROM {events}""",
    "valuations": """SELECT p_name AS material_type_id, CAST(round(avg(p_retailprice),2) AS DECIMAL(12,2)) AS price_per_ton_usd, count(*) AS source_count FROM {part} GROUP BY p_name""",
    "carbon": """SELECT c_name AS company, CAST(year(o_orderdate) AS INT) AS year, CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DECIMAL(18,2)) AS co2_tons
      FROM {orders} JOIN {customer} ON o_custkey=c_custkey GROUP BY 1,2""",
    "exchanges": """SELECT s_name AS source_company, c_name AS target_company, p_name AS material, CAST(year(l_shipdate) AS INT) AS year,
      CAST(sum(CAST(l_quantity AS DECIMAL(15,2))) AS DECIMAL(15,2)) AS volume_tons
      FROM {lineitem} JOIN {orders} ON l_orderkey=o_orderkey JOIN {customer} ON o_custkey=c_custkey JOIN {supplier} ON l_suppkey=s_suppkey JOIN {part} ON l_partkey=p_partkey GROUP BY 1,2,3,4""",
    "mapping": """SELECT upper(p_name) AS waste_material, p_name AS material_type_id, CAST(0.85 AS DOUBLE) AS match_confidence FROM {part} WHERE p_size % 3 <> 0 GROUP BY p_name""",
    "prices": """SELECT p_partkey AS id, p_name AS material_name, CAST(p_retailprice AS DOUBLE) AS price_value,
      CASE p_size % 4 WHEN 0 THEN 'lb' WHEN 1 THEN 'kg' WHEN 2 THEN 'ton' ELSE 'mt' END AS price_unit, p_brand AS source, CAST(p_size AS DOUBLE) / 100 AS confidence FROM {part}""",
    "docs": "SELECT o_orderkey AS id, concat('src', CAST(o_custkey % 5 AS STRING)) AS source, o_orderstatus AS status, o_orderpriority AS source_url FROM {orders} WHERE o_orderkey % 10 <> 0",
    "facility": "SELECT s_suppkey AS facility_id, s_name AS facility_name, n_name AS country FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey",
    "knowledge": """SELECT user_id AS k, concat('Supplier#', lpad(CAST(user_id % 100 AS STRING), 9, '0')) AS company, event_type AS keyword, concat('excerpt ', CAST(event_id AS STRING)) AS context, event_id AS ord FROM {events}""",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def dealt_quotes(t: Tables) -> DataFrame:
    """id and source_quote of the listings, dealt by id: patterns cost far more than this shuffle, and a file of one row
    group would leave them to one task."""
    return t.listings.select("id", "source_quote").repartition("id")


def names_in(text: str) -> list[str]:
    return [n for n in (*TABLES, *VIEWS) if "{" + n + "}" in text]


class Tables:
    """Tables and views of one folder as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self.sql(VIEWS[name])
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{n: getattr(self, n) for n in names_in(text)})


def oracle(text: str) -> str:
    """DuckDB text of SQL over {tables} and {views}."""
    parts: dict[str, str] = {}

    def need(t: str) -> None:
        for n in names_in(t):
            if n in VIEWS and n not in parts:
                need(VIEWS[n])
                parts[n] = VIEWS[n]

    need(text)
    plain = {n: n for n in TABLES} | {n: f"v_{n}" for n in VIEWS}

    def fill(t: str) -> str:
        for n, to in plain.items():
            t = t.replace("{" + n + "}", to)
        return t

    heads = [f"v_{n} AS ({fill(t)})" for n, t in parts.items()]
    text = fill(text).strip()
    if not heads:
        return text
    return f"WITH {', '.join(heads)}, {text[5:]}" if text[:5].upper() == "WITH " else f"WITH {', '.join(heads)} {text}"
