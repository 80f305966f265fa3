"""Queries of sources and vector search (A, L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import vectors as V
from ..sources import files
from ..sources import markup as M
from ..sources import readers as S
from ..sources.shared import new_folder
from .catalog import query


@query("a1_read_listing_csv", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity::DOUBLE AS l_quantity FROM {lineitem}")
def _(t):
    from pyspark.sql.types import StructType

    lines = t.lineitem.select(F.concat_ws(",", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity").alias("line"))
    schema = StructType.fromDDL("l_orderkey long, l_linenumber int, l_partkey long, l_quantity double")
    return lines.select(F.from_csv("line", schema.simpleString()[7:-1].replace(":", " ")).alias("r")).select("r.*")


@query("a1_read_files", """SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 2 AND l_linenumber = 2 THEN NULL ELSE l_partkey END AS l_partkey, CASE WHEN l_orderkey % 3 = 1 THEN 'café ' || l_linenumber WHEN l_orderkey % 3 = 0 THEN 'a, "b"' END AS note,
    l_orderkey % 3 = 2 AND l_linenumber = 2 AS ragged FROM {lineitem}""")
def _(t):
    """Chunks of three forms, written to the shared folder and read as one: commas, semicolons in Latin-1 with other columns, tabs with short lines."""
    folder = new_folder(t.spark, "listings")
    part = lambda n: t.lineitem.where(f"l_orderkey % 3 = {n}")
    part(0).select("l_orderkey", "l_linenumber", "l_partkey", F.lit('a, "b"').alias("note")).write.csv(f"{folder}/a", header=True, escape='"')
    part(1).select(F.concat(F.lit("café "), "l_linenumber").alias("NOTE"), F.col("l_partkey").alias(" L_PartKey"), "l_linenumber", "l_orderkey").write.csv(f"{folder}/b", header=True, sep=";", encoding="ISO-8859-1")
    line = F.concat_ws("\t", "l_orderkey", "l_linenumber", F.expr("IF(l_linenumber = 2, NULL, l_partkey)"))
    part(2).select(line.alias("l_orderkey\tl_linenumber\tl_partkey")).write.csv(f"{folder}/c", header=True, sep="\x01", quote="")
    rows = files.read_listing_files(t.spark, f"{folder}/*")
    return rows.select(*[F.col(c).cast("long").alias(c) for c in ("l_orderkey", "l_linenumber", "l_partkey")], "note", F.col("bad_line").isNotNull().alias("ragged"))


@query("a19_json_records", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN doc_id % 5 WHEN 1 THEN 1 END AS records FROM {documents}")
def _(t):
    text = F.expr("CASE doc_id % 3 WHEN 0 THEN concat('[', array_join(transform(sequence(1, 5), i -> IF(i <= doc_id % 5, to_json(named_struct('id', i, 'source', source)), NULL)), ','), ']') WHEN 1 THEN to_json(named_struct('text', text)) ELSE concat('{', lang) END")
    return t.documents.select("doc_id", files.json_records(text).alias("records"))


@query("a2_map_headers", "SELECT o_orderkey AS year, o_orderpriority AS company, o_clerk AS material FROM (SELECT o_orderkey, o_orderpriority, o_orderstatus AS o_clerk FROM {orders})")
def _(t):
    df = t.orders.select(F.col("o_orderkey").alias("1. YEAR"), F.col("o_orderpriority").alias("4. Facility Name"), F.col("o_orderstatus").alias("37. CHEMICAL"))
    return S.map_headers(df, [S.RELEASE_ALIASES])


@query("a3_guess_columns", "SELECT p_type AS value, count(*) AS n FROM {part} GROUP BY 1")
def _(t):
    c = S.guess_column(t.part.columns, ["waste", "type", "material"])
    return t.part.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n"))


@query("a4_unpivot_fates", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, treatment, q AS quantity FROM (SELECT *, 'Recycled' AS treatment, l_quantity::DOUBLE AS q FROM {lineitem} UNION ALL SELECT *, 'Treated', l_tax::DOUBLE FROM {lineitem} UNION ALL SELECT *, 'Released', l_discount::DOUBLE FROM {lineitem}) WHERE q > 0")
def _(t):
    return S.unpivot_fates(t.lineitem, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], {"l_quantity": "Recycled", "l_tax": "Treated", "l_discount": "Released"})


@query("a5_parse_quantity", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE (1000 + o_orderkey % 1000)::DOUBLE END AS quantity FROM {orders}")
def _(t):
    text = F.expr("CASE o_orderkey % 3 WHEN 0 THEN 'n/a' WHEN 1 THEN concat('<1,', lpad(o_orderkey % 1000, 3, '0')) ELSE concat('1', lpad(o_orderkey % 1000, 3, '0')) END")
    return t.orders.select("o_orderkey", S.parse_quantity(text).alias("quantity"))


@query("a6_decode_eu_transfers", "SELECT id, CASE WHEN id % 2 = 0 THEN 'Hazardous waste' ELSE 'Non-hazardous waste' END AS material, CASE WHEN id % 3 = 0 THEN 'Disposal' WHEN id % 3 = 1 THEN 'Recovery' ELSE 'Unknown' END AS treatment_method, source_company || ', ' || source_country AS location FROM {listings}")
def _(t):
    df = t.listings.selectExpr("id", "CASE WHEN id % 2 = 0 THEN 'HW' ELSE 'NONHW' END AS waste_class", "CASE id % 3 WHEN 0 THEN 'D' WHEN 1 THEN 'R' END AS treatment", "source_company AS city", "source_country AS country", "source_company AS facility", "quantity_tons AS quantity")
    return S.decode_eu_transfers(df).select("id", "material", "treatment_method", "location")


@query("a7_read_series_json", "SELECT o_orderkey, year(o_orderdate)::VARCHAR AS year, 'Plastic' AS variable, (o_orderkey % 7)::DOUBLE AS value FROM {orders}")
def _(t):
    doc = F.expr("concat('[{\"year\":\"', year(o_orderdate), '\",\"variable\":\"Plastic\",\"value\":', o_orderkey % 7, '},{\"year\":\"', year(o_orderdate), '\",\"variable\":\"Total\",\"value\":9}]')")
    return S.read_series_json(t.orders.select("o_orderkey", doc.alias("doc")), "doc").select("o_orderkey", "year", "variable", "value")


@query("a8_mine_row_pair", "SELECT p_partkey, p_size::DOUBLE AS number, p_name AS label FROM {part}")
def _(t):
    return S.mine_row_pair(t.part.select("p_partkey", F.lit("-1").alias("a"), "p_size", F.lit("abc").alias("b"), "p_name"), ["a", "p_size", "b", "p_name"]).select("p_partkey", "number", "label")


@query("a9_region_from_filename", "SELECT doc_id, CASE WHEN contains(source, 'src1') THEN 'SAU' WHEN contains(source, 'src2') THEN 'ARE' ELSE 'EUR' END AS region FROM {documents}")
def _(t):
    return t.documents.select("doc_id", S.region_from_name(F.col("source"), [("src1", "SAU"), ("src2", "ARE")], "EUR").alias("region"))


@query("a10_register_documents", """WITH e AS (SELECT sha256(text) AS content_hash, min(doc_id) AS m FROM {documents} WHERE doc_id % 2 = 0 GROUP BY 1), n AS (SELECT sha256(text) AS content_hash, min(doc_id) AS m FROM {documents} WHERE doc_id % 3 = 0 GROUP BY 1)
    SELECT coalesce(e.content_hash, n.content_hash) AS content_hash, CASE WHEN n.m IS NULL THEN 'old/' || e.m::VARCHAR ELSE 'new/' || n.m::VARCHAR END AS url, CASE WHEN e.m IS NULL THEN 'q/' || n.m::VARCHAR ELSE 'p/' || e.m::VARCHAR END AS path, (e.m IS NOT NULL)::BIGINT + (n.m IS NOT NULL)::BIGINT AS n_meta FROM e FULL JOIN n ON e.content_hash = n.content_hash""")
def _(t):
    def side(where, url, path, key):
        g = t.documents.where(where).groupBy(F.sha2("text", 256).alias("content_hash")).agg(F.min("doc_id").alias("m"))
        return g.select("content_hash", F.concat(F.lit(url), "m").alias("url"), F.concat(F.lit(path), "m").alias("path"), F.create_map(F.lit(key), F.col("m").cast("string")).alias("metadata"))

    out = S.register_documents(side("doc_id % 3 = 0", "new/", "q/", "b"), side("doc_id % 2 = 0", "old/", "p/", "a"))
    return out.select("content_hash", "url", "path", F.size("metadata").cast("long").alias("n_meta"))


@query("a11_skip_seen", "SELECT doc_id FROM {documents} WHERE source || n_chars::VARCHAR NOT IN (SELECT source || n_chars::VARCHAR FROM {documents} WHERE doc_id % 3 = 0)")
def _(t):
    files = t.documents.select("doc_id", F.col("source").alias("name"), F.col("n_chars").alias("size"))
    seen = files.where("doc_id % 3 = 0").select(S.fingerprint(F.col("name"), F.col("size")).alias("fingerprint"))
    return S.skip_seen(files, seen).select("doc_id")


SNAPSHOTS = "SELECT strftime(ts, '%Y%m%d%H%M%S') AS timestamp, user_id::VARCHAR AS original, event_id FROM {events} WHERE event_type <> 'error' AND event_id % 4 <> 0"


@query("a12_select_snapshots", f"SELECT original, substr(timestamp, 1, 6) AS month, count(*) AS n FROM (SELECT * FROM ({SNAPSHOTS}) QUALIFY row_number() OVER (PARTITION BY original, substr(timestamp, 1, 6) ORDER BY timestamp) = 1) GROUP BY 1, 2")
def _(t):
    index = t.events.select(F.date_format("ts", "yyyyMMddHHmmss").alias("timestamp"), F.col("user_id").cast("string").alias("original"), F.lit("text/html").alias("mimetype"), F.expr("CASE event_type WHEN 'error' THEN '404' ELSE '200' END").alias("statuscode"), F.expr("CASE event_id % 4 WHEN 0 THEN '10' WHEN 1 THEN '-' ELSE '900' END").alias("length"))
    return S.select_snapshots(index).groupBy("original", F.substring("timestamp", 1, 6).alias("month")).agg(F.count("*").alias("n"))


TABLE = "concat('<table><tr><th>Material</th><th>Price</th></tr><tr><td>', p_name, '</td><td>$', CAST(p_size AS STRING), '/lb</td></tr></table>')"


@query("a13_extract_price_rows", "SELECT p_partkey, p_name AS material, '$' || p_size::VARCHAR || '/lb' AS price_text FROM {part}")
def _(t):
    return S.extract_price_rows(t.part.select("p_partkey", F.expr(TABLE).alias("html")), "html").where(S.is_valid_material(F.col("material"))).select("p_partkey", "material", "price_text")


@query("a14_parse_price_cell", "SELECT p_partkey, p_size::DOUBLE + 1000 AS price, CASE WHEN p_size % 2 = 0 THEN 'EUR' ELSE 'USD' END AS currency, CASE WHEN p_size % 2 = 0 THEN 'kg' ELSE 'lb' END AS unit FROM {part}")
def _(t):
    c = S.parse_price_cell(F.expr("concat(CASE WHEN p_size % 2 = 0 THEN '€' ELSE '$' END, '1,', lpad(CAST(p_size AS STRING), 3, '0'), CASE WHEN p_size % 2 = 0 THEN '/kg' ELSE ' per lb' END)"))
    return t.part.select("p_partkey", *[c[x].alias(x) for x in ("price", "currency", "unit")])


@query("a15_is_valid_material", "SELECT p_partkey, p_size % 3 <> 0 AS valid FROM {part}")
def _(t):
    return t.part.select("p_partkey", S.is_valid_material(F.expr("CASE WHEN p_size % 3 = 0 THEN 'Price ' ELSE p_name END")).alias("valid"))


# Links of every form, and where they lead from <root>/a/b/<id>.html?x=1.
FORMS = """concat('<a href="//cdn.b.com/', {id}, '.pdf">', "<a class=x HREF='../q", {id}, ".pdf#p2'>", '<a href=?d=', {id}, '.pdf>', '<link href = "./c/../d.pdf">', '<a href="/r/./s.pdf">', '<a href="HTTPS://x.org/../z.pdf">',
    '<a href=" e.pdf?a=1&amp;b=2.pdf ">', '<a href="../../../../up.pdf">', '<a href="#top"><a href=""><a data-href="no.pdf">', '<a href="f/..">')"""
LED = """SELECT page_url, unnest([regexp_extract(root, '^[a-z]+:') || '//cdn.b.com/' || page_id || '.pdf', root || '/a/q' || page_id || '.pdf', root || '/a/b/' || page_id || '.html?d=' || page_id || '.pdf', root || '/a/b/d.pdf', root || '/r/s.pdf', 'HTTPS://x.org/../z.pdf',
    root || '/a/b/e.pdf?a=1&b=2.pdf', root || '/up.pdf', root || '/a/b/']) AS link FROM p"""


@query("a16_harvest_links", f"""WITH p AS (SELECT page_id, html, regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) AS root, regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) || '/a/b/' || page_id || '.html?x=1' AS page_url FROM {{pages}})
    {LED} UNION SELECT page_url, root || href FROM (SELECT page_url, root, unnest(regexp_extract_all(html, ' href="(/[^"#]+)"', 1)) AS href FROM p)""")
def _(t):
    page = t.pages.select(F.concat(F.regexp_extract("url", "^([a-zA-Z]+://[^/?#]+)", 1), F.lit("/a/b/"), "page_id", F.lit(".html?x=1")).alias("page_url"), F.concat("html", F.expr(FORMS.replace("{id}", "page_id"))).alias("html"))
    return M.harvest_links(page, "html", "page_url")


ELEMENTS = "concat('<html><body><div class=menu>Value list<br></div><ul><li>', p_name, ' <div class=\"unit Market-RATE\"><i>$', CAST(p_size AS STRING), '</i>/lb &amp; up</div></li></ul></body>')"


@query("a13_price_elements", "SELECT p_partkey, p_name AS material, '$' || p_size::VARCHAR || '/lb & up' AS price_text FROM {part}")
def _(t):
    found = M.extract_price_elements(t.part.select("p_partkey", F.expr(ELEMENTS).alias("html")), "html")
    return found.where(S.is_valid_material(F.col("material"))).select("p_partkey", "material", "price_text")


@query("a17_year_from_name", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 2019 ELSE 2011 END::INT AS year FROM {documents}")
def _(t):
    return t.documents.select("doc_id", S.year_from_name(F.expr("CASE WHEN doc_id % 2 = 0 THEN 'report_2019.pdf' ELSE 'report.pdf' END"), F.concat(F.lit("in 2004 and 2011: "), F.regexp_replace("text", r"\d", ""))).alias("year"))


@query("a17_year_from_url", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 2012 END::INT AS last_year, CASE doc_id % 3 WHEN 0 THEN 2012 WHEN 1 THEN 1987 END::INT AS last_of_all FROM {documents}")
def _(t):
    url = F.expr("CASE doc_id % 3 WHEN 0 THEN 'https://a.org/2019/r-1991-2012.pdf' WHEN 1 THEN 'https://a.org/1987/x.pdf' ELSE concat('https://a.org/', source) END")
    return t.documents.select("doc_id", S.year_from_url(url).alias("last_year"), S.year_from_url(url, 1980).alias("last_of_all"))


@query("a18_source_type", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'epa_tri' WHEN 1 THEN 'eprtr' WHEN 2 THEN 'generic' ELSE 'epa_tri' END AS kind FROM {documents}")
def _(t):
    return t.documents.select("doc_id", S.source_type(F.expr("CASE doc_id % 4 WHEN 0 THEN 'gov' WHEN 1 THEN 'eprtr' WHEN 2 THEN 'saudi' ELSE source END")).alias("kind"))


@query("a18_route_documents", "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'csv' WHEN 1 THEN 'pdf' WHEN 2 THEN 'html' ELSE 'text' END AS route FROM {documents}")
def _(t):
    return t.documents.select("doc_id", S.route_documents(F.expr("CASE WHEN doc_id % 4 = 0 THEN 'csv' ELSE 'other' END"), F.expr("CASE doc_id % 4 WHEN 1 THEN 'a/b.PDF' WHEN 2 THEN 'x.htm' END")).alias("route"))


@query("a19_profile_csv", "SELECT doc_id, (doc_id % 3 + 1)::BIGINT AS \"rows\", 3::BIGINT AS \"columns\", 'id|lang|source' AS header FROM {documents}")
def _(t):
    p = S.profile_csv(F.expr("concat('id,lang,source\\n', repeat(concat_ws(',', doc_id, lang, source, '\\n'), CAST(doc_id % 3 + 1 AS INT)))"))
    return t.documents.select("doc_id", *[p[c].alias(c) for c in ("rows", "columns", "header")])


@query("a20_company_from_path", "SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'Acme' ELSE s_name END AS company FROM {supplier}")
def _(t):
    return t.supplier.select("s_suppkey", S.company_from_path(F.expr("CASE WHEN s_suppkey % 2 = 0 THEN 'data/acme/x_2020.pdf' ELSE concat('data/', s_name, '_2020.pdf') END"), ["Acme"]).alias("company"))


NEAREST = """SELECT q.vec_id AS query_id, v.vec_id AS id, round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 9) AS similarity FROM {embeddings} q JOIN {embeddings} v ON q.vec_id <> v.vec_id AND q.vec_id % 50 = 0"""


@query("l1_cosine_topk", f"SELECT query_id, id, round(similarity, 6) AS similarity, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS INT) AS rank FROM ({NEAREST}) QUALIFY rank <= 10")
def _(t):
    return V.cosine_topk(t.embeddings, t.embeddings.where("vec_id % 50 = 0"), 10).withColumn("similarity", F.round("similarity", 6))


@query("l2_search_filtered", f"SELECT query_id, id, round(similarity, 6) AS similarity, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS INT) AS rank FROM ({NEAREST} AND v.label = 2) QUALIFY rank <= 5")
def _(t):
    return V.search_filtered(t.embeddings, t.embeddings.where("vec_id % 50 = 0"), 5, "label = 2").withColumn("similarity", F.round("similarity", 6))


@query("l3_get_delete_count", "SELECT label, count(*) AS n FROM {embeddings} WHERE vec_id % 7 <> 0 GROUP BY 1")
def _(t):
    gone = t.embeddings.where("vec_id % 7 = 0").select("vec_id")
    return t.embeddings.join(gone, "vec_id", "left_anti").groupBy("label").agg(F.count("*").alias("n"))


@query("l4_chunk_for_embedding", "SELECT doc_id, substr(text, 1, 8000) AS chunk FROM {documents} WHERE length(text) >= 50")
def _(t):
    # The SQL asks for the first chunk only; the operator gives all.
    return V.chunk_for_embedding(t.documents, "text").where("chunk_index = 0").select("doc_id", "chunk")
