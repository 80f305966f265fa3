"""Queries of data-quality audits (J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audits as A
from ..operators import joins as J
from .catalog import query


def checks_sql(rules: list[tuple[str, str, str]], ok: float, warn: float, source: str = "{faulty}") -> str:
    rows = " UNION ALL ".join(f"SELECT '{n}' AS \"check\", '{s}' AS severity, count(*) FILTER ({bad}) AS failures, count(*) AS total FROM {source}" for n, s, bad in rules)
    return f"SELECT *, 100.0::DOUBLE * failures / total AS pct, CASE WHEN 100.0 * failures / total < {ok!r} THEN 'OK' WHEN 100.0 * failures / total < {warn} THEN 'WARN' ELSE 'BAD' END AS status FROM ({rows})"


FIELDS = ["material", "source_company", "source_location", "year"]
KEYS = ["material", "source_company", "year", "quantity_tons"]
NULL = lambda f: f"{f} IS NULL OR {f}::VARCHAR = ''"


@query("j1_null_report", checks_sql([(f, "critical", NULL(f)) for f in FIELDS], 5, 50))
def _(t):
    return A.null_report(t.faulty, FIELDS)


@query("j2_completeness_report", checks_sql([(f, "critical", f"{NULL(f)} OR {f}::VARCHAR = 'Unknown'") for f in FIELDS], 5, 50))
def _(t):
    return A.null_report(t.faulty, FIELDS, ("Unknown",))


def dup_sql(keys: str, guard: str = "true") -> str:
    return f"SELECT count(*) AS n_groups, coalesce(sum(n), 0)::BIGINT AS n_rows FROM (SELECT count(*) AS n FROM {{faulty}} WHERE {guard} GROUP BY {keys} HAVING count(*) > 1)"


@query("j3_duplicate_groups", " UNION ALL ".join(f"SELECT '{n}' AS key_set, * FROM ({dup_sql(k, g)})" for n, k, g in (("base", "material, source_company, year, quantity_tons", "true"), ("document", "material, source_company, year, quantity_tons, document_id", "true"), ("treatment", "source_company, material, year, treatment_method", "true"), ("guarded", "material, source_company, year, quantity_tons", "material IS NOT NULL AND source_company IS NOT NULL AND year IS NOT NULL AND quantity_tons IS NOT NULL"))))
def _(t):
    return A.duplicate_key_sets(t.faulty, SETS)


@query("j4_pre_upload_audit", checks_sql([(f"null {c}", "critical", NULL(c)) for c in ("material", "source_company", "year")] + [("suspicious material", "warning", "regexp_matches(material, '^[0-9]+$') OR length(material) < 2"), ("extreme quantity", "warning", "quantity_tons > 10000000"), ("non-positive quantity", "critical", "quantity_tons <= 0"), ("future year", "critical", "year > 2026"), ("ancient year", "warning", "year < 1980")], 5, 20))
def _(t):
    return A.pre_upload_audit(t.faulty)


@query("j5_quick_quality", f"""WITH d AS ({dup_sql('material, source_company, year, quantity_tons')}), o AS (SELECT 100.0::DOUBLE * count(*) FILTER (material IS NULL OR material = '') / count(*) AS null_pct, 100.0::DOUBLE * count(*) FILTER (quantity_tons <= 0 OR year > 2026) / count(*) AS bad_pct FROM {{faulty}})
    SELECT *, CASE WHEN n_groups < 100 AND null_pct < 5 AND bad_pct < 10 THEN 'OK' ELSE 'REVIEW' END AS verdict FROM d, o""")
def _(t):
    return A.quick_quality(t.faulty, KEYS)


@query("j6_stress_test", "WITH x AS (" + checks_sql([("year range", "error", "year NOT BETWEEN 1980 AND 2026"), ("too large", "error", "quantity_tons > 100000000"), ("negative", "error", "quantity_tons < 0"), ("mojibake", "warning", "regexp_matches(source_quote, 'Ã|ï¿½|â€')")], 1e-12, 1) + """) SELECT * FROM x UNION ALL
    SELECT 'orphans', 'error', failures, total, 100.0::DOUBLE * failures / total, CASE WHEN failures = 0 THEN 'OK' ELSE 'BAD' END FROM (SELECT count(*) FILTER (document_id NOT IN (SELECT id FROM {docs})) AS failures, count(*) AS total FROM {faulty})""")
def _(t):
    return A.stress_test(t.faulty, J.orphans(t.faulty, t.docs))


@query("j7_integrity_audit", checks_sql([(f"null {c}", "critical", NULL(c)) for c in ("material", "source_company", "source_location", "year")] + [("hazardous landfilled", "warning", "contains(lower(material), 'hazard') AND contains(lower(treatment_method), 'landfill')")], 5, 20))
def _(t):
    return A.integrity_audit(t.faulty)


SETS = [("base", KEYS, False), ("document", [*KEYS, "document_id"], False), ("treatment", ["source_company", "material", "year", "treatment_method"], False), ("guarded", KEYS, True)]
UPLOAD = [(f"null {c}", "", NULL(c)) for c in ("material", "source_company", "year")] + [("suspicious material", "", "regexp_matches(material, '^[0-9]+$') OR length(material) < 2"), ("extreme quantity", "", "quantity_tons > 10000000"), ("non-positive quantity", "", "quantity_tons <= 0"), ("future year", "", "year > 2026"), ("ancient year", "", "year < 1980")]
STRESS = [("year range", "", "year NOT BETWEEN 1980 AND 2026"), ("too large", "", "quantity_tons > 100000000"), ("negative", "", "quantity_tons < 0"), ("mojibake", "", "regexp_matches(source_quote, 'Ã|ï¿½|â€')"), ("orphans", "", "document_id NOT IN (SELECT id FROM {docs})")]
INTEGRITY = [(f"null {c}", "", NULL(c)) for c in ("material", "source_company", "source_location", "year")] + [("hazardous landfilled", "", "contains(lower(material), 'hazard') AND contains(lower(treatment_method), 'landfill')")]
EVERY = [("null_report", [(f, "", NULL(f)) for f in FIELDS], 5, 50), ("completeness", [(f, "", f"{NULL(f)} OR {f}::VARCHAR = 'Unknown'") for f in FIELDS], 5, 50), ("pre_upload", UPLOAD, 5, 20), ("quick_quality", [("null material", "", NULL("material")), ("bad values", "", "quantity_tons <= 0 OR year > 2026")], 5, 10), ("stress", STRESS, 1e-12, 1), ("integrity", INTEGRITY, 5, 20)]
DUPLICATES = " UNION ALL ".join(f"SELECT 'duplicates' AS audit, '{n}' AS \"check\", n_groups AS failures, n_rows AS total, NULL::DOUBLE AS pct, CASE WHEN n_groups < 100 THEN 'OK' ELSE 'REVIEW' END AS status FROM ({dup_sql(', '.join(k), ' AND '.join(c + ' IS NOT NULL' for c in k) if g else 'true')})" for n, k, g in SETS)


@query("j_listing_audits", " UNION ALL ".join(f"SELECT '{a}' AS audit, \"check\", failures, total, pct, CASE WHEN \"check\" = 'orphans' AND failures > 0 THEN 'BAD' ELSE status END AS status FROM ({checks_sql(r, ok, warn)})" for a, r, ok, warn in EVERY) + " UNION ALL " + DUPLICATES)
def _(t):
    return A.listing_audits(t.faulty, t.docs, FIELDS, SETS)


PRICED = "(SELECT *, CASE WHEN id % 7 = 0 THEN 0 WHEN id % 11 = 0 THEN -5 ELSE 100 END AS price, id % 13 = 0 AS unsafe, id % 4 = 0 AS verified, CASE WHEN id % 5 = 0 THEN 'Toxic dust' ELSE 'inert' END AS profile FROM {faulty})"


def priced(t):
    return t.sql("SELECT * FROM " + PRICED)


@query("j8_polarity_check", checks_sql([("liability priced", "error", "regexp_matches(lower(material), 'anvil|gizmo') AND price > 0"), ("volume", "warning", "quantity_tons > 10000000"), ("latitude", "error", "abs(lat) > 90"), ("longitude", "error", "abs(lon) > 180")], 1e-12, 1, PRICED))
def _(t):
    return A.polarity_check(priced(t), "anvil|gizmo")


@query("j9_impossible_pairs", checks_sql([("STEEL with ring", "error", "contains(lower(source_industry), 'steel') AND contains(lower(material), 'ring')"), ("COPPER with bolt", "error", "contains(lower(source_industry), 'copper') AND contains(lower(material), 'bolt')"), ("zero price", "warning", "price = 0")], 0.1, 1, PRICED))
def _(t):
    return A.impossible_pairs(priced(t), [("STEEL", "ring"), ("COPPER", "bolt")])


@query("j10_confidence_score", f"""WITH p AS (SELECT * FROM {PRICED}), d AS (SELECT count(*) FILTER (n > 1)::DOUBLE / count(*) AS drift FROM (SELECT source_company, count(DISTINCT source_location) AS n FROM p GROUP BY 1)),
    r AS (SELECT count(*) FILTER (unsafe)::DOUBLE / count(*) AS unsafe, count(*) FILTER (price = 0)::DOUBLE / count(*) AS free FROM p) SELECT drift, unsafe, free, round(100 - 10 * drift - 20 * unsafe - 10 * free, 9) AS score FROM d, r""")
def _(t):
    return A.confidence_score(priced(t), "source_company", "source_location").withColumn("score", F.round("score", 9))


@query("j11_safety_mismatch", f"SELECT count(*) FILTER (contains(lower('non-hazardous ' || material), 'non-hazardous') AND contains(lower(profile), 'toxic')) AS mismatches, count(*) AS total FROM {PRICED}")
def _(t):
    return A.safety_mismatch(priced(t).withColumn("material", F.concat(F.lit("Non-hazardous "), F.col("material"))))


@query("j12_composition_report", f"SELECT count(*) AS total, count(*) FILTER (lat <> 0) AS geo, count(*) FILTER (verified) AS verified, count(*) FILTER (price > 0) AS priced, count(*) FILTER (price < 0) AS negative FROM {PRICED}")
def _(t):
    return A.composition_report(priced(t))


@query("j13_location_quality", "SELECT count(*) AS total, count(*) FILTER (source_location = 'Unknown') AS unknown, 1 - count(*) FILTER (source_location = 'Unknown')::DOUBLE / count(*) AS quality FROM {faulty}")
def _(t):
    return A.location_quality(t.faulty)


@query("j14_readiness_check", "SELECT count(DISTINCT material) AS materials, count(DISTINCT source_company) AS companies, CASE WHEN count(DISTINCT material) > 50 AND count(DISTINCT source_company) > 100 THEN 'READY' ELSE 'NOT READY' END AS status FROM {listings}")
def _(t):
    return A.readiness_check(t.listings)


@query("j15_financial_outliers", "SELECT count(*) FILTER (o_totalprice > 400000) AS outliers, max(o_totalprice)::DOUBLE AS greatest, (SELECT o_orderkey FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 1) AS greatest_key FROM {orders}")
def _(t):
    return A.financial_outliers(t.orders.withColumn("o_totalprice", F.col("o_totalprice").cast("double")), "o_totalprice", "o_orderkey", 400000)


@query("j16_price_coverage_status", "SELECT pct, CASE WHEN pct < 20 THEN 'CRITICAL' WHEN pct < 50 THEN 'SEVERE' WHEN pct < 90 THEN 'PARTIAL' ELSE 'GOOD' END AS status FROM (SELECT round(100.0::DOUBLE * count(m.material_type_id) / count(*), 9) AS pct FROM {listings} LEFT JOIN {mapping} m ON material = m.material_type_id)")
def _(t):
    j = t.listings.join(t.mapping, F.col("material") == F.col("material_type_id"), "left")
    one = j.agg(F.round(F.try_divide(100.0 * F.count("material_type_id"), F.count("*")), 9).alias("pct"))
    return one.withColumn("status", A.price_coverage_status(F.col("pct")))


@query("j17_asset_inventory", " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n FROM {{{n}}}" for n in ("listings", "carbon", "exchanges", "queue", "documents")))
def _(t):
    return A.asset_inventory({n: getattr(t, n) for n in ("listings", "carbon", "exchanges", "queue", "documents")})


@query("j18_unknown_rates", "SELECT 100.0::DOUBLE * count(*) FILTER (material IS NULL) / count(*) AS material_pct, 100.0::DOUBLE * count(*) FILTER (source_location = 'Unknown') / count(*) AS region_pct FROM {faulty}")
def _(t):
    rate = lambda c: F.try_divide(100.0 * F.count_if(A.missing(c) | (F.lower(c) == "unknown")), F.count("*"))
    return t.faulty.agg(rate("material").alias("material_pct"), rate("source_location").alias("region_pct"))


@query("j19_citation_presence", "SELECT count(*) FILTER (source_quote <> '') AS quoted, count(*) FILTER (quantity_tons > 0) AS positive, count(*) AS total FROM {faulty}")
def _(t):
    return t.faulty.agg(F.count_if(~A.missing("source_quote")).alias("quoted"), F.count_if(F.col("quantity_tons") > 0).alias("positive"), F.count("*").alias("total"))
