"""Data-quality audits: each counts its checks in one pass and returns check, severity, failures, total, pct, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written

MOJIBAKE = r"Ã|ï¿½|â€"


def missing(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c).cast("string") == "")


def checks(df: DataFrame, rules: list[tuple[str, str, Column]], ok: float, warn: float) -> DataFrame:
    """One row a rule (name, severity, failing rows): OK below ok percent, WARN below warn, else BAD. An empty table is OK."""
    parts = [F.struct(F.lit(n).alias("check"), F.lit(s).alias("severity"), F.count_if(F.coalesce(bad, F.lit(False))).alias("failures")) for n, s, bad in rules]
    one = df.agg(F.count("*").alias("total"), F.array(*parts).alias("c")).select("total", F.explode("c").alias("c")).select("c.check", "c.severity", "c.failures", "total")
    pct = F.coalesce(F.try_divide(100.0 * F.col("failures"), F.col("total")), F.lit(0.0))
    return one.withColumn("pct", pct).withColumn("status", F.when(pct < ok, "OK").when(pct < warn, "WARN").otherwise("BAD"))


def null_rules(fields: list[str], also: tuple[str, ...] = ()) -> list[tuple[str, str, Column]]:
    return [(f, "critical", missing(f) | F.col(f).cast("string").isin(*also) if also else missing(f)) for f in fields]


def null_report(df: DataFrame, fields: list[str], also: tuple[str, ...] = ()) -> DataFrame:
    """Fields that are null, empty or one of `also`: OK below 5 percent, WARN below 50."""
    return checks(df, null_rules(fields, also), 5, 50)


def duplicate_groups(df: DataFrame, keys: list[str], guard: bool = False) -> DataFrame:
    """Number of keys with several rows, and their rows; with guard only keys without nulls."""
    rows = df.where(" and ".join(f"`{k}` is not null" for k in keys)) if guard else df
    g = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return g.agg(F.count("*").alias("n_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


def duplicate_key_sets(df: DataFrame, sets: list[tuple[str, list[str], bool]]) -> DataFrame:
    """duplicate_groups of several (name, keys, guard), each with its key_set, from one scan of df.

    Rows are expanded once for each different list of keys and counted before the shuffle; a guarded set takes the groups of the
    same keys that hold no null.
    """
    lists = [list(k) for k in dict.fromkeys(tuple(k) for _, k, _ in sets)]
    every = list(dict.fromkeys(c for k in lists for c in k))
    groups = df.groupingSets([[F.col(c) for c in k] for k in lists], *every).agg(F.count("*").alias("n"), F.grouping_id().alias("gid")).where("n > 1")
    # A column's bit is set where the column is not among the keys; the first column has the highest bit.
    gid = lambda k: sum(1 << (len(every) - 1 - i) for i, c in enumerate(every) if c not in k)
    counted = []
    for name, keys, guard in sets:
        own = F.col("gid") == gid(keys)
        if guard:
            for c in keys:
                own = own & F.col(c).isNotNull()
        counted.append(F.struct(F.lit(name).alias("key_set"), F.count_if(own).alias("n_groups"), F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0)).alias("n_rows")))
    return groups.agg(F.array(*counted).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def upload_rules(this_year: int = 2026) -> list[tuple[str, str, Column]]:
    m, q, y = F.col("material"), F.col("quantity_tons"), F.col("year")
    rules = [(f"null {c}", "critical", missing(c)) for c in ("material", "source_company", "year")]
    rules += [("suspicious material", "warning", m.rlike("^[0-9]+$") | (F.length(m) < 2)), ("extreme quantity", "warning", q > 10_000_000), ("non-positive quantity", "critical", q <= 0), ("future year", "critical", y > this_year), ("ancient year", "warning", y < 1980)]
    return rules


def pre_upload_audit(df: DataFrame, this_year: int = 2026) -> DataFrame:
    return checks(df, upload_rules(this_year), 5, 20)


def quick_quality(df: DataFrame, keys: list[str]) -> DataFrame:
    """Duplicate groups, null and bad percentages, verdict."""
    bad = F.coalesce((F.col("quantity_tons") <= 0) | (F.col("year") > 2026), F.lit(False))
    one = df.agg((100.0 * F.count_if(missing("material")) / F.count("*")).alias("null_pct"), (100.0 * F.count_if(bad) / F.count("*")).alias("bad_pct"))
    out = duplicate_groups(df, keys).join(F.broadcast(one), F.lit(True))
    return out.withColumn("verdict", F.when((F.col("n_groups") < 100) & (F.col("null_pct") < 5) & (F.col("bad_pct") < 10), "OK").otherwise("REVIEW"))


def stress_rules() -> list[tuple[str, str, Column]]:
    return [("year range", "error", ~F.col("year").between(1980, 2026)), ("too large", "error", F.col("quantity_tons") > 1e8), ("negative", "error", F.col("quantity_tons") < 0), ("mojibake", "warning", F.col("source_quote").rlike(MOJIBAKE))]


def stress_test(df: DataFrame, orphaned: DataFrame) -> DataFrame:
    """Year range, greatest quantity, negatives, mojibake; orphans come from a table of orphaned rows."""
    total = df.agg(F.count("*").alias("total"))
    o = orphaned.agg(F.count("*").alias("failures")).join(F.broadcast(total), F.lit(True))
    pct = F.coalesce(F.try_divide(100.0 * F.col("failures"), F.col("total")), F.lit(0.0))
    row = o.select(F.lit("orphans").alias("check"), F.lit("error").alias("severity"), "failures", "total", pct.alias("pct"), F.when(F.col("failures") == 0, "OK").otherwise("BAD").alias("status"))
    return checks(df, stress_rules(), 1e-12, 1).unionByName(row)


def integrity_rules() -> list[tuple[str, str, Column]]:
    rules = [(f"null {c}", "critical", missing(c)) for c in ("material", "source_company", "source_location", "year")]
    return [*rules, ("hazardous landfilled", "warning", F.lower("material").contains("hazard") & F.lower("treatment_method").contains("landfill"))]


def integrity_audit(df: DataFrame) -> DataFrame:
    return checks(df, integrity_rules(), 5, 20)


def listing_audits(df: DataFrame, docs: DataFrame, fields: list[str], sets: list[tuple[str, list[str], bool]]) -> DataFrame:
    """All audits of listings in one report: audit, check, failures, total, pct, status.

    df is written once with the columns that audits read. One aggregate over it counts all rules, one the groups of all key sets
    (failures: keys with several rows, total: their rows), and one the orphans, by document.
    """
    used = [*fields, *(c for _, k, _ in sets for c in k), "material", "source_company", "source_location", "year", "quantity_tons", "source_quote", "treatment_method", "document_id"]
    rows = written(df.select(*dict.fromkeys(used)), "audited")
    bad = (F.col("quantity_tons") <= 0) | (F.col("year") > 2026)
    audits = [("null_report", null_rules(fields), 5, 50), ("completeness", null_rules(fields, ("Unknown",)), 5, 50), ("pre_upload", upload_rules(), 5, 20), ("quick_quality", [("null material", "", missing("material")), ("bad values", "", bad)], 5, 10), ("stress", stress_rules(), 1e-12, 1), ("integrity", integrity_rules(), 5, 20)]
    rules = [(a, n, c, ok, warn) for a, part, ok, warn in audits for n, _, c in part]
    counted = [F.struct(F.lit(a).alias("audit"), F.lit(n).alias("check"), F.count_if(F.coalesce(c, F.lit(False))).alias("failures"), F.lit(float(ok)).alias("ok"), F.lit(float(warn)).alias("warn")) for a, n, c, ok, warn in rules]
    one = rows.agg(F.count("*").alias("total"), F.array(*counted).alias("c")).select("total", F.explode("c").alias("c")).select("c.*", "total")
    keys = duplicate_key_sets(rows, sets).select(F.lit("duplicates").alias("audit"), F.col("key_set").alias("check"), F.col("n_groups").alias("failures"), F.lit(None).cast("double").alias("ok"), F.lit(None).cast("double").alias("warn"), F.col("n_rows").alias("total"))
    by_document = rows.groupBy("document_id").agg(F.count("*").alias("n")).join(docs.select(F.col("id").alias("document_id"), F.lit(True).alias("there")).distinct().hint("merge"), "document_id", "left")
    orphans = by_document.agg(F.coalesce(F.sum(F.when(F.col("there").isNull() & F.col("document_id").isNotNull(), F.col("n"))), F.lit(0)).alias("failures"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    orphans = orphans.select(F.lit("stress").alias("audit"), F.lit("orphans").alias("check"), "failures", F.lit(1e-12).alias("ok"), F.lit(0.0).alias("warn"), "total")
    pct = F.when(F.col("ok").isNotNull(), F.coalesce(F.try_divide(100.0 * F.col("failures"), F.col("total")), F.lit(0.0)))
    status = F.when(F.col("ok").isNull(), F.when(F.col("failures") < 100, "OK").otherwise("REVIEW")).when(F.col("pct") < F.col("ok"), "OK").when(F.col("pct") < F.col("warn"), "WARN").otherwise("BAD")
    return one.unionByName(keys).unionByName(orphans).withColumn("pct", pct).withColumn("status", status).select("audit", "check", "failures", "total", "pct", "status")


def polarity_check(df: DataFrame, liabilities: str) -> DataFrame:
    """Liabilities with a positive price, volumes over 10M, coordinates out of bounds; passes if all are zero."""
    rules = [("liability priced", "error", F.lower("material").rlike(liabilities) & (F.col("price") > 0)), ("volume", "warning", F.col("quantity_tons") > 10_000_000), ("latitude", "error", F.abs("lat") > 90), ("longitude", "error", F.abs("lon") > 180)]
    return checks(df, rules, 1e-12, 1)


def impossible_pairs(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Industry and material words that cannot go together, and zero prices: OK below 0.1 percent, WARN below 1."""
    rules = [(f"{i} with {m}", "error", F.lower("source_industry").contains(i.lower()) & F.lower("material").contains(m.lower())) for i, m in pairs]
    return checks(df, [*rules, ("zero price", "warning", F.col("price") == 0)], 0.1, 1)


def confidence_score(df: DataFrame, company: str, region: str) -> DataFrame:
    """100 less 10 for drifting companies, 20 for safety mismatches, 10 for zero prices (each by its share), over all rows."""
    drift = df.groupBy(company).agg(F.count_distinct(region).alias("n")).agg(F.try_divide(F.count_if(F.col("n") > 1), F.count("*")).alias("drift"))
    rest = df.agg(F.try_divide(F.count_if(F.col("unsafe")), F.count("*")).alias("unsafe"), F.try_divide(F.count_if(F.col("price") == 0), F.count("*")).alias("free"))
    both = drift.join(F.broadcast(rest), F.lit(True))
    return both.withColumn("score", 100 - 10 * F.coalesce("drift", F.lit(0.0)) - 20 * F.coalesce("unsafe", F.lit(0.0)) - 10 * F.coalesce("free", F.lit(0.0)))


def safety_mismatch(df: DataFrame) -> DataFrame:
    bad = F.lower("material").contains("non-hazardous") & F.lower("profile").contains("toxic")
    return df.agg(F.count_if(bad).alias("mismatches"), F.count("*").alias("total"))


def composition_report(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"), F.count_if(F.col("lat").isNotNull() & (F.col("lat") != 0)).alias("geo"), F.count_if("verified").alias("verified"), F.count_if(F.col("price") > 0).alias("priced"), F.count_if(F.col("price") < 0).alias("negative"))


def location_quality(df: DataFrame, location: str = "source_location") -> DataFrame:
    unknown = F.count_if(missing(location) | (F.col(location) == "Unknown"))
    return df.agg(F.count("*").alias("total"), unknown.alias("unknown"), (1 - F.try_divide(unknown, F.count("*"))).alias("quality"))


def readiness_check(df: DataFrame, materials: int = 50, companies: int = 100) -> DataFrame:
    m, c = F.count_distinct("material"), F.count_distinct("source_company")
    return df.agg(m.alias("materials"), c.alias("companies"), F.when((m > materials) & (c > companies), "READY").otherwise("NOT READY").alias("status"))


def financial_outliers(df: DataFrame, amount: str, key: str, limit: float = 1e9) -> DataFrame:
    """Number over the limit, and the row with the greatest amount (ties to the smaller key)."""
    return df.agg(F.count_if(F.col(amount) > limit).alias("outliers"), F.max(amount).alias("greatest"), F.max_by(key, F.struct(amount, -F.col(key))).alias("greatest_key"))


def price_coverage_status(pct: Column) -> Column:
    return F.when(pct < 20, "CRITICAL").when(pct < 50, "SEVERE").when(pct < 90, "PARTIAL").otherwise("GOOD")


def asset_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """name, n of each table."""
    parts = [d.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, d in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
