"""Projection, filters, aggregates, ranking and set operations over listings-shaped tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written


def clean_filter(df: DataFrame, first: int = 1970, last: int = 2025) -> DataFrame:
    """Rows with a material, a positive quantity and a year within the limits."""
    return df.where((F.col("material") != "") & (F.col("quantity_tons") > 0) & F.col("year").between(first, last))


def full_entries(df: DataFrame, fields: list[str]) -> DataFrame:
    return df.where(" and ".join(f"`{f}` is not null" for f in fields))


def keyword_filter(df: DataFrame, column: str, words: list[str]) -> DataFrame:
    return df.where(F.greatest(*[F.lower(column).contains(w.lower()) for w in words], F.lit(False)))


def numeric_or_short(c: Column) -> Column:
    return c.rlike("^[0-9]+$") | (F.length(c) < 2)


def source_label(quote: Column, rules: list[tuple[str, str]], default: str = "other") -> Column:
    """Label of the first LIKE pattern that the quote matches."""
    return F.coalesce(*[F.when(quote.like(p), label) for p, label in rules], F.lit(default))


def country_or_tail(country: Column, location: Column) -> Column:
    return F.coalesce(country, F.split_part(location, F.lit(", "), F.lit(2)))


def column_density(df: DataFrame) -> DataFrame:
    """column, pct of rows where it is not null, over all rows in one pass."""
    one = df.agg(*[(100.0 * F.count(c) / F.count("*")).alias(c) for c in df.columns])
    return one.unpivot([], df.columns, "column", "pct")


def coerce_upload(df: DataFrame, defaults: dict[str, float], flags: list[str] = ()) -> DataFrame:
    """Numbers from text with a default, where zero counts as missing for a default other than zero; flags to boolean."""
    for c, d in defaults.items():
        number = F.col(c).try_cast("double")
        df = df.withColumn(c, F.coalesce(F.when(number != 0, number) if d else number, F.lit(float(d))))
    for c in flags:
        df = df.withColumn(c, F.lower(F.col(c).cast("string")).isin("true", "1", "yes"))
    return df


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Required columns first, then the rest; raises if one is missing."""
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*required, *[c for c in df.columns if c not in required])


def clip_strings(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.substring(c, 1, n) for c, n in limits.items()})


def profile_components(profile: Column) -> Column:
    """Struct names, hazards from a JSON profile {composition: [{name}], hazards: [..]}."""
    p = F.from_json(profile, "composition array<struct<name:string>>, hazards array<string>")
    return F.struct(F.array_join(F.transform(p["composition"], lambda x: x["name"]), ", ").alias("names"), p["hazards"].alias("hazards"))


def schema_report(df: DataFrame, critical: list[str]) -> DataFrame:
    """column, type, critical."""
    return df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString(), f.name in critical) for f in df.schema], "column string, type string, critical boolean")


def grouped(df: DataFrame, keys: list[str], **aggs: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def first_values(df: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """key, values: the first n distinct values of each key, by name, as sorted text. No key's values are gathered beyond n."""
    d = df.where(F.col(value).isNotNull()).select(key, F.col(value).cast("string").alias("v")).distinct()
    d = d.withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy("v"))).where(F.col("r") <= n)
    return d.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list("v")), "|").alias("values"))


def material_profile(df: DataFrame, least: int = 2, top: int = 2000, companies: int = 10, locations: int = 5, treatments: int = 100) -> DataFrame:
    """The `top` materials by sum of those with at least `least` rows.

    Count, mean, sum, years, and the first companies (50 characters of each), locations (countries where df has no locations)
    and treatments by name as sorted text, empty if all are null. Rows without a material are left out.
    """
    place = "source_location" if "source_location" in df.columns else "source_country"
    rows = df.where("material is not null and material <> ''")
    g = rows.groupBy("material").agg(F.count("*").alias("n"), F.avg(F.col("quantity_tons").cast("double")).alias("avg_tons"), F.sum("quantity_tons").cast("double").alias("total_tons"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    out = g.where(F.col("n") >= least).orderBy(F.desc_nulls_last("total_tons"), "material").limit(top)
    cut = rows.withColumn("wf_company", F.substring("source_company", 1, 50))
    for name, column, n in (("companies", "wf_company", companies), ("locations", place, locations), ("treatments", "treatment_method", treatments)):
        found = first_values(cut, "material", column, n).select(F.col("material").alias("of"), F.col("values").alias(name))
        out = out.join(found.hint("merge"), F.col("material") == F.col("of"), "left").drop("of").fillna("", [name])
    return out


def string_agg_profile(df: DataFrame, keys: list[str]) -> DataFrame:
    g = df.groupBy(*keys).agg(F.sum("quantity_tons").cast("double").alias("total_tons"), F.avg(F.col("quantity_tons").cast("double")).alias("avg_tons"), F.array_join(F.array_sort(F.collect_set("treatment_method")), ", ").alias("treatments"))
    return g.where("total_tons > 0")


def distinct_counts(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    f = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(F.count("*").alias("n"), *[f(c).alias(f"n_{c}") for c in columns])


def value_by_category(df: DataFrame, mapping: DataFrame, valuations: DataFrame, category: Column) -> DataFrame:
    """Category: listings, distinct materials, tons and value of the mapped and priced listings.

    Listings are summed by material first, so the joins see materials, not listings.
    """
    per = df.where("quantity_tons > 0").groupBy("material").agg(F.count("*").alias("n"), F.sum("quantity_tons").alias("tons"))
    m = mapping.select(F.lower("waste_material").alias("k"), "material_type_id")
    j = per.join(m, F.lower("material") == F.col("k")).join(valuations.select("material_type_id", "price_per_ton_usd"), "material_type_id")
    return j.groupBy(category.alias("category")).agg(F.sum("n").alias("listings"), F.count_distinct("material").alias("materials"), F.sum("tons").cast("double").alias("total_tons"), F.sum(F.col("tons") * F.col("price_per_ton_usd")).cast("double").alias("value_usd"))


def distinct_years(df: DataFrame, key: str, year: str) -> DataFrame:
    return df.groupBy(key).agg(F.count_distinct(year).alias("n_years"))


FINE, LOG = 1 << 16, 1 << 10  # intervals of one refinement, and of a power of two in the first one


def exact_median(df: DataFrame, value: Column) -> DataFrame:
    """median of the values that are not null, exactly (null without any; NaN counts as infinity): one row.

    Equal values are counted before the shuffle. Then intervals of values are counted, first in steps of the logarithm and
    three times linearly within the interval that holds the middle, until one double is left. A task sees the values of its part
    or the counts of the intervals, never all values.
    """
    v = value.cast("double")
    counts = df.select(F.when(F.isnan(v), float("inf")).otherwise(v).alias("v")).where("v is not null").groupBy("v").agg(F.count("*").alias("n"))
    counts = written(counts, "median-counts")  # read once for each refinement
    total = counts.agg(F.sum("n").alias("total")).where("total > 0")
    # The ranks of the two middle values, from 1; the same one if their number is odd.
    wanted = total.select(F.explode(F.array(*[F.struct(F.lit(i).alias("q"), (F.floor((F.col("total") - 1 + i) / 2) + 1).alias("rank")) for i in (0, 1)])).alias("w")).select("w.*")
    both = counts.select("v", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("q"))
    infinite = F.abs("v") == float("inf")
    log = F.when(infinite, F.signum("v") * (1 << 30)).otherwise(F.signum("v") * (F.floor(F.log2(F.abs("v") + 1e-300) * LOG) + LOG * 1000))
    by_log = F.floor(log).cast("long")
    span = F.col("high") / 2 - F.col("low") / 2
    linear = F.coalesce(F.floor(F.try_divide(F.col("v") / 2 - F.col("low") / 2, span) * FINE), F.lit(0)).cast("long")

    def narrow(rows: DataFrame, interval: Column) -> DataFrame:
        """q, rank within the interval of the wanted value, its least and greatest value."""
        g = rows.groupBy("q", interval.alias("interval")).agg(F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        w = Window.partitionBy("q").orderBy("interval")
        g = g.withColumn("until", F.sum("n").over(w)).join(F.broadcast(target.select("q", "rank")), "q")
        return g.where((F.col("until") >= F.col("rank")) & (F.col("until") - F.col("n") < F.col("rank"))).select("q", (F.col("rank") - F.col("until") + F.col("n")).alias("rank"), "low", "high")

    target = wanted
    target = narrow(both, by_log)
    for _ in range(3):
        inner = both.join(F.broadcast(target.select("q", "low", "high")), "q").where("v between low and high")
        target = narrow(inner, linear)
    return target.agg(F.avg("low").alias("median"))


def quantity_stats(df: DataFrame, c: str, extreme: float = 1e6) -> DataFrame:
    """mean, median, low, high, negatives, extremes of a column: one row."""
    v = F.col(c).cast("double")
    rest = df.agg(F.avg(v).alias("mean"), F.min(v).alias("low"), F.max(v).alias("high"), F.count_if(v < 0).alias("negatives"), F.count_if(v > extreme).alias("extremes"))
    return rest.join(F.broadcast(exact_median(df, v))).select("mean", "median", "low", "high", "negatives", "extremes")


def distinct_key_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct keys (nulls count) and the share of repeated rows in percent."""
    d = F.count_distinct(F.struct(*keys))
    return df.agg(F.count("*").alias("n"), d.alias("n_keys"), F.try_divide(100.0 * (F.count("*") - d), F.count("*")).alias("dup_pct"))


def value_counts(df: DataFrame, c: str, n: int) -> DataFrame:
    return df.groupBy(c).count().orderBy(F.desc("count"), c).limit(n)


def token_estimate(df: DataFrame, columns: list[str], per: float = 4) -> DataFrame:
    return df.agg(F.sum(F.length(F.concat_ws("", *columns))).alias("chars"), (F.sum(F.length(F.concat_ws("", *columns))) / per).alias("tokens"))


def category_distribution(df: DataFrame, column: str, label: Column) -> DataFrame:
    """Share of distinct values by label, with the first two as samples."""
    d = df.select(F.col(column).alias("v")).where("v is not null").distinct().withColumn("label", label)
    first = d.withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy("v"))).groupBy("label").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("r") <= 2, F.col("v")))), ", ").alias("samples"))
    total = d.agg(F.count("*").alias("total"))
    return first.join(F.broadcast(total), F.lit(True)).withColumn("pct", 100.0 * F.col("n") / F.col("total")).drop("total")


def distinct_on(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row of each key by order."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def cumulative_share(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n largest groups with running sum and share of all rows; the window runs over n rows only."""
    g = df.groupBy(key).count()
    top = g.orderBy(F.desc("count"), key).limit(n)
    run = Window.partitionBy(F.lit(0)).orderBy(F.desc("count"), key).rowsBetween(Window.unboundedPreceding, 0)
    out = top.withColumn("running", F.sum("count").over(run))
    return out.join(F.broadcast(g.agg(F.sum("count").alias("total"))), F.lit(True)).withColumn("running_pct", 100.0 * F.col("running") / F.col("total")).drop("total")


def top_n_per_group(df: DataFrame, group: str, order: list, n: int) -> DataFrame:
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rn") <= n)


def neighbour_rank(df: DataFrame, order: list, n: int) -> DataFrame:
    """rn from 1 over the first n rows in order."""
    top = df.orderBy(*order).limit(n)
    return top.withColumn("rn", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows that are the same in each run: the smallest by a digest of key and seed."""
    return df.orderBy(F.md5(F.concat_ws(":", key, F.lit(seed))), key).limit(n)


def top_contributor(df: DataFrame, key: str) -> DataFrame:
    g = df.groupBy(key).count()
    best = g.agg(F.max(F.struct("count", key)).alias("b"), F.sum("count").alias("total"))
    share = 100.0 * F.col("b.count") / F.col("total")
    return best.select(F.col(f"b.{key}").alias("top"), F.col("b.count").alias("n"), share.alias("pct"), F.when(share > 50, "WARN").otherwise("OK").alias("status"))


def bounded_per_category(df: DataFrame, category: str, order: list, each: int = 3, total: int = 5) -> DataFrame:
    """The first `each` rows of each category, `total` in all."""
    return top_n_per_group(df, category, order, each).drop("rn").orderBy(*order).limit(total)


def unified_export(listings: DataFrame, carbon: DataFrame, exchanges: DataFrame) -> DataFrame:
    """record_type, content, source_company, year of three tables."""
    a = listings.select(F.lit("waste").alias("record_type"), F.concat_ws(" ", "material", "treatment_method").alias("content"), "source_company", "year")
    b = carbon.select(F.lit("carbon").alias("record_type"), F.concat(F.lit("CO2 "), F.col("co2_tons").cast("string")).alias("content"), F.col("company").alias("source_company"), "year")
    c = exchanges.select(F.lit("exchange").alias("record_type"), F.concat_ws(" to ", "source_company", "target_company").alias("content"), "source_company", "year")
    return a.unionByName(b).unionByName(c)


def overlap(a: DataFrame, b: DataFrame, x: str, y: str) -> DataFrame:
    """Sizes of the exact and of the lower-cased, trimmed intersection."""
    clean = lambda d, c: d.select(F.lower(F.trim(c)).alias("k"))
    exact = a.select(F.col(x).alias("k")).intersect(b.select(F.col(y).alias("k"))).agg(F.count("k").alias("exact"))
    loose = clean(a, x).intersect(clean(b, y)).agg(F.count("k").alias("loose"))
    return exact.join(F.broadcast(loose), F.lit(True))


def union_count(a: DataFrame, b: DataFrame, x: str, y: str) -> DataFrame:
    return a.select(F.col(x).alias("k")).union(b.select(F.col(y).alias("k"))).where("k is not null").distinct().agg(F.count("*").alias("n"))
