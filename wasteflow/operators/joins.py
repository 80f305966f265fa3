"""Joins and keyed writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def valued_view(listings: DataFrame, mapping: DataFrame, valuations: DataFrame) -> DataFrame:
    """Listings with a quantity, their mapped type and price (null where unmapped), value = round(qty * price, 2)."""
    m = mapping.select(F.lower("waste_material").alias("mk"), "material_type_id", "match_confidence")
    out = listings.where("quantity_tons > 0").join(m, F.lower("material") == F.col("mk"), "left").drop("mk").join(valuations.drop("source_count"), "material_type_id", "left")
    return out.withColumn("estimated_value_usd", F.round(F.col("quantity_tons") * F.col("price_per_ton_usd"), 2))


def priced_listings(listings: DataFrame, mapping: DataFrame, valuations: DataFrame) -> DataFrame:
    return valued_view(listings, mapping, valuations).where("price_per_ton_usd is not null")


def with_document(df: DataFrame, docs: DataFrame, how: str = "left") -> DataFrame:
    d = docs.select(F.col("id").alias("document_id"), F.col("source").alias("document_source"), F.col("source_url").alias("document_url"))
    return df.join(d, "document_id", how)


def orphans(df: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows whose document is missing; a null document id is an orphan."""
    return df.join(docs.select(F.col("id").alias("document_id")), "document_id", "left_anti")


def adopt_orphans(df: DataFrame, docs: DataFrame, recovery_id) -> DataFrame:
    """Orphans get the recovery document."""
    d = docs.select(F.col("id").alias("document_id"), F.lit(True).alias("there")).distinct()
    return df.join(d, "document_id", "left").withColumn("document_id", F.when(F.col("there"), F.col("document_id")).otherwise(F.lit(recovery_id))).drop("there")


def purge_orphans(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.join(docs.select(F.col("id").alias("document_id")), "document_id", "left_semi")


def delete_by_source(df: DataFrame, docs: DataFrame, source: str) -> DataFrame:
    return df.join(docs.where(F.col("source") == source).select(F.col("id").alias("document_id")), "document_id", "left_anti")


def knowledge_profile(knowledge: DataFrame, key: str = "company", order: str = "ord") -> DataFrame:
    """key (lower, trimmed), keywords: the first five distinct, contexts: the first three joined by ` | `, first.

    The first rows are kept by rank before they are gathered, so a group's list is bounded.
    """
    k = F.lower(F.trim(key)).alias("k")
    rows = knowledge.select(k, "keyword", "context", order)
    words = rows.groupBy("k", "keyword").agg(F.min(order).alias(order))
    first = Window.partitionBy("k").orderBy(order)
    words = words.withColumn("r", F.row_number().over(first)).where("r <= 5").groupBy("k").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "keyword"))), lambda x: x["keyword"]), ", ").alias("keywords"))
    texts = rows.withColumn("r", F.row_number().over(first)).where("r <= 3").groupBy("k").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "context"))), lambda x: x["context"]), " | ").alias("contexts"), F.min(order).alias("first"))
    return words.join(texts, "k")


def knowledge_enrich(df: DataFrame, knowledge: DataFrame, company: str = "source_company") -> DataFrame:
    """df with its company's keywords and contexts (null without any)."""
    return df.join(knowledge_profile(knowledge), F.lower(F.trim(company)) == F.col("k"), "left").drop("k", "first")


def match_partners(df: DataFrame, limit: int = 5, exclude_self: bool = False) -> DataFrame:
    """Producers (disposal, quantity) with up to `limit` consumers (recycled) of the same material, by name."""
    c = df.where("treatment_method = 'Recycled' and quantity_tons > 0").select("material", F.col("source_company").alias("consumer")).distinct()
    c = c.withColumn("r", F.row_number().over(Window.partitionBy("material").orderBy("consumer"))).where(F.col("r") <= limit).drop("r")
    p = df.where("treatment_method like '%Disposal%' and quantity_tons > 0").select("material", F.col("source_company").alias("producer")).distinct()
    out = p.join(c, "material")
    return out.where("producer <> consumer") if exclude_self else out


def symbiosis_pairs(ranked: DataFrame, reach: int = 19) -> DataFrame:
    """Pairs of each row with the next `reach` by rank rn (from 1): an equi join on rank bands, so no product of all rows."""
    width = reach + 1
    a = ranked.select(*[F.col(c).alias(f"{c}_a") for c in ranked.columns])
    a = a.withColumn("band", F.explode(F.array(F.floor(F.col("rn_a") / width), F.floor(F.col("rn_a") / width) + 1)))
    b = ranked.select(*[F.col(c).alias(f"{c}_b") for c in ranked.columns]).withColumn("band", F.floor(F.col("rn_b") / width))
    return a.join(b.hint("shuffle_hash"), "band").where(f"rn_b > rn_a and rn_b <= rn_a + {reach}").drop("band")


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    d = lambda x: F.sin(F.radians(x) / 2) * F.sin(F.radians(x) / 2)
    h = d(lat2 - lat1) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * d(lon2 - lon1)
    return 2 * EARTH_KM * F.asin(F.least(F.sqrt(h), F.lit(1.0)))


def radius_search(df: DataFrame, lat: float, lon: float, km: float) -> DataFrame:
    """Rows within km of a point with their distance; a latitude band is filtered first."""
    reach = km / 111.0 + 0.01
    distance = haversine(F.lit(float(lat)), F.lit(float(lon)), F.col("lat"), F.col("lon"))
    return df.where(F.col("lat").between(lat - reach, lat + reach)).withColumn("distance_km", distance).where(F.col("distance_km") <= km)


def degrees_of(km: float) -> float:
    return km / (EARTH_KM * 3.141592653589793 / 180)


def cells_in_band(band: Column, height: float) -> Column:
    """Number of cells of a band of latitudes: cells are at least `height` degrees of a great circle wide, at the band's edge nearer to a pole."""
    south = band * height - 90
    edge = F.least(F.greatest(F.abs(south), F.abs(south + height)), F.lit(90.0))
    return F.greatest(F.lit(1), F.floor(360 * F.cos(F.radians(edge)) / height)).cast("int")


def radius_join(points: DataFrame, centres: DataFrame, km: float, point_id: str = "id", centre_id: str = "centre_id") -> DataFrame:
    """centre_id, point id, distance_km of all points within km of each centre; both tables have lat and lon in degrees.

    The globe is cut into bands of latitude as high as the radius, and bands into cells at least as wide, fewer near the
    poles. A centre goes to every cell that its circle can touch, across the antimeridian and over the poles (a few each); a point is in
    one cell, so that an equi join finds each pair once. Longitudes are taken modulo 360. Rows without a position, or with
    a latitude beyond 90 degrees, meet nothing.
    """
    height = max(degrees_of(km), 1e-4)
    around = lambda lon: F.pmod(lon + 180, F.lit(360.0))
    band_of = lambda lat: F.floor((lat + 90) / height).cast("int")
    valid = F.col("lat").between(-90, 90) & F.col("lon").isNotNull() & (F.abs("lon") < float("inf"))

    p = points.where(valid).select(F.col(point_id).alias("p_id"), F.col("lat").cast("double").alias("p_lat"), F.col("lon").cast("double").alias("p_lon"))
    p = p.withColumn("band", band_of(F.col("p_lat"))).withColumn("cells", cells_in_band(F.col("band"), height))
    p = p.withColumn("cell", F.least(F.floor(around(F.col("p_lon")) / 360 * F.col("cells")).cast("int"), F.col("cells") - 1)).drop("cells")

    r = degrees_of(km) + 1e-6
    c = centres.where(valid).select(F.col(centre_id).alias("c_id"), F.col("lat").cast("double").alias("c_lat"), F.col("lon").cast("double").alias("c_lon"))
    low, high = band_of(F.greatest(F.col("c_lat") - r, F.lit(-90.0))), band_of(F.least(F.col("c_lat") + r, F.lit(90.0)))
    c = c.withColumn("band", F.explode(F.sequence(low, high))).withColumn("cells", cells_in_band(F.col("band"), height))
    # The circle's reach in longitude; all of it where the circle holds a pole.
    reach = F.when(F.abs("c_lat") + r < 90, F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(F.lit(r))) / F.cos(F.radians("c_lat"))))) + 1e-6).otherwise(180.0)
    first = F.floor((around(F.col("c_lon")) - reach) / 360 * F.col("cells")).cast("int")
    last = F.floor((around(F.col("c_lon")) + reach) / 360 * F.col("cells")).cast("int")
    touched = F.sequence(first, F.least(last, first + F.col("cells") - 1))
    c = c.withColumn("cell", F.explode(F.transform(touched, lambda x: F.pmod(x, F.col("cells"))))).drop("cells")

    met = p.join(c.hint("merge"), ["band", "cell"]).withColumn("distance_km", haversine(F.col("c_lat"), F.col("c_lon"), F.col("p_lat"), F.col("p_lon")))
    return met.where(F.col("distance_km") <= km).select(F.col("c_id").alias(centre_id), F.col("p_id").alias(point_id), "distance_km")


def upsert(target: DataFrame, source: DataFrame, key: list[str], order: str, policy: str = "overwrite") -> DataFrame:
    """Target with source's rows inserted or merged by key. Of source rows with one key the last by `order` counts.

    policy overwrite: source's values; coalesce: source's where not null; ignore: target's row stays. Write the result to
    a new path and switch to it: the path that is being read is never overwritten.
    """
    last = source.withColumn("_r", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(order)))).where("_r = 1").drop("_r")
    values = [c for c in target.columns if c not in key]
    s = last.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], *[F.col(c).alias(f"_s_{c}") for c in values], F.lit(True).alias("_in"))
    t = target.withColumn("_there", F.lit(True))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(key)]
    j = t.join(s, on, "full_outer")

    def pick(c: str) -> Column:
        new, old = F.col(f"_s_{c}"), F.col(c)
        if policy == "ignore":
            return F.when(F.col("_there"), old).otherwise(new)
        return F.coalesce(new, old) if policy == "coalesce" else F.when(F.col("_in"), new).otherwise(old)

    return j.select(*[F.when(F.col("_there"), F.col(k)).otherwise(F.col(f"_k{i}")).alias(k) for i, k in enumerate(key)], *[pick(c).alias(c) for c in values])
