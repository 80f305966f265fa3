"""Training-data and report exports. Frames in, lines out; writers take a path and a format."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .aggregates import top_n_per_group


def export(df: DataFrame, path: str, fmt: str, order: list | None = None) -> None:
    """Writes jsonl, csv (header, nulls empty) or parquet, sorted within range partitions if an order is given."""
    out = df.orderBy(*order) if order else df
    if fmt == "jsonl":
        out.write.json(path, ignoreNullFields=False, dateFormat="yyyy-MM-dd")
    elif fmt == "csv":
        out.write.csv(path, header=True, nullValue="", dateFormat="yyyy-MM-dd")
    else:
        out.write.parquet(path)


def corpus_lines(df: DataFrame) -> DataFrame:
    """id, line: a sentence for each listing."""
    line = F.format_string("%s generated %.2f tons of %s in %d (%s).", "source_company", F.col("quantity_tons").cast("double"), "material", "year", "treatment_method")
    return df.where("material is not null and source_company is not null").select("id", line.alias("line"))


def chat_examples(df: DataFrame, category) -> DataFrame:
    """material, messages: a classification dialogue as JSON for each distinct material."""
    say = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    m = df.select("material").where("material is not null").distinct().withColumn("category", category)
    talk = F.array(say("user", F.concat(F.lit("Classify: "), "material")), say("assistant", F.col("category")))
    return m.select("material", F.to_json(F.struct(talk.alias("messages"))).alias("messages"))


def graph_edges(df: DataFrame, category, least: float = 10) -> DataFrame:
    """source, relation, target, weight: GENERATES (tons), IS_CATEGORY and LOCATED_IN of listings above `least` tons."""
    edge = lambda s, r, t, w: F.struct(s.alias("source"), F.lit(r).alias("relation"), t.alias("target"), w.cast("double").alias("weight"))
    one = F.lit(1.0)
    edges = F.array(edge(F.col("source_company"), "GENERATES", F.col("material"), F.col("quantity_tons")), edge(F.col("material"), "IS_CATEGORY", category, one), edge(F.col("source_company"), "LOCATED_IN", F.col("source_location"), one))
    out = df.where(F.col("quantity_tons") > least).select(F.inline(edges)).where("source is not null and target is not null")
    return out.groupBy("source", "relation", "target").agg(F.when(F.col("relation") == "GENERATES", F.sum("weight")).otherwise(1.0).alias("weight"))


def qa_pairs(df: DataFrame, limit: int = 50) -> DataFrame:
    """material, question, answer: who generates it (up to `limit` companies by name) and how much there is."""
    names = top_n_per_group(df.where("material is not null").select("material", "source_company").distinct(), "material", ["source_company"], limit)
    who = names.groupBy("material").agg(F.array_join(F.array_sort(F.collect_list("source_company")), ", ").alias("answer")).select("material", F.concat(F.lit("Who generates "), "material", F.lit("?")).alias("question"), "answer")
    much = df.where("material is not null").groupBy("material").agg(F.sum("quantity_tons").cast("double").alias("t")).select("material", F.concat(F.lit("How much "), "material", F.lit(" is there?")).alias("question"), F.format_string("%.2f tons", "t").alias("answer"))
    return who.unionByName(much)


def listing_jsonl(df: DataFrame) -> DataFrame:
    """line: all fields as text or null."""
    return df.select(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in df.columns]), {"ignoreNullFields": "false"}).alias("line"))


def portfolio_qa(grid: DataFrame, profiles: DataFrame) -> DataFrame:
    """industry, country, answer: the bounded profile list (material, total_tons) rendered for each place."""
    one = profiles.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("total_tons")).alias("o"), "material"))), lambda x: x["material"]), ", ").alias("answer"))
    return grid.join(F.broadcast(one), F.lit(True))


def pairs_jsonl(pairs: DataFrame) -> DataFrame:
    """line for each producer and material with its consumers."""
    g = pairs.groupBy("material", "producer").agg(F.array_sort(F.collect_set("consumer")).alias("consumers"))
    return g.select(F.to_json(F.struct("material", "producer", "consumers")).alias("line"))


def csr_exports(facts: DataFrame) -> dict[str, DataFrame]:
    """One typed frame a fact table."""
    return {k: facts.where(F.col("fact") == k).drop("fact") for k in ("waste", "emission", "energy", "financial", "carbon_credit")}


def batched_sink(df: DataFrame, send: Callable[[list[dict]], None], size: int = 1000) -> None:
    """Calls send with up to `size` rows at a time from every partition. send must be idempotent by key: tasks can run again."""

    def part(rows: Iterator[Row]) -> None:
        batch: list[dict] = []
        for r in rows:
            batch.append(r.asDict())
            if len(batch) == size:
                send(batch)
                batch = []
        if batch:
            send(batch)

    df.foreachPartition(part)
