"""Corpus pipeline: language ID, exact dedup, near-duplicate join, secret scan, packing.

Each stage takes (spark, docs, sf_dir) and gets the table that the stage before it wrote. All but the last return the
columns of documents. Null, empty and repeated rows have the results that the operators' docstrings define.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wasteflow.llm.common import few, materialize, with_row_key
from wasteflow.llm.exact_dedup import exact_groups
from wasteflow.llm.jaccard import jaccard_components
from wasteflow.llm.langid import held_out, predict, train_profiles
from wasteflow.llm.packing import pack_documents
from wasteflow.llm.secrets import redact

VOCAB = "byte_bpe_50k.json"
ROW = "pipeline_row_key"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in which a language is recognised; those without text or letters go."""
    found = predict(docs, train_profiles(docs.where(~held_out())))
    return found.where("lang_pred <> 'und'").select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal text, one with the largest id stays; rows may share an id or have none."""
    keyed = with_row_key(docs, ROW, "pipeline-exact-rows")
    dropped = exact_groups(keyed, row_col=ROW).where("row_id <> keep_row").select(F.col("row_id").alias("drop"))
    return without(keyed, dropped).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicate rows (five words, similarity 0.8), one with the smallest id stays, a null id last."""
    keyed = with_row_key(docs, ROW, "pipeline-near-rows")
    found = jaccard_components(keyed, width=5, percent=80, id_col=ROW).select(F.col("doc_id").alias("row"), "component_id")
    found = materialize(found, "pipeline-near-found")
    ids = keyed.select(F.col(ROW).alias("row"), "doc_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    kept = found.join(ids.hint("merge"), "row").groupBy("component_id").agg(first.alias("first")).select(F.col("first.row").alias("row"))
    return without(keyed, found.join(kept.hint("merge"), "row", "left_anti").select(F.col("row").alias("drop"))).select(*docs.columns)


def without(keyed: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows whose key is not in dropped."""
    dropped = materialize(dropped, "pipeline-dropped")
    return keyed.join(few(dropped), F.col(ROW) == F.col("drop"), "left_anti")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret in a text gives way to a mark; all documents stay, and those without secrets are unchanged."""
    return redact(docs, public_tokenizers.path(VOCAB))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of packed sequences."""
    return pack_documents(docs, public_tokenizers.path(VOCAB))


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("secrets", secrets), ("packing", pack)]

#: SQL cannot express the language, secret and packing stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; what each returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
