"""Keyword classification of a column by ordered rules (label, keywords)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hit(col: Column, keyword: str, match: str = "contains") -> Column:
    """Whether lower-cased col holds keyword: anywhere, or as a word of its own."""
    return F.lower(col).contains(keyword.lower()) if match == "contains" else F.lower(col).rlike(rf"\b{re.escape(keyword.lower())}\b")


def classify(col: Column, rules, default: str | None = None, match: str = "contains") -> Column:
    """Label of the first keyword found, in rule order; default where none is, or col is null. No shuffle, no join."""
    found = [F.when(hit(col, k, match), F.lit(label)) for label, keywords in rules for k in keywords]
    return F.coalesce(*found, F.lit(default))


def classify_best(col: Column, rules) -> Column:
    """Struct label, confidence of the rule (keyword, label, confidence) with the highest confidence; earlier rules win ties."""
    found = [F.when(hit(col, k), F.struct(F.lit(float(c)).alias("confidence"), F.lit(-i).alias("place"), F.lit(label).alias("label"))) for i, (k, label, c) in enumerate(rules)]
    best = F.array_max(F.array_compact(F.array(*found)))
    return F.struct(best["label"].alias("label"), best["confidence"].alias("confidence"))


def classify_tiered(col: Column, tiers) -> Column:
    """Struct label, confidence by tiers (rules, confidence): the first tier with a hit; a tier's rules may be one label for all rows."""
    parts = []
    for rules, confidence in tiers:
        label = F.lit(rules) if isinstance(rules, str) else classify(col, rules)
        parts.append(F.when(label.isNotNull(), F.struct(label.alias("label"), F.lit(float(confidence)).alias("confidence"))))
    return F.coalesce(*parts)


def by_value(df: DataFrame, column: str, target: str, value: Column) -> DataFrame:
    """df with target: value, an expression of column alone, evaluated once for each distinct value and joined by it.

    For long rule lists over few values, as materials and places are. The distinct values come out of a shuffle, so the
    join is chosen by their real size; a null value is joined as one.
    """
    values = df.select(F.col(column).alias("wf_value")).distinct().select("wf_value", value.alias(target))
    return df.drop(target).join(values, F.col(column).eqNullSafe(F.col("wf_value")), "left").drop("wf_value")


def backfill(df: DataFrame, target: str, value: Column) -> DataFrame:
    """Fills only rows where target is null."""
    return df.withColumn(target, F.coalesce(F.col(target), value))


def sql_case(expr: str, rules, default: str | None = None) -> str:
    """The first-hit rule as SQL text."""
    when = " ".join(f"WHEN contains(lower({expr}), '{k.lower()}') THEN '{label}'" for label, keywords in rules for k in keywords)
    return f"CASE {when} ELSE {'NULL' if default is None else repr(default)} END"
