"""Registry of the analytics queries and their SQL oracles: one key per operator, `<row>_<name>`."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import Tables, oracle

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}
_MODULES = ("normalize", "pricing", "relational", "aggregates", "audits", "text", "facts", "search", "exports", "intake")


def query(name: str, sql: str | None = None):
    """Registers fn(tables) under name, with an oracle if SQL can express it."""

    def register(fn: Callable[[Tables], DataFrame]):
        _QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql:
            _ORACLES[name] = oracle(sql)
        return fn

    return register


def load() -> None:
    for m in _MODULES:
        importlib.import_module(f"wasteflow.plans.{m}")


def queries() -> dict:
    load()
    return _QUERIES


def oracle_sql() -> dict:
    load()
    return _ORACLES


def best_alike_sql(over: str, threshold: float = 85) -> str:
    """CTE best(name, match, score) of n(name) and r(match): equal names, else the best ratio of longest common subsequences of sorted words.

    The subsequence's length comes from one bit for each character of x: a character of y clears the bits it can extend.
    """
    words = "array_to_string(list_sort(list_filter(string_split_regex({0}, '\\s+'), lambda w: w <> '')), ' ')"
    mask = "list_aggregate(list_transform(range(length(x)), lambda i: CASE WHEN x[i + 1] = c THEN 1::HUGEINT << i::INT ELSE 0::HUGEINT END), 'bit_or')"
    step = "((row + (row & m)) | (row - (row & m))) & ((1::HUGEINT << length(x)::INT) - 1)"
    masks = f"list_transform(string_split(y, ''), lambda c: {mask})"
    row = f"list_reduce(list_prepend((1::HUGEINT << length(x)::INT) - 1, {masks}), lambda row, m: {step})"
    return f"""l AS (SELECT name, {words.format("name")} AS x FROM n WHERE name NOT IN (SELECT match FROM r)), k AS (SELECT match, {words.format("match")} AS y FROM r),
    scored AS (SELECT name, match, 200.0::DOUBLE * (length(x) - bit_count({row})) / (length(x) + length(y)) AS score FROM l JOIN k ON 200 * least(length(x), length(y)) >= {threshold} * (length(x) + length(y))),
    best AS (SELECT name, match, score FROM scored WHERE score {over} {threshold} QUALIFY row_number() OVER (PARTITION BY name ORDER BY score DESC, match) = 1
      UNION ALL SELECT name, name, 100 FROM n WHERE name IN (SELECT match FROM r))"""
