"""Scans of texts by Python."""

import pyarrow as pa
import pytest

import __spark_entry__ as entry
from wasteflow.operators import facts

SF = "/root/testdata/sf0.001"


def test_report_exports_scan_once(spark):
    """The five tables come from one written scan; before, the plan held a scan of all reports for each."""
    plan = entry.queries()["m9_csr_exports"](spark, SF)._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan


def test_scans_give_small_lots_and_read_equal_texts_once(spark):
    """One text with 50,000 hits comes in lots of a few thousand rows; before, a batch's rows were one lot."""
    seen = spark.sparkContext.accumulator(0)

    def find(t):
        seen.add(1)
        return ((w,) for w in t.split())

    df = spark.createDataFrame([(0, "the " * 50_000), (1, None), (2, "")], "k int, t string").coalesce(1)
    lots = facts.scan_texts(df, find, "w string", "k", "t").mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in bs), "n long").collect()
    assert sum(r["n"] for r in lots) == 50_000 and max(r["n"] for r in lots) <= 10_000
    seen.value = 0
    df = spark.range(0, 3000, 1, 1).selectExpr("id AS k", "concat('a b c', id % 3) AS t")
    assert facts.scan_texts(df, find, "w string", "k", "t").count() == 9000 and seen.value == 3


@pytest.mark.parametrize("name", ["d4_rewrite_quantities", "e2_extract_waste"])
def test_patterns_over_quotes_are_dealt(spark, name):
    """A file of one row group is one task; the patterns run after a shuffle by id."""
    assert "RepartitionByExpression [id" in entry.queries()[name](spark, SF)._jdf.queryExecution().analyzed().toString()
