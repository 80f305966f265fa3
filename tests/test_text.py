"""Unicode forms of texts."""

import random
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wasteflow.operators import text as T

ODD = "aAöé \nÅÅẠ̊́̈́क़़각가각゙かﬁﷺ½² … 漢豈😀\U0001d15e\U0001d400\U00011099\U000110ba\x00"


@pytest.mark.parametrize("form", ["NFC", "NFKC"])
def test_forms_equal_those_of_whole_texts(spark, form):
    """Random texts of characters that join, part and change places, every character by itself, and long runs."""
    rng = random.Random(5)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 12))) for _ in range(4000)] + [None, "", "plain", "́", "x́" * 3000, "e" + "̣́" * 3000]
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts += ["".join(f"a{c}́{c}" for c in points[i : i + 512]) for i in range(0, len(points), 512)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", T.in_form(F.col("t"), form).alias("t"))
    got = dict(df.collect())
    assert all(got[i] == (None if t is None else unicodedata.normalize(form, t)) for i, t in enumerate(texts))


@pytest.mark.parametrize("form", ["NFC", "NFKC"])
def test_python_gets_only_what_a_form_may_change(spark, monkeypatch, form):
    """Before, it got every text that is not ASCII, in batches of 10,000 texts of any length."""
    sent = spark.sparkContext.accumulator(0)
    plain = T.unicode_form

    def watched(form):
        inner = plain(form)

        def normal(a):
            sent.add(a.nbytes)
            return inner.func(a)

        normal.__annotations__ = {"a": pa.Array, "return": pa.Array}
        return F.arrow_udf(normal, "array<string>")

    monkeypatch.setattr(T, "unicode_form", watched)
    df = spark.range(0, 200, 1, 2).select(F.concat(F.repeat(F.lit("Größe und Maß, 漢字 "), 1000), F.lit("Å")).alias("t"))
    assert df.select(T.in_form(F.col("t"), form).alias("t")).where("endswith(t, 'Å') AND length(t) = 18 * 1000 + 1").count() == 200
    assert 0 < sent.value < 200 * 100
