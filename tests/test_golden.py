"""Known values of the operators, and edge cases."""

import datetime

import pytest
from pyspark.sql import functions as F

from wasteflow import rules as R
from wasteflow.operators import aggregates as A
from wasteflow.operators import csr
from wasteflow.operators import exports as X
from wasteflow.operators import facts as E
from wasteflow.operators import joins as J
from wasteflow.operators import names as names_of
from wasteflow.operators import normalize as N
from wasteflow.operators import pricing as P
from wasteflow.operators import text as T
from wasteflow.operators.classify import classify
from wasteflow.sources import readers as S
from wasteflow.streaming import intake as I


def one(spark, col, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(col.alias("r")).first()["r"]


@pytest.mark.parametrize("value,unit,want", [(1000.0, "kg", 1.0), (1.0, "ton", 0.9072), (2000.0, "lbs", 0.9072), (5.0, "tonnes", 5.0), (3.0, "barrels", 3.0)])
def test_tons(spark, value, unit, want):
    got = one(spark, N.to_metric_tons(F.col("v"), F.col("u")), v=value, u=unit)
    assert got["value"] == want and got["unit"] == ("barrels" if unit == "barrels" else "metric_ton")


def test_quantities(spark):
    got = one(spark, N.extract_quantities(F.col("t")), t="The facility processed 5,000 tonnes of steel and 250 kg of copper.")
    assert [(q["value"], q["unit"], q["tons"]) for q in got] == [(5000.0, "tonnes", 5000.0), (250.0, "kg", 0.25)]


@pytest.mark.parametrize("text,want", [("05/03/2021", (2021, 3, 5)), ("12/31/2021", (2021, 12, 31)), ("March 5, 2021", (2021, 3, 5)), ("FY2019 report", (2019, 1, 1)), ("none", None)])
def test_dates(spark, text, want):
    assert one(spark, N.parse_date(F.col("t")), t=text) == (datetime.date(*want) if want else None)


@pytest.mark.parametrize("text,want", [("Copper scrap", "metals"), ("HDPE plastic", "plastics"), ("Fly ash", "construction"), ("Steam", "energy")])
def test_categories(spark, text, want):
    assert one(spark, classify(F.col("t"), R.CATEGORIES), t=text) == want


def test_type_id_price_and_schema(spark):
    assert one(spark, N.material_type_id(F.col("t")), t="copper bare bright") == "CU-BAREBRIG"
    assert round(one(spark, P.price_per_ton(F.col("p"), F.col("u")), p=4.89, u="lb"), 2) == 10780.61
    assert one(spark, E.detect_schema(F.col("t")), t="CO2 at Kalundborg Symbiosis") == "carbon_emission"


def test_industry_value(spark):
    prices = spark.createDataFrame([(m, float(a), float(b), c) for m, a, b, c in R.REFERENCE_PRICES], "material string, price_low double, price_high double, co2_factor double")
    profile = spark.createDataFrame([("Automotive", m, float(p)) for m, p in R.AUTOMOTIVE], "industry string, material string, percent double")
    tiers = spark.createDataFrame([(k, float(v)) for k, v in R.TIERS.items()], "tier string, tons double")
    regions = spark.createDataFrame(list(R.REGIONS.items()), "region string, modifier double")
    got = P.industry_calculator(profile, prices, tiers, regions).where("tier = 'medium' and region = 'north_america'").first()
    assert round(got["value"]) == 2041250 and got["tons"] == 5000


def test_compatibility(spark):
    got = one(spark, P.compatibility_score(F.lit("metals"), F.lit("metals"), F.array(F.lit("a")), F.array(F.lit("b"))))
    assert (got["material"], got["geo"], got["combined"]) == (0.95, 0.2, 0.72)


def test_report_facts():
    facts = csr.facts_of("In 2022 we recycled 45,000 tonnes of plastic waste. We disposed 15,000 tonnes of hazardous waste. Scope 1: 1,200,000 tCO2e. Scope 2: 850,000 tCO2e. Scope 3: 450,000 tCO2e. EUR 8.5 million spent; $5.2M savings.")
    waste = {(f[1], f[3]) for f in facts if f[0] == "waste"}
    assert {("recycled", 45000.0), ("disposed", 15000.0)} <= waste
    assert {(f[1], f[3]) for f in facts if f[0] == "emission"} >= {("scope 1", 1.2e6), ("scope 2", 8.5e5), ("scope 3", 4.5e5)}
    assert {f[3] for f in facts if f[0] == "financial"} >= {8.5e6, 5.2e6}


def test_validation(spark):
    rows = [(1, "steel", 5.0, 1969, "a long enough quote", 0.9), (2, "steel", 0.0, 2000, "a long enough quote", 0.9), (3, "steel", 5.0, 2000, "a long enough quote", 0.6), (4, "steel", 5.0, 2000, "short", 0.9), (5, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "id int, material string, quantity_tons double, year int, source_quote string, extraction_confidence double")
    got = {r["id"]: r["violations"] for r in E.validate_waste(df).collect()}
    assert got == {1: ["year"], 2: ["quantity"], 3: [], 4: ["quote"], 5: ["confidence", "material", "quantity", "quote", "year"]}
    assert one(spark, E.scope_check(F.lit(100.0), F.lit(60.0), F.lit(60.0)))


def test_cleaning(spark):
    page = "<html><nav>Menu</nav><div class='cookie'>Cookie text</div><article><p>5,000 tonnes of fly ash — “good”</p></article><footer>Privacy Policy</footer></html>"
    got = spark.createDataFrame([(page,)], "h string").select(T.clean_html(F.col("h")).alias("t")).first()["t"]
    assert got == '5,000 tonnes of fly ash - "good"'
    assert one(spark, T.fix_mojibake(F.col("t")), t="cafÃ©") == "café"


def test_upsert_policies_and_idempotence(spark):
    t = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "k int, v string, w string")
    s = spark.createDataFrame([(2, None, "y", 1), (2, "c", None, 2), (3, "d", "z", 1)], "k int, v string, w string, o int")
    rows = lambda p: sorted((r["k"], r["v"], r["w"]) for r in J.upsert(t, s, ["k"], "o", p).collect())
    assert rows("overwrite") == [(1, "a", None), (2, "c", None), (3, "d", "z")]
    assert rows("coalesce") == [(1, "a", None), (2, "c", "x"), (3, "d", "z")]
    assert rows("ignore") == [(1, "a", None), (2, "b", "x"), (3, "d", "z")]
    again = J.upsert(J.upsert(t, s, ["k"], "o"), s, ["k"], "o")
    assert sorted((r["k"], r["v"]) for r in again.collect()) == [(1, "a"), (2, "c"), (3, "d")]


@pytest.mark.parametrize("threshold, inclusive", [(85, False), (85, True), (70, True), (50, False)])
def test_fuzzy_join_loses_no_pair(spark, threshold, inclusive):
    import random

    rng = random.Random(threshold)
    base = ["siemens", "abc", "ab cd ef", "aaaaaaaa", "", " ", "x", "zinc works ab", "Ärzte bund", "a b c d e f g"]

    def changed(t):
        for _ in range(rng.randint(1, 3)):
            i = rng.randint(0, len(t))
            t = t[:i] + rng.choice(["", "a", "b", " ", "x"]) + t[i + rng.randint(0, 1) :]
        return t

    names = {"sietens", *(changed(rng.choice(base)) for _ in range(80))}
    refs = {*base, *(changed(rng.choice(base)) for _ in range(40))}
    want = {}
    for n in names:
        found = sorted((-100.0 if r == n else -names_of.token_sort_ratio(n, r), r != n, r) for r in refs if r == n or (names_of.token_sort_ratio(n, r) >= threshold if inclusive else names_of.token_sort_ratio(n, r) > threshold))
        if found:
            want[n] = (n, 100.0) if n in refs else (found[0][2], -found[0][0])
    left, right = (spark.createDataFrame([(x,) for x in v], f"{c} string") for v, c in ((names, "n"), (refs, "r")))
    out = names_of.fuzzy_join(left, right, "n", "r", threshold, inclusive).collect()
    assert len(out) == len(want) and {r["name"]: (r["match"], r["score"]) for r in out} == want
    assert "sietens" in want


def test_fuzzy_names(spark):
    left = spark.createDataFrame([("steel works acme",), ("Acme Steel",), ("nothing like",), (None,)], "n string")
    right = spark.createDataFrame([("acme steel works",), ("Acme Steel",)], "r string")
    got = {r["name"]: (r["match"], r["score"]) for r in names_of.fuzzy_join(left, right, "n", "r").collect()}
    assert got == {"steel works acme": ("acme steel works", 100.0), "Acme Steel": ("Acme Steel", 100.0)}
    assert names_of.indel_ratio("abcd", "abxd") == 75.0


def test_csv_and_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,x\n2\n3,z,extra\n")
    assert S.read_listing_csv(spark, str(tmp_path / "a.csv"), "a int, b string").count() == 3
    df = spark.createDataFrame([(1, 2, 3)], "`1. YEAR` int, `Facility Name` int, Chemical int")
    assert S.map_headers(df, [S.RELEASE_ALIASES]).columns == ["year", "company", "material"]
    with pytest.raises(ValueError):
        S.map_headers(df.select("Chemical"), [S.RELEASE_ALIASES])
    assert S.guess_column(["x", "Waste Type", "material"], ["material", "waste"]) == "Waste Type"
    assert S.guess_column(["x", "Waste Type", "material"], ["material", "waste"], "words") == "material"


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, f"text {i % 7}", datetime.datetime(2024, 1, 1, i % 24)) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, text string, ts timestamp")
    df.repartition(2).write.parquet(str(tmp_path / "in"))
    seen = []
    q = I.stream_documents(spark, str(tmp_path / "in"), df.schema, lambda d, _: seen.extend(r["id"] for r in d.collect()), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert sorted(seen) == list(range(40))
    stream = I.stream_dedup(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "text", "ts")
    w = stream.writeStream.format("memory").queryName("deduped").trigger(availableNow=True).start()
    w.awaitTermination(60)
    assert spark.table("deduped").count() == I.stream_dedup(df, "text", "ts").count() == 7


def test_exports_write(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    for fmt in ("jsonl", "csv", "parquet"):
        X.export(df, str(tmp_path / fmt), fmt, ["a"])
    assert spark.read.json(str(tmp_path / "jsonl")).count() == 2 and spark.read.parquet(str(tmp_path / "parquet")).count() == 2
    out = tmp_path / "sent"
    out.mkdir()

    def send(batch):
        for r in batch:
            (out / str(r["a"])).write_text(str(r["b"]))

    X.batched_sink(df, send, 1)
    assert sorted(f.name for f in out.iterdir()) == ["1", "2"]


def test_empty_tables(spark):
    df = spark.createDataFrame([], "id long, material string, source_company string, quantity_tons decimal(15,2), year int, treatment_method string, source_country string")
    assert A.distinct_on(df, ["material"], ["id"]).count() == 0 and A.material_profile(df).count() == 0
    assert A.distinct_key_count(df, ["material"]).first()["n"] == 0
    assert J.match_partners(df).count() == 0


def test_schema_report(spark):
    df = spark.createDataFrame([(1, "a")], "a int, b string")
    assert sorted(map(tuple, A.schema_report(df, ["b"]).collect())) == [("a", "int", False), ("b", "string", True)]


def test_chunks_and_years_reach_the_end_of_the_text(spark):
    from wasteflow.operators import vectors as V

    texts = {1: "a" * 49, 2: "b" * 50, 3: "cd" * 4000, 4: "ef" * 10000 + "é", 5: None, 6: ""}
    df = spark.createDataFrame(list(texts.items()), "id int, text string")
    out = {}
    for r in V.chunk_for_embedding(df, "text").orderBy("id", "chunk_index").collect():
        out.setdefault(r["id"], []).append(r["chunk"])
    assert {i: list(map(len, c)) for i, c in out.items()} == {2: [50], 3: [8000], 4: [8000, 8000, 4001]}
    assert all("".join(c) == texts[i] for i, c in out.items())
    late = spark.createDataFrame([("report.pdf", "in 2011 " + "x" * 3000 + " 2017 end")], "name string, text string")
    assert late.select(S.year_from_name(F.col("name"), F.col("text")).alias("y")).first()["y"] == 2017


def test_mapping_tables(spark):
    from wasteflow import material_tables as M

    rows = spark.createDataFrame([(m,) for m in ("non-hazardous waste", "petroleum", "Copper wire", "iron alloy (cast iron)", "moon dust", "battery lead", None)], "m string")

    def got(mode, rules):
        return {r["material"]: (r["material_type_id"], r["match_confidence"]) for r in P.map_materials(rows, "m", mode, rules).collect()}

    tiered, smart, best = got("tiered", M.TIERED_RULES), got("smart", M.SMART_RULES), got("best", M.BEST_RULES)
    assert tiered["non-hazardous waste"] == ("CHEM-HAZ", 0.6) and tiered["moon dust"] == ("CHEM-NONHAZ", 0.4) and tiered["Copper wire"] == ("CU-BAREBRGHT", 0.8)
    assert smart["petroleum"] == ("PLASTICS", 0.9) and smart["moon dust"] == ("UNCLASSIFIED", 0.4)
    assert best["Copper wire"] == ("CU-BAREBRGHT", 0.95) and best["battery lead"] == ("PB-SOLID", 0.95) and "moon dust" not in best
    assert len(M.CATEGORY_PRICES) == 31 and {label for label, _ in M.SMART_RULES} <= {c for c, _ in M.CATEGORY_PRICES}


def test_quantities_are_rewritten(spark):
    texts = ["1,234.5 kg and 2 tons, 7 barrels", "no unit 5", "10 Metric Tons|100 tonnes", None, ""]
    out = [r["t"] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", N.rewrite_quantities(F.col("t")).alias("t")).orderBy("i").collect()]
    assert out[0].startswith("1.2345 metric_ton and ") and out[0].endswith(" metric_ton, 7 barrels")
    assert out[1:] == ["no unit 5", "10 metric_ton|100 metric_ton", None, ""]


def test_exact_median(spark):
    import random
    import statistics

    rng = random.Random(3)
    for values in ([], [5.0], [2.0, 1.0], [rng.gauss(0, 1e9) for _ in range(301)], [rng.choice([0.0, -0.5, 1e-300, 3.0]) for _ in range(200)], [1e308, -1e308, 1.0, 1.0000000000000002], [1.0 + i * 2**-52 for i in range(50)] * 3):
        df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
        assert A.exact_median(df, F.col("v")).first()["median"] == (statistics.median(values) if values else None)


def test_radius_join_at_poles_and_antimeridian(spark):
    import itertools
    import math

    places = [(90.0, 0.0), (-90.0, 10.0), (89.5, 170.0), (0.0, 180.0), (0.0, -179.9), (10.0, 359.0), (10.0, -1.0), (-89.0, -60.0), (-88.9, 120.0), (45.0, 45.0), (45.2, 45.2), (0.1, 179.8)]
    rows = spark.createDataFrame([(i, la, lo) for i, (la, lo) in enumerate(places)] + [(99, None, 1.0), (98, 95.0, 1.0)], "id int, lat double, lon double")

    def apart(a, b):
        (la, lo), (lb, lp) = ([math.radians(x) for x in p] for p in (a, b))
        h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
        return 2 * 6371 * math.asin(min(1, math.sqrt(h)))

    for km in (1, 50, 300, 2500, 25000):
        out = [(r["centre_id"], r["id"]) for r in J.radius_join(rows, rows.withColumnRenamed("id", "centre_id"), km).collect()]
        assert len(out) == len(set(out))
        assert set(out) == {(i, j) for (i, a), (j, b) in itertools.product(enumerate(places), repeat=2) if apart(a, b) <= km}
