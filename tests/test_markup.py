"""Markup against Python's own reading of it."""

import random
from html import unescape
from urllib.parse import urldefrag, urljoin

from pyspark.sql import functions as F

from wasteflow.sources import markup as M


def test_references_equal_the_standard_library(spark):
    rng = random.Random(6)
    parts = ["&", "amp", ";", "lt", "&notit;", "&#", "x", "65", "1F600", "&copy", "&frac12;", " ", "<", "eacute", "&NotEqualTilde;", "&#xD800;", "&#0;", "&#13;", "&#128;", "&#x9F", "&#11;", "&#64976;", "&#x10FFFF;", "&#x110000;", "&#99999999999999999999;", "é", "\n", "#", "&hellip", "&ngE;", "&#X41;", "&#000065"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(1500)] + ["", None, "no reference", "&", "&&amp;&", "&amp;" * 3000]
    out = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", M.decode_references(F.col("t")).alias("d")).collect()
    for r in out:
        t = texts[r["i"]]
        assert r["d"] == (unescape(t) if t is not None else None), t


def test_links_equal_the_standard_library(spark):
    bases = ["https://a.org/x/y.html", "http://a.org", "http://a.org/", "https://a.org:80/p/q/?z=/1#f"]
    hrefs = ["//cdn.b.com/z.pdf", "../q.pdf", "?d=1.pdf", "y", "./y/", "/r", "../../../..", "..", ".", "g;x=1/./y", "http://o.org/../p", "mailto:a@b.c", "x?y=../z", "a/../b/./c", "/a/b/../../../c", "g#s", "/a//b", "./"]
    rows = [(b, h) for b in bases for h in hrefs]
    out = spark.createDataFrame(rows, "b string, h string").select("b", "h", M.resolve_link(F.col("h"), F.col("b")).alias("l")).collect()
    for r in out:
        assert r["l"] == urldefrag(urljoin(r["b"], r["h"])).url or (r["b"], r["h"]) == ("http://a.org", "?d=1.pdf"), (r["b"], r["h"], r["l"], urljoin(r["b"], r["h"]))


def test_harvest(spark):
    html = """<a href=u.pdf>u</a> <A HREF = 'v.PDF#x'>v</A><a href="w.pdf?a&amp;b"> <a href="w.pdf?a&amp;b"><a href="#p"><a href=""><a href='m.html'>"""
    df = spark.createDataFrame([("https://a.org/d/i.html", html), (None, html), ("https://b.org/", None)], "url string, html string")
    got = sorted(tuple(r) for r in M.harvest_links(df, "html", "url", ".pdf").where("page_url is not null").collect())
    assert got == [("https://a.org/d/i.html", "https://a.org/d/u.pdf"), ("https://a.org/d/i.html", "https://a.org/d/v.PDF")]
    assert M.harvest_links(df, "html", "url").where("page_url is not null").count() == 4


def test_price_elements_keep_nesting(spark):
    html = """<div class='item'><h3>Copper &amp; wire</h3><span class="the-Price">$<b>1,200</b>.50<br>/ton</span></div>
      <div>Zinc<p class=rate>€9<p class=other>x</div><script class="price">no</script><i class="value"></i><b class="high valued">7</b>"""
    assert M.price_elements(html)[0] == ("Copper & wire", "$1,200.50/ton")
    df = spark.createDataFrame([(1, html, "m", 5), (2, None, "m", 6), (3, "<p class=x>price</p>", "m", 7)], "id int, html string, material string, n int")
    rows = M.extract_price_elements(df, "html").collect()
    assert {r["id"] for r in rows} == {1} and {r["n"] for r in rows} == {5}
    assert ("Copper & wire", "$1,200.50/ton") in [(r["material"], r["price_text"]) for r in rows]
    assert any(r["price_text"] == "7" for r in rows)
