"""Operator 3: classes against brute force, nesting, main slots and malformed pages."""

from __future__ import annotations

import random
import time
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from wasteflow.llm import extraction
from wasteflow.llm.extraction import Page, extract_main_text, main_text, places

SCHEMA = "page_id long, url string, html string"


def alone(html: str) -> str:
    p = Page(html)
    return main_text(p.codes, p.kinds, p.texts, None, False, [], [])


def words(rng, n):
    return " ".join(rng.choice(("ore", "slag", "ash", "lime", "sand", "mud", "salt", "scrap")) + str(rng.randrange(99)) for _ in range(n))


def site(rng, i):
    """A page whose article is a plain element between variable links and a variable list, with a first heading outside."""
    items = "".join(f"<li>{words(rng, 1)}</li>" for _ in range(rng.randrange(1, 4)))
    text = [words(rng, 40) for _ in range(rng.randrange(2, 6))]
    body = "".join(f"<div>{t}</div>" for t in text)
    html = f"<html><body><h1>Title {i}</h1><div id=top>Welcome</div><div class=x1>{body}</div><div class=x2><ul>{items}</ul></div><div>All rights</div></body></html>"
    return html, " ".join([f"Title {i}", *text])


def test_template_finds_plain_elements(spark):
    rng = random.Random(3)
    made = [site(rng, i) for i in range(40)]
    rows = [(i, "http://plain.example/a", html) for i, (html, _) in enumerate(made)]
    rows += [(100 + i, "http://plain.example/b", rows[7][2]) for i in range(60)]  # copies of a page are no template
    out = {r["page_id"]: r["text"] for r in extract_main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(out) == 100
    assert [out[i] for i in range(40)] == [t for _, t in made]
    assert {out[100 + i] for i in range(60)} == {made[7][1]}


def test_classes_by_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, f"http://h{i % 3}.example/", site(rng, i)[0] if i % 7 else f"<p>odd {i}<div><span>one") for i in range(60)]
    pages = spark.createDataFrame(rows, SCHEMA).withColumn("host", extraction.host_of(F.col("url")))
    found = extraction.equivalence_classes(extraction.parse_pages(pages)).collect()
    vectors = defaultdict(lambda: [0] * len(rows))
    for i, _, html in rows:
        for t, n in Counter(Page(html).codes).items():
            vectors[f"h{i % 3}.example", t][i] = n
    often = {k: tuple(v) for k, v in vectors.items() if sum(map(bool, v)) >= 10}
    assert {(r["host"], r["token"]) for r in found} == set(often)
    by_vector, by_class = defaultdict(set), defaultdict(set)
    for (host, t), v in often.items():
        by_vector[host, v].add(t)
    for r in found:
        by_class[r["host"], r["cls"]].add(r["token"])
    assert sorted(map(sorted, by_vector.values())) == sorted(map(sorted, by_class.values()))
    assert all(r["size"] == len(by_class[r["host"], r["cls"]]) for r in found)


def test_places():
    classes = {1: 10, 2: 10, 3: 20, 4: 20, 5: 30, 6: 30}
    sizes = {10: 2, 20: 2, 30: 2}
    # 20 twice in the only slot of 10, 30 after it
    assert places([1, 3, 4, 3, 4, 2, 5, 6], classes, sizes) == {10: ([1, 2], None, None), 20: ([3, 4], 10, 0), 30: ([5, 6], None, None)}
    # 20 begins in 10 and ends outside: it does not nest; 30 comes in two orders
    found = places([1, 3, 2, 4, 5, 6, 6, 5], classes, sizes)
    assert found[10] == ([1, 2], None, None) and found[20] == (None, None, None) and found[30] == (None, None, None)
    assert places([], classes, sizes) == {} and places([1], classes, sizes) == {10: (None, None, None)}


def test_pages_alone():
    assert alone("<article><p>One<p class='legal'>two<p class='share-price'>Share price rose <math><mi>x</mi></math> up</article>") == "One two Share price rose x up"
    assert alone("<body><article><p>teaser</p></article><div><p>the real body of this page</p></div></body>") == "teaser the real body of this page"
    for name in ("layout has-sidebar", "no-comments", "page-header-fixed"):
        assert alone(f"<body><div class='{name}'><nav>Home</nav><article><h1>A</h1><p>b</article></div><footer>f</footer></body>") == "A b"
    assert alone("<article><h1>A</h1><p>b</p><section class='comments'><article class='comment'>Nice</article></section></article>") == "A b"
    assert alone("<p>a<b>b</b> <script>x</script>c<br>d &eacute;\n\t e<style>y</style><ul><li>f<li>g</ul>") == "ab c d é e f g"
    assert alone("") == alone("<div> </div>") == alone("<!-- a -->") == ""
    assert alone("plain &amp; open <b") == "plain & open <b" or alone("plain &amp; open <b").startswith("plain & open")


def test_malformed_pages_are_linear():
    start = time.time()
    assert alone("<span>" * 100_000 + "x" + "</div>" * 100_000) == "x"
    assert alone("<div>" * 50_000 + "y" + "<p>" * 50_000) == "y"
    assert alone("<p><b>" * 50_000 + "z") == "z"
    assert len(alone("<article><p>" + "word " * 400_000)) == 5 * 400_000 - 1
    assert time.time() - start < 20
