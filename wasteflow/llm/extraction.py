"""Operator 3: main text of web pages by template deduction over equivalence classes of tokens.

A page is a sequence of tokens: opening and closing tags by their path in the page, and blocks of text by path and
content. Tokens of a host's pages that occur equally often on every page, that is with one occurrence vector, form an
equivalence class. Copies of a page count once. A class is valid if, on most of its pages, its tokens come in one order
(repeated as a whole), nest with the other classes, and stand in one slot of the same class. Valid classes, nested by
these slots, are the host's template; what lies between template tokens are the slots.

The main slots lie within the deepest template element that holds nearly all text of all slots, or the deepest article
or main element that holds half of it; headings of the first level belong to them wherever they are. Template text in
there is left out; within an article or main element only if it stands on nearly all of many different pages. Where no template element was found, or a page
is not of the template, the page's own article or main element with half of its text counts, else all of its text.

Elements such as nav, footer or script never hold main text. Class, id and role words only break ties: they part
containers such as comments or adverts, unless a first heading or an article stands in them.

Occurrence vectors are never held: a class is known by the sum of page hashes times counts, which merges in any order,
so hosts of any size are counted token by token with partial sums. Pages are parsed once and their tokens written.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few, map_rows, materialize

# Element names and words of class, id and role that mark what is not main text.
HIDDEN = frozenset(("head", "script", "style", "noscript", "template", "svg", "iframe", "object", "embed", "canvas", "audio", "video", "select", "option", "textarea", "form", "nav", "header", "footer", "aside", "menu", "dialog"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
BLOCK = frozenset((
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html",
    "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
))
CONTAINER = frozenset(("article", "body", "center", "div", "fieldset", "main", "section", "table", "td"))
MAIN = frozenset(("article", "main"))
BOILER = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|alert|popup|modal|nav\w*|menu|breadcrumbs?|header|masthead|footer|sidebar|widget|related|recommend\w*|share|sharing|social"
    r"|newsletter|subscri\w*|signup|login|comments?|replies|reply|discussion|respond|disqus|copyright|legal|pagination|pager|toolbar|skip)(?:$|[\s_-])",
    re.I,
)
CLOSED_BY = {"p": BLOCK - {"br"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
MARKED = frozenset(("dl", "ol", "ul")) | CONTAINER - {"body"}  # elements that class words can part
DIGITS = re.compile(r"\d+")

OPEN, CLOSE, TEXT = 0, 1, 2  # kinds of tokens, with marks:
PARTED, NAMED, HEADING, HOLDER, FIRST = 4, 8, 16, 32, 64  # not main; article or main; first heading; container; first of its code on the page

SUPPORT = 0.5  # least share of a host's pages for a class, and of a class's pages for its order and place
COVER = 0.95  # least share of the slots' text in a main element; half of it for an article or main element
INSIDE = 0.9  # least share for template text inside the main slots
PAGES = 3  # least number of different pages for a template
PAGES_INSIDE = 20
SMALL_TEMPLATES = 32 << 20  # bytes of all hosts' lists up to which they are broadcast
SALTS = 32


def code(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\0".join(parts)) - (1 << 63)


@lru_cache(1 << 14)
def below(path: int, name: str, marks: str) -> int:
    return code(str(path), name, DIGITS.sub("0", marks))


class Page(HTMLParser):
    """Tokens of a page in order: codes, kinds and the texts of its text tokens. A closing tag's code is ~ its opening's."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.codes: list[int] = []
        self.kinds: list[int] = []
        self.texts: list[str] = []
        self.open: list[list] = []  # name, path, number of the token, hidden, in main, marked, with an anchor
        self.blocks: list[int] = []  # places of open block elements
        self.names: dict[str, int] = {}  # how many of a name are open
        self.parts: list[str] = []
        self.at = -1
        self.feed(html)
        self.close()
        while self.open:
            self.leave()
        self.flush()
        self.mark()

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.codes[self.at] = code(str(self.codes[self.at]), text)
            self.texts.append(text)
            self.parts = []

    def token(self, number: int, kind: int) -> None:
        self.codes.append(number)
        self.kinds.append(kind)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.flush()
            while self.blocks and tag in CLOSED_BY.get(self.open[self.blocks[-1]][0], ()):
                self.leave_to(self.blocks[-1])
        if tag in VOID:
            return
        _, path, _, hidden, main, _, _ = self.open[-1] if self.open else (None, 0, 0, False, False, False, False)
        marks = " ".join(v for k, v in attrs if v and k in ("class", "id", "role", "aria-label")) if attrs else ""
        gone = attrs and any(k == "hidden" or (k == "style" and v and "display:none" in v.replace(" ", "").lower()) for k, v in attrs)
        boiler = bool(marks and tag not in ("html", "body") and BOILER.search(marks))
        named = tag in MAIN and not boiler
        hidden = hidden or bool(gone) or (tag in HIDDEN and not (tag == "header" and main))
        path = below(path, tag, marks)
        if tag in BLOCK:
            self.blocks.append(len(self.open))
        self.open.append([tag, path, len(self.codes), hidden, main or named, boiler and tag in MARKED, named or tag == "h1"])
        self.names[tag] = self.names.get(tag, 0) + 1
        self.token(path, OPEN | (NAMED if named else 0) | (HOLDER if tag in CONTAINER else 0))

    def handle_startendtag(self, tag, attrs):
        if tag in BLOCK:
            self.flush()

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.flush()
        if self.names.get(tag):
            place = len(self.open) - 1
            while self.open[place][0] != tag:
                place -= 1
            self.leave_to(place)

    def leave_to(self, place: int) -> None:
        while len(self.open) > place:
            self.leave()

    def leave(self) -> None:
        tag, path, number, _, _, marked, anchored = self.open.pop()
        self.names[tag] -= 1
        if tag in BLOCK:
            self.flush()
            self.blocks.pop()
        if self.open:
            self.open[-1][6] |= anchored
        if marked and not anchored:
            self.kinds[number] |= PARTED
        self.token(~path, CLOSE)

    def handle_data(self, data):
        if self.open and self.open[-1][3]:
            return
        if not self.parts:
            if data.isspace():
                return
            block = self.open[self.blocks[-1]] if self.blocks else ("", 0)
            self.at = len(self.codes)
            self.token(block[1], TEXT | (HEADING if block[0] == "h1" else 0))
        self.parts.append(data)

    def mark(self) -> None:
        """Hands the mark of a parted element down to its texts, and marks the first token of each code."""
        parted: list[bool] = []
        seen: set[int] = set()
        for i, (number, kind) in enumerate(zip(self.codes, self.kinds)):
            if kind & 3 == OPEN:
                parted.append(bool(kind & PARTED) or bool(parted and parted[-1]))
            elif kind & 3 == CLOSE:
                parted.pop()
            elif parted and parted[-1]:
                self.kinds[i] |= PARTED
            if number not in seen:
                seen.add(number)
                self.kinds[i] |= FIRST

    def digest(self) -> int:
        """Of the texts that may be main."""
        texts = iter(self.texts)
        return code(*(t for k in self.kinds if k & 3 == TEXT and (t := next(texts)) is not None and not k & PARTED))


def host_of(url: F.Column) -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), F.lit(""))


def parse_pages(source: DataFrame) -> DataFrame:
    """page_id, url, host, digest, codes, kinds, texts and a row number of every page; written."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            found = [Page(h or "") for h in b["html"]]
            yield {"page_id": b["page_id"], "url": b["url"], "host": b["host"], "digest": [p.digest() for p in found], "codes": [p.codes for p in found], "kinds": [p.kinds for p in found], "texts": [p.texts for p in found]}

    kind = dict(source.dtypes)["page_id"]
    parsed = map_rows(source, run, f"page_id {kind}, url string, host string, digest long, codes array<long>, kinds array<tinyint>, texts array<string>")
    return materialize(parsed.withColumn("row", F.monotonically_increasing_id()), "page-tokens", compression="zstd")


def with_lists(pages: DataFrame, lists: DataFrame, size: F.Column) -> DataFrame:
    """pages with the row of lists (written; at most one a host) of their host: broadcast if all lists are small, else by host and salt."""
    total = lists.agg(F.coalesce(F.sum(F.length("host") + size + 64), F.lit(0))).first()[0]
    if total <= SMALL_TEMPLATES:
        return pages.join(F.broadcast(lists), "host", "left")
    salted = lists.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return pages.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(salted.hint("merge"), ["host", "salt"], "left").drop("salt")


def equivalence_classes(pages: DataFrame) -> DataFrame:
    """host, token, is_text, n_pages, pages, cls, size: the tokens on at least SUPPORT of their host's pages; written."""
    tokens = pages.select("host", "digest", F.explode(F.arrays_zip("codes", "kinds")).alias("t")).select("host", "digest", "t.codes", "t.kinds")
    # A token's occurrence vector as its sum of page hashes times counts, with the number of pages and occurrences.
    vector = F.sum(F.xxhash64("digest").cast("decimal(38,0)")).alias("vector")
    seen = tokens.groupBy("host", F.col("codes").alias("token"), (F.col("kinds").bitwiseAND(3) == TEXT).alias("is_text"))
    seen = seen.agg(vector, F.count_if(F.col("kinds").bitwiseAND(FIRST) > 0).alias("pages"), F.count("*").alias("occurrences")).where(F.col("pages") >= PAGES)
    hosts = materialize(pages.groupBy("host").agg(F.count("*").alias("n_pages")).where(F.col("n_pages") >= PAGES), "template-hosts")
    often = with_lists(seen.withColumn("row", F.xxhash64("token")), hosts, F.lit(8)).where(F.col("pages") >= F.ceil(F.col("n_pages") * SUPPORT))
    often = materialize(often.select("host", "token", "is_text", "n_pages", "pages", F.xxhash64("vector", "pages", "occurrences").alias("cls")), "template-tokens")
    size = often.groupBy("host", "cls").agg(F.count("*").alias("size"))
    return materialize(often.join(size.hint("merge"), ["host", "cls"]), "template-classes")


def places(codes: list[int], classes: dict[int, int], sizes: dict[int, int]) -> dict[int, tuple]:
    """For each class on the page: its order (None if it has no fixed one or does not nest) and the class and slot it stands in."""
    order: dict[int, list[int]] = {}
    index: dict[int, dict[int, int]] = {}
    count: dict[int, int] = {}
    where: dict[int, tuple] = {}
    bad: set[int] = set()
    stack: list[int] = []
    slot: dict[int, int] = {}
    for t in codes:
        c = classes.get(t)
        if c is None or c in bad:
            continue
        m, n = sizes[c], count.get(c, 0)
        if n < m:
            if t in index.setdefault(c, {}):
                bad.add(c)
                continue
            index[c][t] = n
            order.setdefault(c, []).append(t)
        elif index[c].get(t) != n % m:
            bad.add(c)
            continue
        count[c] = n + 1
        while stack and stack[-1] in bad:
            stack.pop()
        if n % m == 0:
            if c not in where:
                where[c] = (stack[-1], slot[stack[-1]]) if stack else (None, None)
            if m > 1:
                stack.append(c)
        slot[c] = n % m
        if m > 1 and n % m == m - 1:
            # What began within this class and is still open does not nest.
            while stack[-1] != c:
                bad.add(stack.pop())
            stack.pop()
    bad.update(stack)
    bad.update(c for c, n in count.items() if n % sizes[c])
    return {c: (None, None, None) if c in bad else (order[c], *where.get(c, (None, None))) for c in order}


def shares(codes: list[int], kinds: list[int], texts: list[str], known: set[int]) -> tuple[dict[int, list], int]:
    """Characters of slot text in each container element (with depth and whether it is article or main), and of the page."""
    found: dict[int, list] = {}
    stack: list[list] = []  # code, kind, characters
    held, total = iter(texts), 0
    for t, k in zip(codes, kinds):
        if k & 3 == OPEN:
            stack.append([t, k, 0])
        elif k & 3 == TEXT:
            n = len(next(held))
            if not k & PARTED and t not in known:
                total += n
                if stack:
                    stack[-1][2] += n
        else:
            o, ok, n = stack.pop()
            if ok & HOLDER:
                at = found.setdefault(o, [0, len(stack), bool(ok & NAMED)])
                # An element within one of its own code cannot be: codes hold the depth.
                at[0] += n
            if stack:
                stack[-1][2] += n
    return found, total


def deduce_templates(pages: DataFrame) -> DataFrame:
    """host, main (code of the main element, or null), named (whether it is an article or main element), outer, inner (template texts on SUPPORT and on INSIDE of the pages); written."""
    keyed = pages.select("row", F.xxhash64("host", "digest").alias("key"))
    many = materialize(keyed.groupBy("key").agg(F.min("row").alias("first"), F.count("*").alias("n")).where("n > 1"), "page-copied")
    copies = keyed.join(few(many.select("key")), "key", "left_semi").join(few(many.select("first")), F.col("row") == F.col("first"), "left_anti")
    copies = materialize(copies.select(F.col("row").alias("copy")), "page-copies")
    different = pages.join(few(copies), F.col("row") == F.col("copy"), "left_anti")
    classes = equivalence_classes(different)
    # A host's list is bounded: a token on a share SUPPORT of the pages leaves room for 1 / SUPPORT pages' tokens.
    lists = classes.groupBy("host").agg(F.collect_list(F.struct("token", "is_text", "cls", "size")).alias("list"))
    lists = materialize(lists, "template-lists")

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        tables: dict[str, tuple] = {}
        for b in batches:
            sums: dict[tuple, int] = {}
            for host, codes, kinds, texts, found in zip(b["host"], b["codes"], b["kinds"], b["texts"], b["list"]):
                if found is None:
                    continue
                if host not in tables:
                    tables = {host: ({r["token"]: r["cls"] for r in found}, {r["cls"]: r["size"] for r in found}, {r["token"] for r in found if r["is_text"]})} | (tables if len(tables) < 64 else {})
                of, sizes, known = tables[host]
                for c, (order, parent, slot) in places(codes, of, sizes).items():
                    key = (host, c, None if order is None else tuple(order), parent, slot, None)
                    sums[key] = sums.get(key, 0) + 1
                held, total = shares(codes, kinds, texts, known)
                for o, (n, depth, named) in held.items():
                    if o in of and ~o in of and n:
                        key = (host, None, None, o, depth, named)
                        sums[key] = sums.get(key, 0) + n
                key = (host, None, None, None, None, None)
                sums[key] = sums.get(key, 0) + total
            keys = list(sums)
            yield {c: [k[i] for k in keys] for i, c in enumerate(("host", "cls", "order", "parent", "slot", "named"))} | {"n": list(sums.values())}

    listed = with_lists(different.select("host", "row", "codes", "kinds", "texts"), lists, 32 * F.size("list")).select("host", "codes", "kinds", "texts", "list")
    found = map_rows(listed, run, "host string, cls long, order array<long>, parent long, slot int, named boolean, n long")
    found = materialize(found.groupBy("host", "cls", "order", "parent", "slot", "named").agg(F.sum("n").alias("n")), "template-places")

    # A class is valid if one order in one place stands for most of its pages.
    best = F.max(F.struct(F.when(F.col("order").isNotNull(), F.col("n")).otherwise(0).alias("n"), "order")).alias("best")
    valid = found.where("cls is not null").groupBy("host", "cls").agg(best, F.sum("n").alias("pages")).where(F.col("best.n") >= F.col("pages") * SUPPORT)
    tokens = materialize(classes.join(valid.select("host", "cls").hint("merge"), ["host", "cls"]), "template")
    total = found.where("cls is null and parent is null").select("host", F.col("n").alias("total"))
    tags = tokens.where("not is_text").select("host", F.col("token").alias("parent"))
    closes = tags.select("host", F.expr("~parent").alias("parent"))
    held = found.where("cls is null and parent is not null").select("host", "parent", "slot", "named", "n")
    held = held.join(tags.hint("merge"), ["host", "parent"], "left_semi").join(closes.hint("merge"), ["host", "parent"], "left_semi").join(total.hint("merge"), "host")
    held = held.where(F.col("n") >= F.col("total") * F.when(F.col("named"), 0.5).otherwise(COVER))
    main = held.groupBy("host").agg(F.max(F.struct("named", "slot", "n", "parent")).alias("best")).select("host", F.col("best.parent").alias("main"), F.col("best.named"))
    inside = (F.col("pages") >= F.ceil(F.col("n_pages") * INSIDE)) & (F.col("n_pages") >= PAGES_INSIDE)
    texts = tokens.where("is_text").groupBy("host").agg(F.collect_list("token").alias("outer"), F.collect_list(F.when(inside, F.col("token"))).alias("inner"))
    return materialize(main.join(texts.hint("merge"), "host", "full"), "templates")


def main_text(codes: list[int], kinds: list[int], texts: list[str], main: int | None, named: bool, outer: list[int], inner: list[int]) -> str:
    """The text of the main slots, blocks joined by one space; named: whether main is an article or main element."""
    within = {main}
    if main is None or main not in codes:
        held, total = shares(codes, kinds, texts, set(outer))
        within = {o for o, (n, _, own) in held.items() if own and 2 * n >= total}
        named = bool(within)
    gone = set(inner if named else outer)
    kept, depth, held = [], 0, iter(texts)
    for t, k in zip(codes, kinds):
        if k & 3 == TEXT:
            text = next(held)
            if not k & PARTED and t not in gone and (depth or not within or k & HEADING):
                kept.append(text)
        elif (t if k & 3 == OPEN else ~t) in within:
            depth += 1 if k & 3 == OPEN else -1
    return " ".join(kept)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Null html counts as empty, with empty text; a null url belongs to the host ''. Pages of hosts with too few
    different pages have no template and go by their own elements. Repeated rows give a row each; other columns are
    ignored; an empty table gives no rows.
    """
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).withColumn("host", host_of(F.col("url")))
    parsed = parse_pages(source)
    templates = deduce_templates(parsed)
    size = 8 * (F.coalesce(F.size("outer"), F.lit(0)) + F.coalesce(F.size("inner"), F.lit(0)))
    columns = ("page_id", "url", "codes", "kinds", "texts")
    joined = with_lists(parsed.select("host", "row", *columns), templates, size).select(*columns, "main", "named", "outer", "inner")

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for b in batches:
            texts = [main_text(c, k, t, m, own, o or (), i or ()) for c, k, t, m, own, o, i in zip(*(b[n] for n in ("codes", "kinds", "texts", "main", "named", "outer", "inner")))]
            yield {"page_id": b["page_id"], "url": b["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    kinds = dict(pages.dtypes)
    return map_rows(joined, run, f"page_id {kinds[id_col]}, url string, text string, n_chars long")
