"""Operator 8: n-gram Jaccard join by grouped prefixes.

Two sets can only reach the threshold if their prefixes share a token: the first n - ceil(t * n) + 1 tokens in one
global order. The order puts rare tokens first, by a sketch of counts over all documents (a fixed number of
counters; any order gives the same links, a good one gives few candidates). Documents with one set collapse into
one, documents with one prefix and size into a group. Groups that share a token are candidates.

In every token's list of groups all are first compared with one hub: the group in whose prefix the token stands first,
that is the one with the fewest rarer tokens, as an original has among its altered copies. That links most of what can
be linked, without all pairs of a list. A hub is done with then. Of the other groups, only pairs meet that lie in
different components, have fitting sizes, and can still share enough from this token on, and they meet by token, size
band and side, not each with each. Group pairs that are left are expanded, and their members compared exactly.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, few, map_rows, materialize
from .components import connected_components
from .shingling import shingle_sets

SKETCH_BITS = 22
CHUNK_BITS = 12
PAIRS_PER_ROW = 200  # comparisons of two rows of a token, on average, that the last join may make without another round of hubs
HUB_ROUNDS = 6
WORTHWHILE = 0.75
HOT_CLASS = 17  # tokens counted less than 2 ** (HOT_CLASS - 1) times are not hot
MIN_TASKS = 8
SETS_PER_TASK = 500


def shingles(text: str | None, width: int) -> np.ndarray:
    return shingle_sets([text], width)[0]


def needed(na, nb, percent: int):
    """Smallest intersection that links sets of these sizes: 100 * i >= percent * (na + nb - i)."""
    return -(-percent * (na + nb) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def fits(percent: int, na: str, a: str, nb: str, b: str) -> Column:
    """Whether two sets of sizes na, nb with a common token at places a, b of their order can link, if it is their first one."""
    sizes = f"100 * least({na}, {nb}) >= {percent} * greatest({na}, {nb})"
    return F.expr(f"{sizes} and {100 + percent} * least({na} - {a}, {nb} - {b}) >= {percent} * ({na} + {nb})")


def token_sketch(texts: DataFrame, width: int, bits: int = SKETCH_BITS) -> np.ndarray:
    """Class (bits of the count) of each counter, over all documents; its size does not depend on the input."""

    def count(batches: Iterator[dict]) -> Iterator[dict]:
        counters = np.zeros(1 << bits, np.uint32)
        for b in batches:
            for tokens in shingle_sets(b["text"], width):
                counters[tokens >> np.uint64(64 - bits)] += np.uint32(1)  # distinct counters of one document count once
        for i in range(0, len(counters), 1 << CHUNK_BITS):
            chunk = counters[i : i + (1 << CHUNK_BITS)]
            if chunk.any():
                yield {"chunk": [i >> CHUNK_BITS], "counts": [zlib.compress(chunk.tobytes(), 1)]}

    def add(batches: Iterator[dict]) -> Iterator[dict]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for chunk, counts in zip(b["chunk"], b["counts"]):
                sums.setdefault(chunk, np.zeros(1 << CHUNK_BITS, np.uint64))
                sums[chunk] += np.frombuffer(zlib.decompress(counts), np.uint32)
        for chunk, total in sums.items():
            yield {"chunk": [chunk], "classes": [np.ceil(np.log2(total + 1.0)).astype(np.uint8).tobytes()]}

    parts = map_rows(texts.select("text"), count, "chunk int, counts binary")
    n = 1 << max(0, bits - CHUNK_BITS - 4)
    out = np.zeros(1 << bits, np.uint8)
    for r in map_rows(parts.repartition(n, "chunk"), add, "chunk int, classes binary").collect():
        out[r["chunk"] << CHUNK_BITS : (r["chunk"] + 1) << CHUNK_BITS] = np.frombuffer(r["classes"], np.uint8)
    return np.minimum(out, 31)


def prefix(tokens: np.ndarray, classes: np.ndarray, percent: int) -> np.ndarray:
    """The first tokens as keys whose numeric order is the global one: class first, then 58 bits of the hash; sorted."""
    bits = len(classes).bit_length() - 1
    keys = (classes[tokens >> np.uint64(64 - bits)].astype(np.uint64) << np.uint64(58) | tokens >> np.uint64(6)).astype(np.int64)
    n = prefix_length(len(tokens), percent)
    return np.sort(np.partition(keys, n - 1)[:n])


def describe(source: DataFrame, width: int, percent: int, sketch_bits: int, hot_class: int) -> tuple[DataFrame, int]:
    """row (differs in all rows), doc_id, n, content (digest of the set), prefix, prefix_key (its digest) of every document;
    and the class from which tokens count as hot: at least hot_class, and above what most counters hold."""
    sketch = token_sketch(source, width, sketch_bits)
    hot = max(hot_class, int(np.median(sketch)) + 2)
    classes = source.sparkSession.sparkContext.broadcast(sketch)  # 2 ** sketch_bits bytes

    def run(batches):
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            out = {k: [] for k in ("n", "content", "prefix", "prefix_key")}
            for tokens in shingle_sets(b["text"], width):
                first = prefix(tokens, classes.value, percent).tobytes() if len(tokens) else b""
                out["n"].append(len(tokens))
                out["content"].append(xxhash.xxh3_128_hexdigest(tokens.tobytes()))
                out["prefix"].append(first)
                out["prefix_key"].append(xxhash.xxh3_128_hexdigest(first))
            yield out | {"doc_id": b["doc_id"], "row": list(range(row, row := row + len(b["doc_id"])))}

    return materialize(map_rows(source, run, "row long, doc_id long, n int, content string, prefix binary, prefix_key string"), "jaccard-docs"), hot


def spread(heads: DataFrame) -> DataFrame:
    """token, gid, n, at: a row for each token of each group's prefix, with its place."""

    def run(batches):
        for b in batches:
            found = [np.frombuffer(p, np.int64) for p in b["prefix"]]
            sizes = list(map(len, found))
            if sum(sizes):
                yield {"token": np.concatenate(found), "gid": np.repeat(b["gid"], sizes), "n": np.repeat(np.array(b["n"], np.int32), sizes), "at": np.concatenate([np.arange(k, dtype=np.int32) for k in sizes])}

    return map_rows(heads.select("gid", "n", "prefix"), run, "token long, gid long, n int, at int")


def verify(pairs: DataFrame, members: DataFrame, source: DataFrame, width: int, percent: int) -> DataFrame:
    """Those pairs a, b of nodes whose sets reach the threshold, by their whole sets; written.

    A node has one content, so sets are known by their content: they are shuffled once to meet the first ends of pairs,
    that shuffle serves the second ends too, and one set of each pair goes from the first to the second.
    """
    pairs = materialize(pairs, "jaccard-pairs")
    ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct()
    nodes = materialize(ends.join(members.select("node", "doc_id", "content").hint("merge"), "node"), "jaccard-nodes")
    n = max(MIN_TASKS, -(-nodes.count() // SETS_PER_TASK))  # no more tasks than the sets are worth
    ids = few(nodes.select(F.col("doc_id").alias("id")).distinct())
    texts = source.join(ids, F.col("doc_id") == F.col("id"), "left_semi")

    def sets(batches):
        for b in batches:
            found = [t.tobytes() for t in shingle_sets(b["text"], width)]
            yield {"content": [xxhash.xxh3_128_hexdigest(t) for t in found], "tokens": found}

    one = map_rows(texts, sets, "content string, tokens binary").dropDuplicates(["content"])
    first, second = (nodes.select(F.col("node").alias(k), F.col("content").alias(f"content_{k}")).hint("merge") for k in "ab")
    named = pairs.join(first, "a").join(second, "b").coalesce(n)
    left = named.join(one.select(F.col("content").alias("content_a"), F.col("tokens").alias("x")).hint("merge"), "content_a").coalesce(n)
    both = left.join(one.select(F.col("content").alias("content_b"), F.col("tokens").alias("y")).hint("merge"), "content_b").select("a", "b", "x", "y").coalesce(n)

    def compare(batches):
        for b in batches:
            keep = []
            for i, (x, y) in enumerate(zip(b["x"], b["y"])):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(np.intersect1d(x, y, assume_unique=True)) >= needed(len(x), len(y), percent):
                    keep.append(i)
            yield {"a": [b["a"][i] for i in keep], "b": [b["b"][i] for i in keep]}

    links = materialize(map_rows(both, compare, "a long, b long"), "jaccard-links")
    discard(pairs, nodes)
    return links


def last_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """a, b: group pairs of a token in different components that can link by their places of this token.

    The smaller set must hold the token early enough for its own size: it is an index row, and meets the rows of its
    size band and the next ones, on the other side than the token's core component, or on both.
    """
    width = math.log(100 / percent) + 1e-4
    band = F.floor(F.log(F.col("n").cast("double")) / width).cast("int")
    probe = rows.withColumn("band", F.explode(F.array(band, band - 1)))
    index = rows.where(f"{100 + percent} * (n - at) >= {2 * percent} * n").withColumn("band", band)
    index = index.withColumn("side", F.explode(F.when(F.col("outer"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))))
    columns = ("gid", "n", "at", "low", "high")
    a = probe.select("token", "band", F.col("outer").alias("side"), *[F.col(c).alias(f"{c}_a") for c in columns])
    b = index.select("token", "band", "side", *[F.col(c).alias(f"{c}_b") for c in columns])
    smaller = "(n_b < n_a or n_b = n_a and gid_b < gid_a)"
    met = a.join(b.hint("merge"), ["token", "band", "side"]).where(smaller).where(fits(percent, "n_a", "at_a", "n_b", "at_b"))
    met = met.where("not (low_a = high_a and low_b = high_b and low_a = low_b)")
    return met.select(F.col("gid_a").alias("a"), F.col("gid_b").alias("b")).distinct()


def jaccard_components(docs: DataFrame, width: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", sketch_bits: int = SKETCH_BITS, pairs_per_row: float = PAIRS_PER_ROW, hot_class: int = HOT_CLASS) -> DataFrame:
    """doc_id, n_shingles, component_id of every document; links need Jaccard similarity of percent / 100.

    Null and empty texts have no shingles, link with nothing and are their own component. Rows repeated under one
    id each give a row and keep the links of their own texts. A null id takes no part and has a null component.
    Other columns are ignored; an empty table gives no rows.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows, hot = describe(source, width, percent, sketch_bits, hot_class)
    first = F.min(F.struct("doc_id", "row")).alias("first")
    sets = rows.where("n > 0 and doc_id is not null").groupBy("content", "n", "prefix_key").agg(first)
    sets = sets.select("content", "n", "prefix_key", F.col("first.row").alias("node"), F.col("first.doc_id").alias("doc_id"))
    gid = sets.groupBy("prefix_key", "n").agg(F.min("node").alias("gid"))
    members = materialize(sets.join(gid.hint("merge"), ["prefix_key", "n"]).select("gid", "node", "doc_id", "content", "n"), "jaccard-members")

    # A group's first member stands for it. Where few rows are others, these few go to the rows, and prefixes need no shuffle.
    heads = members.where("gid = node").select("gid")
    others = materialize(rows.select("row").join(heads.hint("merge"), F.col("row") == F.col("gid"), "left_anti"), "jaccard-others")
    tokens = spread(rows.join(few(others), "row", "left_anti").withColumnRenamed("row", "gid"))
    hub = F.min(F.struct("at", "gid", "n")).alias("hub")
    # A token of a low class has a short list, whose hub comes first in order; hot tokens are summed up before the shuffle.
    by_place = Window.partitionBy("token").orderBy("at", "gid")
    first = F.first(F.struct("at", "gid", "n")).over(by_place.rowsBetween(Window.unboundedPreceding, 0))
    cold = tokens.where(F.shiftright("token", 58) < hot).select("*", first.alias("hub"), F.lead("gid").over(by_place).alias("next"))
    cold = cold.where("hub.gid <> gid or next is not null").drop("next")
    hot_tokens = tokens.where(F.shiftright("token", 58) >= hot)
    hubs = hot_tokens.groupBy("token").agg(hub, F.count("*").alias("m")).where("m > 1").drop("m")
    left = materialize(cold.unionByName(hot_tokens.join(hubs.hint("merge"), "token")), "jaccard-tokens")
    discard(others)

    inner = members.where("gid <> node").select(F.col("gid").alias("a"), F.col("node").alias("b"))
    before, placed, tried = float("inf"), None, []

    def place(edges: DataFrame) -> DataFrame:
        """gid, node, component of every node; written."""
        component = connected_components(edges).select("node", "component")
        out = members.select("gid", "node").join(component.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))
        return materialize(out, "jaccard-placed")

    def joined(placed: DataFrame) -> DataFrame:
        return placed.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b")

    def apart(met: DataFrame, placed: DataFrame) -> DataFrame:
        """Those groups and hubs whose first members lie in different components."""
        c, d = (placed.select(F.col("node").alias(n), F.col("component").alias(k)).hint("merge") for n, k in (("gid", "c"), ("hub", "d")))
        return met.join(c, "gid").join(d, "hub").where("c <> d").select("gid", "hub")

    for turn in range(HUB_ROUNDS):
        met = left.where("gid <> hub.gid").where(fits(percent, "n", "at", "hub.n", "hub.at"))
        met = materialize(met.select("gid", F.col("hub.gid").alias("hub")).distinct(), "jaccard-met")
        tried.append(met.select(F.col("gid").alias("a"), F.col("hub").alias("b")))
        todo = apart(met, placed) if turn else met
        pairs = todo.select(F.least("gid", "hub").alias("a"), F.greatest("gid", "hub").alias("b")).distinct()
        found = verify(pairs if turn else inner.unionAll(pairs), members, source, width, percent)
        last, placed = placed, place(found.unionAll(joined(placed)) if turn else found)
        discard(found, *([last] if last is not None else []))
        of_group = placed.groupBy("gid").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        now = left.select("token", "gid", "n", "at", F.col("hub.gid").alias("hub")).join(of_group.hint("merge"), "gid")
        # The hub is done with. A token is, once its other groups lie in one component; the core is the hub's component.
        rest = [f(F.when(F.expr("gid <> hub"), F.col(c))).alias(k) for f, c, k in ((F.min, "low", "l"), (F.max, "high", "h"))]
        state = now.groupBy("token").agg(*rest, F.max(F.when(F.expr("gid = hub"), F.col("low"))).alias("core")).where("l < h")
        now = now.join(state.select("token", "core").hint("merge"), "token").where("gid <> hub").drop("hub").withColumn("outer", F.expr("not (low = high and low = core)"))
        now, done = materialize(now, "jaccard-open"), left
        discard(done)
        index = f"{100 + percent} * (n - at) >= {2 * percent} * n"
        sizes = now.groupBy("token").agg(*[F.count_if(F.expr(c)).alias(k) for k, c in (("io", f"outer and {index}"), ("ic", f"not outer and {index}"), ("o", "outer"), ("m", "true"))])
        work, n = sizes.agg(F.sum(F.expr("io * cast(m as double) + ic * cast(o as double)")), F.sum("m")).first()
        # A round that shrinks the work little would be followed by ones that do no better: the last join does all that is left.
        if not n or work <= pairs_per_row * n or work > WORTHWHILE * before or turn == HUB_ROUNDS - 1:
            break
        before = work
        left = materialize(now.join(now.groupBy("token").agg(hub).hint("merge"), "token"), "jaccard-tokens")
        discard(now)

    # What links so far leave apart: all group pairs of a token in different components, groups that lie in several
    # components with themselves and the hubs they met, then their members.
    mixed = materialize(of_group.where("low < high").select("gid"), "jaccard-mixed")
    rest = last_pairs(now, percent).unionAll(mixed.select(F.col("gid").alias("a"), F.col("gid").alias("b")))
    for met in tried:
        for end in ("a", "b"):
            rest = rest.unionAll(met.join(mixed.hint("merge"), F.col(end) == F.col("gid"), "left_semi"))
    one, two = (placed.select(F.col("gid").alias(s), F.col("node").alias(f"node_{s}"), F.col("component").alias(f"c_{s}")) for s in "ab")
    rest = rest.join(one.hint("merge"), "a").join(two.hint("merge"), "b").where("c_a <> c_b and (a <> b or node_a < node_b)")
    found = verify(rest.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct(), members, source, width, percent)
    component = connected_components(found.unionAll(joined(placed)))

    of_node = members.select("node", "doc_id", "content", "n").join(component.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = of_node.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_content = of_node.join(smallest.hint("merge"), "component").select("content", "n", "component_id")
    out = rows.select("doc_id", "n", "content").join(of_content.hint("merge"), ["content", "n"], "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
