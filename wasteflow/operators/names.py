"""Joins of names that are alike or lie in one another, by equi joins on short pieces; no pair that counts is lost.

The pieces of all names are counted in a table of BUCKETS hashed counters, whose size does not grow, and put in rare-first
order by it. Any order gives the same pairs; the rare-first one keeps common pieces out of the joins.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written

BUCKETS = 1 << 16
DEALT = 50  # a piece of n names is dealt over sqrt(n) / DEALT tasks more
PIECE = 3  # characters of a piece that stands for a contained name
SHORT = 40  # characters of the longest text whose forms without one or two of them are made


def indel_ratio(a: str, b: str) -> float:
    """100 * (1 - insertions and deletions / total length), from the longest common subsequence in bits."""
    if not a and not b:
        return 100.0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        common = row & masks.get(ch, 0)
        row = (row + common) | (row - common)
        row &= full
    return 200.0 * (len(a) - row.bit_count()) / (len(a) + len(b))


def token_sort_ratio(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def sorted_words(name: str) -> str:
    return " ".join(sorted(name.split()))


def bucket(piece: str) -> Column:
    return F.pmod(F.xxhash64(piece), F.lit(BUCKETS))


def rare_first(pieces: DataFrame, counted: list[DataFrame]) -> DataFrame:
    """pieces with `often`: how often those of its bucket stand in the counted tables; at most BUCKETS counters are broadcast."""
    both = counted[0].select("piece")
    for other in counted[1:]:
        both = both.unionByName(other.select("piece"))
    counts = both.groupBy(bucket("piece").alias("bucket")).agg(F.count("*").alias("often"))
    return pieces.withColumn("bucket", bucket("piece")).join(F.broadcast(counts), "bucket", "left").drop("bucket").fillna(0, ["often"])


class Bounds:
    """How many pieces two strings of a and b characters share at least if their indel ratio reaches the threshold.

    A ratio of t allows d <= (1 - t) * (a + b) edits, with a + b + d even. Strings with a space at both ends have a + 1 and
    b + 1 pairs of neighbouring characters. A deletion destroys at most two of them and an insertion one, repeated pairs
    counted, so (a + b - 3 * d) / 2 + 1 are shared. At two thirds and below that can be none; there the pieces are single
    characters, of which (a + b - d) / 2 are shared. Of two sets in one order that share s pieces, with n in one of them,
    the first n - s + 1 of that one hold a shared piece.
    """

    def __init__(self, threshold: float):
        self.threshold, self.pairs = threshold, threshold > 200 / 3

    def edits(self, a: str, b: str) -> str:
        most = f"cast(floor((1 - {self.threshold} / 100D) * ({a} + {b}) + 1e-6) as int)"
        return f"({most} - pmod({a} + {b} + {most}, 2))"

    def size(self, a: str) -> str:
        return f"({a} + 1)" if self.pairs else a

    def shared(self, a: str, b: str) -> str:
        d = self.edits(a, b)
        return f"(cast(({a} + {b} - 3 * {d}) / 2 as int) + 1)" if self.pairs else self.letters(a, b)

    def letters(self, a: str, b: str) -> str:
        """Single characters that are shared at least."""
        return f"cast(({a} + {b} - {self.edits(a, b)}) / 2 as int)"

    def prefix(self, a: str, b: str) -> str:
        return f"({self.size(a)} - {self.shared(a, b)} + 1)"

    def partners(self, a: str) -> str:
        """Lengths of strings that can reach the threshold with one of a characters."""
        t = f"({self.threshold} / 100D)"
        return f"sequence(greatest(1, cast(ceil({a} * {t} / (2 - {t}) - 1e-6) as int)), greatest(1, cast(floor({a} * (2 - {t}) / {t} + 1e-6) as int)))"


def with_pieces(df: DataFrame, text: Column, width: int, column: str) -> DataFrame:
    """df with an array of the pieces of a text that is not empty; the k-th repetition of a piece is a piece of its own."""
    each = F.sort_array(F.transform(F.sequence(F.lit(1), F.length(text) - (width - 1)), lambda i: F.substr(text, i, F.lit(width))))
    numbered = F.transform("wf_all", lambda p, i: F.concat(p, (i + 1 - F.array_position("wf_all", p)).cast("string")))
    return df.withColumn("wf_all", each).withColumn(column, numbered).drop("wf_all")


def pieces_of(df: DataFrame, key: str, text: str, size: str, bounds: Bounds) -> DataFrame:
    """A row for each piece."""
    padded = F.concat(F.lit(" "), text, F.lit(" ")) if bounds.pairs else F.col(text)
    found = with_pieces(df.where(F.col(size) > 0).select(key, text, size), padded, 2 if bounds.pairs else 1, "pieces")
    return found.select(key, text, size, F.explode("pieces").alias("piece"))


def alike(left: DataFrame, right: DataFrame, bounds: Bounds) -> DataFrame:
    """name, x, match, y: all pairs of left (name, x, a) and right (match, y, b) that can reach the threshold, each once.

    Left goes with each length b of a partner and the prefix for just that length; a pair meets on a piece that stands in
    both prefixes, at places after which enough pieces are left.
    """
    l, r = pieces_of(left, "name", "x", "a", bounds), pieces_of(right, "match", "y", "b", bounds)

    def ordered(pieces: DataFrame, keys: list[str]) -> DataFrame:
        order = F.sort_array(F.collect_list(F.struct("often", "piece")))
        return rare_first(pieces, [l, r]).groupBy(*keys).agg(order.alias("order"))

    first = ordered(l, ["name", "x", "a"]).withColumn("b", F.explode(F.expr(bounds.partners("a"))))
    first = first.select("name", "x", "a", "b", F.posexplode(F.expr(f"slice(order, 1, greatest(0, {bounds.prefix('a', 'b')}))")).alias("i", "p"))
    longest = f"array_max(transform({bounds.partners('b')}, a -> {bounds.prefix('b', 'a')}))"
    second = ordered(r, ["match", "y", "b"]).select("match", "y", "b", F.posexplode(F.expr(f"slice(order, 1, greatest(0, {longest}))")).alias("j", "p"))
    shares = F.expr(f"1 + cast(floor(sqrt(p.often) / {DEALT}) as int)")
    # A frequent piece is dealt over several tasks: left by name, with the right rows in each.
    first = first.select("name", "x", "a", "b", "i", F.col("p.piece").alias("piece"), F.pmod(F.xxhash64("name"), shares).alias("share"))
    second = second.select("match", "y", "b", "j", F.col("p.piece").alias("piece"), F.explode(F.sequence(F.lit(0), shares - 1)).alias("share"))
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first, second = (d.repartition(n, "piece", "b", "share") for d in (first, second))
    left_over = F.expr(f"j < {bounds.prefix('b', 'a')} AND least({bounds.size('a')} - i, {bounds.size('b')} - j) >= {bounds.shared('a', 'b')}")
    return first.join(second.hint("merge"), ["piece", "b", "share"]).where(left_over).select("name", "x", "match", "y").distinct()


def shorter(text: str, n: int) -> Column:
    """The distinct forms of a text of more than n characters without n of them."""
    forms = F.array(F.col(text))
    for _ in range(n):
        less = lambda t: F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(F.substr(t, F.lit(1), i - 1), F.substr(t, i + 1)))
        forms = F.array_distinct(F.flatten(F.transform(forms, less)))
    return forms


def near(left: DataFrame, right: DataFrame, edits: int, threshold: float) -> DataFrame:
    """name, a, match, score: the pairs of texts of up to SHORT characters (left) that are this many edits apart, or fewer.

    i characters go from x and the others from y, and what is left is the same text. The score is that of so many edits,
    so a pair of fewer has a higher one from there. A text has forms only if there are partners of the length they ask for.
    """
    left, right = left.where(f"a > 0 and a <= {SHORT}"), right.where(f"b > 0 and b <= {SHORT + edits}")
    # At most SHORT + edits rows each.
    of_left, of_right = left.select("a").distinct(), right.select("b").distinct()
    out = None
    for i in range(edits + 1):
        j = edits - i
        score = F.expr(f"200D * (a - {i}) / (2 * a - {i} + {j})")
        one = left.where((F.col("a") > i) & (score >= threshold)).join(F.broadcast(of_right), F.expr(f"b = a - {i} + {j}"), "left_semi")
        two = right.where(F.col("b") > j).join(F.broadcast(of_left), F.expr(f"a = b - {j} + {i}"), "left_semi")
        met = one.select("name", "a", F.explode(shorter("x", i)).alias("form")).join(two.select("match", F.explode(shorter("y", j)).alias("form")).hint("merge"), "form")
        met = met.select("name", "a", "match", score.alias("score"))
        out = met if out is None else out.unionByName(met)
    return out


def nearest(left: DataFrame, right: DataFrame, threshold: float) -> tuple[list[DataFrame], DataFrame]:
    """Best pairs (name, match, score) of no, one and two edits, and the left names for which others may be better or as good.

    A name is settled once its best score is over all that one edit more could give it: the partner that holds all of it.
    """
    found: list[DataFrame] = []
    for edits in (0, 1, 2):
        hits = near(left, right, edits, threshold).groupBy("name", "a").agg(F.min(F.struct((-F.col("score")).alias("less"), "match")).alias("best"))
        found.append(written(hits, "names-near"))
        most = F.expr(f"200D * a / (2 * a + {edits + 1})")
        done = found[-1].where(-F.col("best.less") > most).select("name")
        left = written(left.where(most >= threshold).join(done.hint("merge"), "name", "left_anti"), "names-open")
    return [f.select("name", F.col("best.match").alias("match"), (-F.col("best.less")).alias("score")) for f in found], left


def fuzzy_join(left: DataFrame, right: DataFrame, name: str, ref: str, threshold: float = 85, inclusive: bool = False) -> DataFrame:
    """Best token-sort match of each distinct name of left among right's: exact first, else the best ratio over threshold.

    name, match, score (0 to 100); ties go to the smaller match. Names of white space only are alike to each other and to no
    other name. Null names take no part. No pair over the threshold is lost (see Bounds).
    """
    names = left.select(F.col(name).alias("name")).where("name is not null").distinct()
    refs = right.select(F.col(ref).alias("match")).where("match is not null").distinct()

    @F.pandas_udf("string")
    def in_order(a: pd.Series) -> pd.Series:
        return a.map(sorted_words)

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([indel_ratio(x, y) for x, y in zip(a, b)])

    # Both are read several times below; the tables behind them may be large.
    r = written(refs.select("match", in_order("match").alias("y")).withColumn("b", F.length("y")), "names-right")
    names = written(names.select("name", in_order("name").alias("x")).withColumn("a", F.length("x")), "names-left")
    exact = names.join(r.hint("merge"), F.col("name") == F.col("match")).select("name", "match", F.lit(100.0).alias("score"))
    l = written(names.join(r.hint("merge"), F.col("name") == F.col("match"), "left_anti"), "names-other")
    found, rest = nearest(l, r, threshold)
    scored = alike(rest, r, Bounds(threshold)).select("name", "match", ratio("x", "y").alias("score"))
    for pairs in found:
        scored = scored.unionByName(pairs)
    blank = r.where("b = 0").agg(F.min("match").alias("match")).where("match is not null")
    blank = l.where("a = 0").select("name", F.lit(0).alias("b")).join(blank.withColumn("b", F.lit(0)).hint("merge"), "b").select("name", "match", F.lit(100.0).alias("score"))
    scored = scored.unionByName(blank)
    scored = scored.where(F.col("score") >= threshold if inclusive else F.col("score") > threshold)
    best = scored.groupBy("name").agg(F.min(F.struct(-F.col("score"), F.col("match"))).alias("best"))
    return exact.unionByName(best.select("name", F.col("best.match").alias("match"), (-F.col("best.col1")).alias("score")))


def resolve_company(df: DataFrame, known: DataFrame, name: str, ref: str, threshold: float = 85) -> DataFrame:
    """name, company, confidence of every distinct name: the best match and ratio / 100, else the name and 0.

    Without any known company a name is taken as it is, with confidence 1.
    """
    found = fuzzy_join(df, known, name, ref, threshold, inclusive=True)
    names = df.select(F.col(name).alias("name")).where("name is not null").distinct()
    # One row, whatever the size of known.
    none = known.where(F.col(ref).isNotNull()).limit(1).agg((F.count("*") == 0).alias("none_known"))
    out = names.join(found.hint("merge"), "name", "left").join(F.broadcast(none))
    missed = F.when(F.col("none_known"), 1.0).otherwise(0.0)
    return out.select("name", F.coalesce("match", "name").alias("company"), F.coalesce(F.col("score") / 100, missed).alias("confidence"))


def substrings(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, text, piece: each distinct piece of one to PIECE characters."""
    def of(width: int) -> Column:
        cut = F.transform(F.sequence(F.lit(1), F.length(text) - width + 1), lambda i: F.substr(text, i, F.lit(width)))
        return F.when(F.length(text) >= width, cut).otherwise(F.array().cast("array<string>"))

    return df.select(key, text, F.explode(F.array_distinct(F.concat(*[of(w) for w in range(1, PIECE + 1)]))).alias("piece"))


def inside(inner: DataFrame, outer: DataFrame) -> DataFrame:
    """i, o: every text i (column i) that lies in a text o (column o), by the piece of i that is rarest among the outer texts."""
    held = substrings(outer, "o", "o").select("o", "piece")
    width = F.least(F.length("i"), F.lit(PIECE))
    probes = inner.select("i", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("i") - width + 1), lambda at: F.substr("i", at, width)))).alias("piece"))
    rarest = rare_first(probes, [held]).groupBy("i").agg(F.min(F.struct("often", "piece"))["piece"].alias("piece"))
    return held.join(rarest.hint("merge"), "piece").where(F.contains("o", "i")).select("i", "o")


def contains_join(names: DataFrame, ref: DataFrame, name: str, key: str, value: str, order: str, default: str = "Unknown") -> DataFrame:
    """name, value of every distinct name: the exact key's, else of the first key (by order) that holds the name or is held by it.

    Case does not count; null and empty names and keys take no part. Both directions are equi joins on pieces, so ref may be
    of any size. Works on distinct names only.
    """
    n = names.select(F.col(name).alias("name")).where("name is not null and name <> ''").distinct()
    r = ref.select(F.col(key).alias("k"), F.col(value).alias("v"), F.col(order).alias("o")).where("k is not null and k <> ''")
    a, b = n.select(F.lower("name").alias("a")).distinct(), r.groupBy(F.lower("k").alias("b")).agg(F.min(F.struct("o", "k", "v")).alias("first"))
    keys = b.select("b")
    under = inside(keys.select(F.col("b").alias("i")), a.select(F.col("a").alias("o"))).select(F.col("o").alias("a"), F.col("i").alias("b"))
    over = inside(a.select(F.col("a").alias("i")), keys.select(F.col("b").alias("o"))).select(F.col("i").alias("a"), F.col("o").alias("b"))
    hits = under.unionByName(over).join(b.hint("merge"), "b")
    best = hits.groupBy("a").agg(F.min(F.struct((F.col("a") != F.col("b")).cast("int").alias("other"), "first"))["first"]["v"].alias("value"))
    return n.join(best.hint("merge"), F.lower("name") == F.col("a"), "left").select("name", F.coalesce("value", F.lit(default)).alias("value"))
