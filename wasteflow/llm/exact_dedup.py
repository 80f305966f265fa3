"""Operator 9: exact dedup through an extendible-hash index on shared files.

1. Every whole text gets a digest and a 64-bit key; rows go to a table in the shared folder. Within a batch equal
   digests give one index entry, so a group of copies reaches the index as a few entries, however large it is.
2. The directory comes from entry counts by key prefix: a bucket that holds more than `capacity` entries is split,
   doubling the directory where its depth is used up. Its size is bounded by 2 ** MAX_DEPTH.
3. The index is written to shared files by bucket. Owner tasks take whole buckets, that is key ranges. Entries with
   one key are chained; their texts are fetched and compared byte for byte.
4. Each document gets its class from the chain its entry ended in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few, map_rows, materialize

MAX_DEPTH = 14
PART = 256


def normalise(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased (bytes.lower changes nothing else); null counts as empty."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def digests(docs: DataFrame, id_col: str, text_col: str, row_col: str | None = None) -> DataFrame:
    """row_id, doc_id, sha, key, entry: row_id is the one given or counted, entry that of the batch's first row with that digest."""

    def run(batches):
        row_id = TaskContext.get().partitionId() << 40
        for b in batches:
            first: dict[str, int] = {}
            out = {k: [] for k in ("row_id", "sha", "key", "entry")}
            for n, text in enumerate(b["text"]):
                if row_col:
                    row_id = b["row_id"][n]
                sha = hashlib.sha256(normalise(text)).hexdigest()
                out["row_id"].append(row_id)
                out["sha"].append(sha)
                out["key"].append(int(sha[:16], 16) - (1 << 63))
                out["entry"].append(first.setdefault(sha, row_id))
                row_id += 1
            yield out | {"doc_id": b["doc_id"]}

    kind = dict(docs.dtypes)[id_col]
    given = [F.col(row_col).alias("row_id")] if row_col else []
    return map_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *given), run, f"row_id long, doc_id {kind}, sha string, key long, entry long")


def slot(depth: int = MAX_DEPTH) -> F.Column:
    """The directory slot of a key at the given depth: its upper bits, so slots are key ranges."""
    return F.shiftrightunsigned(F.col("key").bitwiseXOR(F.lit(-(1 << 63))), 64 - depth)


def directory(counts: dict[int, int], capacity: int, max_depth: int = MAX_DEPTH) -> tuple[int, list[int]]:
    """Global depth, and for each of its 2 ** depth slots the bucket it points to.

    counts: entries by slot at max_depth. A bucket over capacity splits in two; when its local depth is the
    global one, the directory doubles first. At max_depth a bucket stays overfull and its chains grow instead.
    """
    sums = [0]
    for i in range(1 << max_depth):
        sums.append(sums[-1] + counts.get(i, 0))

    def held(prefix: int, depth: int) -> int:
        width = max_depth - depth
        return sums[(prefix + 1) << width] - sums[prefix << width]

    depth, slots, local, todo = 0, [0], {0: (0, 0)}, [0]
    while todo:
        bucket = todo.pop()
        prefix, own = local[bucket]
        if held(prefix, own) <= capacity or own == max_depth:
            continue
        if own == depth:
            slots = [b for b in slots for _ in (0, 1)]
            depth += 1
        other = len(local)
        local[bucket], local[other] = (2 * prefix, own + 1), (2 * prefix + 1, own + 1)
        width = depth - own - 1
        slots[(2 * prefix + 1) << width : (2 * prefix + 2) << width] = [other] * (1 << width)
        todo += [bucket, other]
    return depth, slots


def chain(entries: Iterator[tuple[int, bytes]]) -> dict[int, int]:
    """entry -> the first entry with the same bytes, for entries of one key."""
    seen: list[tuple[bytes, int]] = []
    out = {}
    for entry, text in entries:
        for other, leader in seen:
            if other == text:
                out[entry] = leader
                break
        else:
            seen.append((text, entry))
            out[entry] = entry
    return out


def exact_groups(docs: DataFrame, capacity: int = 50_000, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """row_id, doc_id, sha, keep_id, keep_row, group_size of every row of docs, by equal normalised text.

    Null ids sort before all others; of rows with the largest id the one with the largest row_id stays. row_col, if
    given, is a long that differs in all rows, and is the row_id; otherwise rows are counted as they are read.
    """
    spark = docs.sparkSession
    rows = materialize(digests(docs, id_col, text_col, row_col), "dedup-rows")
    entries = rows.where("entry = row_id")
    counts = {r["s"]: r["n"] for r in entries.groupBy(slot().alias("s")).agg(F.count("*").alias("n")).collect()}
    depth, slots = directory(counts, capacity)
    bucket = F.element_at(F.lit(slots), slot(depth).cast("int") + 1) if depth else F.lit(0)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = materialize(entries.select(bucket.alias("bucket"), "key", "entry").repartition(n, "bucket").sortWithinPartitions("bucket", "key"), "dedup-index")

    # Chains: only entries that share a key with another one need their bytes. A long chain is compared in lots of
    # about PART entries, then the lots' leaders in the same way, until one lot is left.
    shared = index.groupBy("bucket", "key").agg(F.count("*").alias("n")).where("n > 1")
    lots = F.ceil(F.col("n") / PART).cast("long").alias("lots")
    chained = index.join(shared.hint("shuffle_hash"), ["bucket", "key"]).select("bucket", "key", "entry", lots)
    owned = materialize(chained.join(entries.select("entry", "doc_id", "sha").hint("merge"), "entry"), "dedup-chained")
    by, own = ("entry", row_col) if row_col else ("doc_id", id_col)
    wanted = few(owned.select(F.col(by).alias("wanted")).distinct())
    source = docs.select(F.col(own).alias("id"), F.col(text_col).alias("text"))
    source = source.join(wanted, F.col("id").eqNullSafe(F.col("wanted")), "left_semi")

    def fetch(batches):
        for b in batches:
            texts = list(map(normalise, b["text"]))
            yield {"id": b["id"], "digest": [hashlib.sha256(t).hexdigest() for t in texts], "bytes": texts}

    texts = map_rows(source, fetch, f"id {dict(docs.dtypes)[own]}, digest string, bytes binary")
    if not row_col:
        texts = texts.dropDuplicates(["id", "digest"])  # rows repeated under one id
    same = F.col(by).eqNullSafe(F.col("id")) & (F.col("sha") == F.col("digest"))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("entry")
        found = chain(zip(frame["entry"], frame["bytes"]))
        held = dict(zip(frame["entry"], frame["bytes"]))
        first = {c: frame[c].iloc[0] for c in ("bucket", "key", "lots")}
        return pd.DataFrame(first | {"entry": list(found), "leader": list(found.values()), "bytes": [held[e] if e == to else None for e, to in found.items()]})

    schema = "bucket int, key long, lots long, entry long, leader long, bytes binary"

    def compared(entries: DataFrame) -> DataFrame:
        salted = entries.withColumn("salt", F.pmod(F.xxhash64("entry", "lots"), F.col("lots")))
        return materialize(salted.groupBy("bucket", "key", "salt").applyInPandas(compare, schema), "dedup-lots")

    found = compared(owned.join(texts.hint("merge"), same))
    leaders = found.select("entry", "leader")
    while not (split := found.where("lots > 1 and entry = leader")).isEmpty():
        found = compared(split.withColumn("lots", F.ceil(F.col("lots") / PART).cast("long")))
        higher = found.select(F.col("entry").alias("leader"), F.col("leader").alias("last"))
        leaders = leaders.join(higher.hint("merge"), "leader", "left").select("entry", F.coalesce("last", "leader").alias("leader"))
    return classes(rows, leaders)


def classes(rows: DataFrame, leaders: DataFrame) -> DataFrame:
    """Adds each row's class: the leader of its entry, or the entry itself."""
    best = F.max(F.struct("doc_id", "row_id"))
    per_entry = rows.groupBy("entry").agg(F.count("*").alias("n"), best.alias("best"))
    led = per_entry.join(leaders.hint("shuffle_hash"), "entry", "left").withColumn("leader", F.coalesce("leader", "entry"))
    per_class = led.groupBy("leader").agg(F.sum("n").alias("group_size"), F.max("best").alias("best"))
    of_entry = led.select("entry", "leader").join(per_class.hint("merge"), "leader").select("entry", "group_size", "best")
    return rows.join(of_entry.hint("merge"), "entry").select("row_id", "doc_id", "sha", F.col("best.doc_id").alias("keep_id"), F.col("best.row_id").alias("keep_row"), "group_size")


def exact_dedup(docs: DataFrame, capacity: int = 50_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    Null text counts as empty. Of rows repeated with one id only one is kept. An empty table gives no rows.
    """
    found = exact_groups(docs, capacity, id_col, text_col)
    return found.select("doc_id", "keep_id", "group_size", (F.col("row_id") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256"))
