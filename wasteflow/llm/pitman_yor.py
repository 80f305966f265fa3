"""Operator 7: LM scoring with a hierarchical Pitman-Yor model of word pairs.

Every context, the word before, has a restaurant whose dishes are words; all contexts share one parent, the restaurant of
words, whose own base is uniform over the known words and one unknown. Contexts are told apart by CONTEXT_BITS bits of a
hash, so the context totals are a table of fixed size. Customers are tokens; a table of a context's restaurant is a
customer of the parent. Seating is Gibbs-sampled by the Chinese restaurant process: in each sweep the customers of a
dish leave and are seated again one by one, given the parent's probabilities and the totals of the sweep before. Totals
follow at the end of a sweep, as is usual where restaurants are spread over machines. The predictive probabilities of
the sweeps after burn-in are averaged; a document's perplexity follows from them.

What is gathered is every pair of context and word with its count and its places, so it grows with the corpus. It is
dealt by word into parts of bounded size; words with very many tokens are dealt by word and context. A part's seats
follow from its counts, a hash and the totals alone, so they are sampled again where they are needed and never stored.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, materialize
from .shingling import mix, words_of

CONTEXT_BITS = 18
CONTEXTS = 1 << CONTEXT_BITS
BLOCK_TOKENS, BLOCK_DOCS = 2_000_000, 1 << 15  # most of a block of documents
PART_TOKENS = 2_000_000  # tokens a part has on average
HOT_TOKENS = 4_000_000  # a word with more tokens is split by context
MOST_HOT = 1 << 18  # words that are split at most
BURN_IN, SAMPLES = 1, 2
STRENGTH = 1.0
AT_ONCE = 1 << 20  # customers that are seated in one array
CHUNK = 1 << 12
START, END = (np.uint64(xxhash.xxh3_64_intdigest(b)) for b in (b"\n\n", b"\n"))  # no word holds white space


def uniform(seed: np.ndarray, step: np.ndarray) -> np.ndarray:
    """A number in (0, 1) for each seed and step: a hash, so that a repeated task draws the same."""
    return (mix(seed + step.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


def seat(counts: np.ndarray, pull: np.ndarray, discount: float, seed: np.ndarray) -> np.ndarray:
    """Tables that counts customers of one dish open when seated one by one: with i seated at t tables the next opens one
    with probability pull / (pull + i - discount * t), where pull is the restaurant's weight for new tables times the
    dish's parent probability.

    Customers of many dishes stand in one array. Who opens a table depends on the tables opened before, so the array is
    gone through until nothing changes; as tables only make new ones likelier, that ends at the seating one by one.
    """
    tables = (counts > 0).astype(np.float64)
    many = np.flatnonzero(counts > 1)
    ends = np.cumsum(counts[many] - 1)
    at = 0
    while at < len(many):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE, "right")))
        own = many[at:upto]
        most = int(counts[own].max()) - 1
        for low in range(0, most, AT_ONCE):  # more than one turn only for a dish that is alone
            n = np.minimum(counts[own] - 1 - low, AT_ONCE).astype(np.int64)
            start = np.cumsum(n) - n
            dish = np.repeat(own, n)
            seated = np.arange(len(dish)) - np.repeat(start, n) + low + 1
            a, t = pull[dish], tables[dish]
            draw = uniform(seed[dish], seated)
            opened = draw * (a + seated - discount * t) < a
            while True:
                before = np.cumsum(opened) - opened
                now = draw * (a + seated - discount * (t + before - np.repeat(before[start], n))) < a
                if np.array_equal(now, opened):
                    break
                opened = now
            tables[own] += np.add.reduceat(opened.astype(np.int64), start)
        at = upto
    return tables


@functools.lru_cache(1)
def zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def packed(values: np.ndarray) -> bytes:
    """Compressed, one byte plane after the other."""
    return zstd()[0].compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def unpacked(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstd()[1].decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


@dataclass
class Parts:
    """How tokens are dealt: by the upper `bits` of the word's hash; hot words (sorted) by word and upper bits of the context."""

    bits: int
    hot: np.ndarray
    splits: np.ndarray  # bits of the context that split a hot word

    @property
    def first_hot(self) -> np.ndarray:
        size = np.left_shift(1, self.splits)
        return (1 << self.bits) + np.cumsum(size) - size

    @property
    def count(self) -> int:
        return (1 << self.bits) + int(np.left_shift(1, self.splits).sum())

    def deal(self, word: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each token's part, and its key there: what the part does not tell of the word, or the hot word's number, then the context."""
        part = (word >> np.uint64(64 - self.bits)).astype(np.int64)
        key = (word << np.uint64(self.bits)) >> np.uint64(CONTEXT_BITS) << np.uint64(CONTEXT_BITS) | context
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, word), len(self.hot) - 1)
            hot = np.flatnonzero(self.hot[at] == word)
            at = at[hot]
            part[hot] = self.first_hot[at] + (context[hot].astype(np.int64) >> (CONTEXT_BITS - self.splits[at]))
            key[hot] = at.astype(np.uint64) << np.uint64(CONTEXT_BITS) | context[hot]
        return part, key


def tokens_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens, their contexts, and the number of tokens of each text (its end counts)."""
    found = [np.append(w, END) for w in words_of(texts)]
    sizes = np.array([len(f) for f in found], np.int64)
    word = np.concatenate(found) if found else np.zeros(0, np.uint64)
    before = np.concatenate([[START], word[:-1]]) if len(word) else word
    before[np.cumsum(sizes) - sizes] = START
    return word, mix(before) >> np.uint64(64 - CONTEXT_BITS), sizes


def plan_parts(source: DataFrame, part_tokens: int, hot_tokens: int) -> Parts:
    """Parts for all tokens. Words that are frequent in a piece of text are counted; those with too many tokens are split."""

    def count(batches):
        for b in batches:
            word, _, _ = tokens_of(b["text"])
            own, n = np.unique(word, return_counts=True)
            often = n >= max(16, len(word) >> 17)
            yield {"word": [None, *own[often].view(np.int64).tolist()], "n": [len(word), *n[often].tolist()]}

    found = map_rows(source.select("text"), count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    rows = found.where(F.col("word").isNull() | (F.col("n") > hot_tokens)).orderBy(F.col("word").isNotNull(), F.desc("n")).limit(MOST_HOT + 1).collect()
    total = rows[0]["n"] if rows else 0
    hot = sorted((r["word"] % (1 << 64), r["n"]) for r in rows[1:])
    splits = [min(CONTEXT_BITS, int(np.ceil(np.log2(n / hot_tokens)))) for _, n in hot]
    return Parts(max(1, int(total / part_tokens).bit_length()), np.array([w for w, _ in hot], np.uint64), np.array(splits, np.int64))


BLOBS = ("keys", "sizes", "places")
DOCUMENT = ("idx", "doc_id", "held_out", "n_tokens")


def blocks(source: DataFrame, parts: Parts) -> DataFrame:
    """A row for each document of a block, and one for each part of a block: its distinct keys, their tokens, and for each
    token its document in the block, doubled, plus one where it is held out."""

    def run(batches):
        block = TaskContext.get().partitionId() << 30
        held: list[tuple] = []
        n_docs = n_tokens = 0

        def flush():
            word, context, place = (np.concatenate([h[k] for h in held]) for k in range(3))
            part, key = parts.deal(word, context)
            order = np.argsort(part, kind="stable")
            part, key, place = part[order], key[order], place[order]
            firsts = np.flatnonzero(np.diff(part, prepend=-1))
            out = {k: [] for k in ("part", *BLOBS)}
            for a, b in zip(firsts, np.append(firsts[1:], len(part))):
                order = np.argsort(key[a:b], kind="stable")
                own = key[a:b][order]
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                out["part"].append(int(part[a]))
                for name, values in zip(BLOBS, (own[first], np.diff(np.append(first, len(own))).astype(np.uint32), place[a:b][order])):
                    out[name].append(packed(values))
            yield {"block": [block] * len(out["part"])} | out | {c: [None] * len(out["part"]) for c in DOCUMENT}

        for b in batches:
            at = 0
            while at < len(b["text"]):
                upto = min(len(b["text"]), at + BLOCK_DOCS - n_docs)
                ids, out_held = b["doc_id"][at:upto], b["held_out"][at:upto]
                word, context, sizes = tokens_of(b["text"][at:upto])
                idx = np.arange(n_docs, n_docs + len(ids))
                held.append((word, context, np.repeat(2 * idx + np.array(out_held, np.int64), sizes).astype(np.uint16)))
                none = [None] * len(ids)
                yield {"block": [block] * len(ids), "part": [-1 - ((block >> 30) + block) % 1024] * len(ids), "idx": idx, "doc_id": ids, "held_out": out_held, "n_tokens": sizes} | {c: none for c in BLOBS}
                n_docs, n_tokens, at = n_docs + len(ids), n_tokens + len(word), upto
                if n_tokens >= BLOCK_TOKENS or n_docs == BLOCK_DOCS:
                    yield from flush()
                    held, n_docs, n_tokens, block = [], 0, 0, block + 1
        if held:
            yield from flush()

    kind = dict(source.dtypes)["doc_id"]
    return map_rows(source, run, f"block long, part long, idx int, doc_id {kind}, held_out boolean, n_tokens long, keys binary, sizes binary, places binary")


def gather(dealt: DataFrame) -> DataFrame:
    """One row for each part, its blocks merged: keys, train (training tokens of each), sizes, and for each token its
    document in place and its block, a number in blocks. Rows of documents pass through. dealt is sorted by part."""

    def merged(part: int, rows: list[tuple]) -> dict:
        keys, sizes, places = (np.concatenate([unpacked(r[k], kind) for r in rows]) for k, kind in ((1, np.uint64), (2, np.uint32), (3, np.uint16)))
        number = np.repeat(np.arange(len(rows), dtype=np.uint32), [len(unpacked(r[1], np.uint64)) for r in rows])
        order = np.argsort(keys, kind="stable")
        start = (np.cumsum(sizes) - sizes)[order].astype(np.int64)
        keys, sizes, number = keys[order], sizes[order].astype(np.int64), number[order]
        token = np.arange(int(sizes.sum())) + np.repeat(start - np.cumsum(sizes) + sizes, sizes)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        total = np.add.reduceat(sizes, first)
        places = places[token]
        train = np.add.reduceat(1 - (places & 1).astype(np.int64), np.cumsum(total) - total)
        values = {"keys": keys[first], "train": train, "sizes": total.astype(np.uint32), "places": places, "numbers": np.repeat(number, sizes)}
        return {"part": [part], "blocks": [np.array([r[0] for r in rows], np.int64).tobytes()]} | {k: [packed(v)] for k, v in values.items()} | {c: [None] for c in ("block", *DOCUMENT)}

    fields = ("part", "blocks", "keys", "train", "sizes", "places", "numbers")

    def run(batches):
        part, rows = None, []
        for b in batches:
            is_doc = [p < 0 for p in b["part"]]
            if any(is_doc):
                own = [i for i, d in enumerate(is_doc) if d]
                yield {c: [b[c][i] for i in own] for c in ("block", *DOCUMENT)} | {"part": [b["part"][i] for i in own]} | {c: [None] * len(own) for c in fields[1:]}
            for i, d in enumerate(is_doc):
                if d:
                    continue
                if b["part"][i] != part and rows:
                    yield merged(part, rows)
                    rows = []
                part = b["part"][i]
                rows.append((b["block"][i], b["keys"][i], b["sizes"][i], b["places"][i]))
        if rows:
            yield merged(part, rows)

    kind = dict(dealt.dtypes)["doc_id"]
    return map_rows(dealt, run, f"part long, block long, idx int, doc_id {kind}, held_out boolean, n_tokens long, " + ", ".join(f"{c} binary" for c in fields[1:]))


@dataclass
class Model:
    """What holds for all parts: counts, discounts, and the totals before the first sweep and after each one."""

    parts: Parts
    total: int  # training tokens
    size: int  # words
    context_counts: np.ndarray
    hot_counts: np.ndarray
    discount: float  # of contexts
    parent_discount: float
    states: list[tuple[np.ndarray, np.ndarray, np.ndarray, float, float]]  # tables by context; customers, tables by hot word; all customers, all tables of the parent

    def parent(self, k: np.ndarray, t: np.ndarray, state: tuple) -> np.ndarray:
        base = (STRENGTH + self.parent_discount * state[4]) / (self.size + 1)
        return (np.maximum(k - self.parent_discount * t, 0) + base) / (STRENGTH + state[3])


class Part:
    """The restaurants' shares in one part: cells of a word and a context, by word."""

    def __init__(self, number: int, keys: np.ndarray, train: np.ndarray, parts: Parts):
        word = keys >> np.uint64(CONTEXT_BITS)
        self.context = (keys & np.uint64(CONTEXTS - 1)).astype(np.int64)
        self.first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        self.of = np.repeat(np.arange(len(self.first)), np.diff(np.append(self.first, len(keys))))
        self.train, self.keys, self.number = train, keys, number
        self.hot = word[self.first].astype(np.int64) if number >= 1 << parts.bits else None
        self.counts = np.add.reduceat(train, self.first)

    def sweeps(self, model: Model, upto: int):
        """For each sweep: tables of the cells, customers and tables of the words in the parent; of hot words only this part's customers."""
        t = (self.train > 0).astype(np.float64)
        k = np.add.reduceat(t, self.first)
        t_word = (k > 0).astype(np.float64)
        for i in range(upto):
            state = model.states[i]
            p = model.parent(k, t_word, state) if self.hot is None else model.parent(state[1], state[2], state)[self.hot]
            pull = (STRENGTH + model.discount * state[0][self.context]) * p[self.of]
            turn = np.uint64((self.number * 64 + i + 1) * 0xC2B2AE3D27D4EB4F % (1 << 64))
            seed = mix(self.keys + turn)
            t = seat(self.train, pull, model.discount, seed)
            k = np.add.reduceat(t, self.first)
            if self.hot is None:
                base = (STRENGTH + model.parent_discount * state[4]) / (model.size + 1)
                t_word = seat(k.astype(np.int64), np.full(len(k), base), model.parent_discount, mix((self.keys[self.first] >> np.uint64(CONTEXT_BITS)) - turn))
            yield t, k, t_word


def read_parts(batches, parts: Parts):
    for b in batches:
        for i, number in enumerate(b["part"]):
            yield i, b, Part(number, unpacked(b["keys"][i], np.uint64), unpacked(b["train"][i], np.int64), parts)


def summed(table: DataFrame, arrays: dict[str, int], add) -> dict[str, np.ndarray]:
    """Sums over all parts of arrays of the given sizes, which add(batches, sums) fills in each task."""

    def collect(batches):
        sums = {k: np.zeros(n) for k, n in arrays.items()}
        add(batches, sums)
        for k, v in sums.items():
            for at in range(0, len(v), CHUNK):
                if v[at : at + CHUNK].any():
                    yield {"name": [k], "at": [at], "values": [packed(v[at : at + CHUNK])]}

    def total(batches):
        sums: dict = {}
        for b in batches:
            for name, at, v in zip(b["name"], b["at"], b["values"]):
                sums[name, at] = sums.get((name, at), 0) + unpacked(v, np.float64)
        for (name, at), v in sums.items():
            yield {"name": [name], "at": [at], "values": [v.tobytes()]}

    schema = "name string, at int, values binary"
    out = {k: np.zeros(n) for k, n in arrays.items()}
    for r in map_rows(map_rows(table, collect, schema).repartition(16, "name", "at"), total, schema).collect():
        v = np.frombuffer(r["values"])
        out[r["name"]][r["at"] : r["at"] + len(v)] = v
    return out


def train(table: DataFrame, parts: Parts, sweeps: int) -> Model:
    """The model after burn-in and samples; its size is bounded by CONTEXTS and MOST_HOT."""

    def start(batches, sums):
        for _, _, p in read_parts(batches, parts):
            one = p.train > 0
            sums["tables"] += np.bincount(p.context[one], minlength=CONTEXTS)
            sums["contexts"] += np.bincount(p.context, p.train, CONTEXTS)
            k = np.add.reduceat(one.astype(np.int64), p.first)
            if p.hot is None:
                sums["numbers"][:5] += [p.train.sum(), (k > 0).sum(), k.sum(), (k == 1).sum(), (k == 2).sum()]
            else:
                sums["hot"][p.hot] += k
                sums["hot counts"][p.hot] += p.counts
            sums["numbers"][5:] += [(p.train == 1).sum(), (p.train == 2).sum()]

    n_hot = len(parts.hot)
    found = summed(table.select("part", "keys", "train"), {"tables": CONTEXTS, "contexts": CONTEXTS, "hot": n_hot, "hot counts": n_hot, "numbers": 7}, start)
    total, size, customers, w1, w2, c1, c2 = found["numbers"]
    hot_tables = (found["hot"] > 0).astype(np.float64)
    size += hot_tables.sum()
    usual = lambda one, two: min(0.95, max(0.05, one / (one + 2 * two))) if one else 0.5
    model = Model(parts, int(total + found["hot counts"].sum()), int(size), found["contexts"], found["hot counts"], usual(c1, c2), usual(w1, w2), [])
    model.states.append((found["tables"], found["hot"], hot_tables, customers + found["hot"].sum(), size))
    for i in range(sweeps):
        shared = table.sparkSession.sparkContext.broadcast(model)

        def sweep(batches, sums, i=i, shared=shared):
            for _, _, p in read_parts(batches, parts):
                *_, (t, k, t_word) = p.sweeps(shared.value, i + 1)
                sums["tables"] += np.bincount(p.context, t, CONTEXTS)
                if p.hot is None:
                    sums["numbers"] += [k.sum(), t_word.sum()]
                else:
                    sums["hot"][p.hot] += k

        found = summed(table.select("part", "keys", "train"), {"tables": CONTEXTS, "hot": n_hot, "numbers": 2}, sweep)
        base = (STRENGTH + model.parent_discount * model.states[-1][4]) / (model.size + 1)
        hot_tables = seat(found["hot"].astype(np.int64), np.full(n_hot, base), model.parent_discount, mix(parts.hot + np.uint64(i + 1)))
        customers, tables = found["numbers"]
        model.states.append((found["tables"], found["hot"], hot_tables, customers + found["hot"].sum(), tables + hot_tables.sum()))
    return model


def predict(p: Part, model: Model, burn_in: int) -> tuple[np.ndarray, np.ndarray]:
    """For each cell: training tokens of its word, and the log10 of its predictive probability."""
    out, n = np.zeros(len(p.keys)), len(model.states) - 1
    for i, (t, k, t_word) in enumerate(p.sweeps(model, n)):
        if i < burn_in:
            continue
        state = model.states[i + 1]
        word = model.parent(k, t_word, state) if p.hot is None else model.parent(state[1], state[2], state)[p.hot]
        weight = STRENGTH + model.discount * state[0][p.context]
        out += (np.maximum(p.train - model.discount * t, 0) + weight * word[p.of]) / (STRENGTH + model.context_counts[p.context])
    counts = p.counts if p.hot is None else model.hot_counts[p.hot].astype(np.int64)
    return counts[p.of], np.log10(out / (n - burn_in))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_tokens: int = PART_TOKENS, hot_tokens: int = HOT_TOKENS, burn_in: int = BURN_IN, samples: int = SAMPLES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every whole text.

    Null or empty text has the end token only. A null id is trained on. Repeated rows count and are scored each;
    other columns are ignored. Without training documents all words are the unknown one, of probability 1; an empty
    table gives no rows. Words are told apart by at least 47 bits of a hash, and more the more parts there are.
    """
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 10 == 0, F.lit(False))
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held.alias("held_out"))
    parts = plan_parts(source, part_tokens, hot_tokens)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts.count // 4)
    table = materialize(gather(blocks(source, parts).repartition(n, "part").sortWithinPartitions("part")), "lm-parts")
    cells = table.where("part >= 0")
    model = train(cells, parts, burn_in + samples)
    shared = spark.sparkContext.broadcast(model)
    # what whole needs of the model
    total, size = model.total, model.size

    # A token's share of a document: its word's count, from which the base follows, and its score; some five bytes.
    def score(batches):
        for i, b, p in read_parts(batches, parts):
            sizes = unpacked(b["sizes"][i], np.uint32)
            doc = unpacked(b["numbers"][i], np.uint32).astype(np.int64) << 15 | unpacked(b["places"][i], np.uint16).astype(np.int64) >> 1
            order = np.argsort(doc, kind="stable")
            doc, cell = doc[order], np.repeat(np.arange(len(sizes)), sizes)[order]
            counts, scores = predict(p, shared.value, burn_in)
            cuts = np.flatnonzero(np.diff(doc >> 15, prepend=-1))
            names = np.frombuffer(b["blocks"][i], np.int64)
            for a, z in zip(cuts, np.append(cuts[1:], len(doc))):
                values = ((doc[a:z] & 0x7FFF).astype(np.uint16), counts[cell[a:z]], scores[cell[a:z]].astype(np.float32))
                yield {"block": [int(names[doc[a] >> 15])]} | {c: [packed(v)] for c, v in zip(("idx", "counts", "scores"), values)}

    def whole(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for block, *blobs in zip(b["block"], b["idx"], b["counts"], b["scores"]):
                idx, counts, scores = (unpacked(v, kind) for v, kind in zip(blobs, (np.uint16, np.int64, np.float32)))
                values = (counts > 0, np.log10((counts + 0.1) / (total + 0.1 * (size + 1))), scores)
                own = held.setdefault(block, np.zeros((3, 0)))
                if (upto := int(idx[-1]) + 1) > own.shape[1]:
                    own = held[block] = np.pad(own, ((0, 0), (0, upto - own.shape[1])))
                own += [np.bincount(idx, v, own.shape[1]) for v in values]
        for block, (known, base, score) in held.items():
            yield {"block": [block] * len(known), "idx": list(range(len(known))), "n_known": np.rint(known).astype(np.int64), "base_score": base, "score": score}

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partial = map_rows(cells, score, "block long, idx binary, counts binary, scores binary").repartition(n, "block")
    sums = map_rows(partial, whole, "block long, idx int, n_known long, base_score double, score double")
    out = table.where("part < 0").select("block", *DOCUMENT).join(sums.hint("merge"), ["block", "idx"])
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score", perplexity)
