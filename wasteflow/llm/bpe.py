"""Operator 6: exact byte-level BPE encoding by backtracking, and decoding by an offset table.

The longest tokens that start at each position come from one Aho-Corasick pass. The encoder walks forward with
the longest one, keeps it only if it is compatible with the token before it (the merges would not have joined
across or split them), otherwise tries its shorter prefixes, and steps back when none is left. Positions that
failed are marked, so each is tried once and the walk is linear. Words repeat, so a bounded cache holds their ids.
"""

from __future__ import annotations

import functools
import hashlib
import json
from array import array

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

# Fixed value: the public pattern that splits text before byte-level merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHED_WORDS = 700_000
CACHED_PAIRS = 400_000


def byte_chars() -> list[str]:
    """The printable character that stands for each byte: itself where printable in Latin-1, else 256 and on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class Codec:
    """Tables of one vocabulary file: automaton, prefix links, merge pairs, split table, byte offsets."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.chars = byte_chars()
        to_byte = {c: b for b, c in enumerate(self.chars)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.pairs: dict[tuple[int, int], int] = {}
        self.parts: list[tuple[int, int] | None] = [None] * size
        for pair in merges:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            made = vocab[left + right]
            self.pairs[vocab[left], vocab[right]] = made
            self.parts[made] = (vocab[left], vocab[right])
        self.length = [0] * size
        self.prefix = [-1] * size
        self.automaton = ahocorasick.Automaton()
        specials = set(self.special)
        for word, i in vocab.items():
            if word in specials:
                continue
            self.length[i] = len(word)
            self.automaton.add_word(word, i)
            self.prefix[i] = next((vocab[word[:n]] for n in range(len(word) - 1, 0, -1) if word[:n] in vocab), -1)
        self.automaton.make_automaton()
        raw = {i: bytes(to_byte[c] for c in w) for w, i in vocab.items() if w not in specials}
        raw |= {i: w.encode() for w, i in self.special.items()}
        self.blob = b"".join(raw.get(i, b"") for i in range(size))
        self.offset = array("Q", [0])
        for i in range(size):
            self.offset.append(self.offset[-1] + len(raw.get(i, b"")))
        self.split = regex.compile(SPLIT)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.table = str.maketrans({chr(b): c for b, c in enumerate(self.chars)})
        self.bytes = np.frombuffer(self.blob, np.uint8)
        self.starts = np.frombuffer(self.offset, np.uint64).astype(np.int64)
        self.known: dict[int, bool] = {}
        self.cache: dict[str, tuple[str, bytes]] = {}

    def _compatible(self, left: int, right: int) -> bool:
        """Would the merges leave these neighbours apart? Undoes the younger of the two merges step by step and
        looks for a pair at the border that would have been merged before the pieces were complete."""
        limit = len(self.parts)
        while True:
            if self.pairs.get((left, right), limit) < limit:
                return False
            if left > right:
                limit = left
                part = self.parts[left]
                if part:
                    left = part[1]
                    continue
                limit, part = right + 1, self.parts[right]
                if not part:
                    return True
                right = part[0]
            else:
                limit = right + 1
                part = self.parts[right]
                if part:
                    right = part[0]
                    continue
                limit, part = left, self.parts[left]
                if not part:
                    return True
                left = part[1]

    def encode_word(self, word: str) -> list[int]:
        """Ids of one split word, given in byte characters."""
        n = len(word)
        longest, length, known = [-1] * n, self.length, self.known
        for end, i in self.automaton.iter(word):  # ends only grow, so the last match of a start is its longest
            longest[end - length[i] + 1] = i
        ids: list[int] = []
        open_ends = bytearray(b"\1") * (n + 1)
        at, token = 0, longest[0]
        while True:
            end = at + length[token]
            fits = open_ends[end]
            if fits and ids:
                key = ids[-1] << 32 | token
                fits = known.get(key)
                if fits is None:
                    if len(known) >= CACHED_PAIRS:
                        known.clear()
                    fits = known[key] = self._compatible(ids[-1], token)
            if fits:
                ids.append(token)
                at = end
                if at == n:
                    return ids
                token = longest[at]
                continue
            if self.prefix[token] >= 0:
                token = self.prefix[token]
                continue
            open_ends[at] = 0
            token = ids.pop()
            at -= length[token]

    def pieces(self, text: str) -> list[tuple[str, bytes]]:
        """For each split word, its ids as decimal strings joined by commas, and as little-endian unsigned 32-bit."""
        cache, out = self.cache, []
        for part in self.cut.split(text) if self.cut else (text,):
            if part in self.special:
                out.append(packed([self.special[part]]))
                continue
            words = self.split.findall(part)
            missing = {*words}.difference(cache)
            if len(cache) + len(missing) > CACHED_WORDS:
                cache.clear()
                missing = {*words}
            for w in missing:
                cache[w] = packed(self.encode_word(w.encode().decode("latin-1").translate(self.table)))
            out.extend(map(cache.__getitem__, words))
        return out

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join([p[1] for p in self.pieces(text)]), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: each id's bytes are copied from the table by its offset."""
        first, size = self.starts[ids], self.starts[np.add(ids, 1)] - self.starts[ids]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)
        return self.bytes[at].tobytes().decode("utf-8", "replace")


def packed(ids: list[int]) -> tuple[str, bytes]:
    return ",".join(map(str, ids)), array("I", ids).tobytes()


@functools.lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


def bpe_round_trip(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, decoded if with_ids) of every whole text.

    Null text counts as empty: no tokens and the digests of empty strings. Null or repeated ids and repeated rows
    give a row each; other columns are ignored. Very long texts are encoded whole. An empty table gives none.
    """
    schema = f"doc_id {dict(docs.dtypes)[id_col]}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if with_ids else ""

    def run(batches):
        c = codec(vocab_path)
        for b in batches:
            out = {k: [] for k in ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")}
            out["doc_id"] = b["doc_id"]
            for text in b["text"]:
                pieces = c.pieces(text or "")
                joined = ",".join([p[0] for p in pieces])
                ids = np.frombuffer(b"".join([p[1] for p in pieces]), "<u4")
                decoded = c.decode(ids)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    out["ids"].append(ids.tolist())
                    out["decoded"].append(decoded)
            yield out

    return map_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, schema)
