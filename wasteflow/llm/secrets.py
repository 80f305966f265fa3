"""Operator 5: secret spans: fixed patterns, and a token-efficiency test for random strings.

A random string falls apart into many short tokens under a BPE vocabulary, while words and names do not: runs with
few characters a token are spans of kind `random`. Only digests, UUIDs, numbers, and paths or slugs whose separated
parts are efficient themselves are excluded; the ratio decides all else.
"""

from __future__ import annotations

import functools
import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows
from .packing import encoder

# The base patterns, in order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_LONG = re.compile(r"[0-9a-f]{16,}")  # the same matches of 16 and more: a run is taken whole
KINDS = ("assign", "access", "hex")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64})")
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
NUMBERS = re.compile(r"[0-9_=/+-]+")
SEPARATORS = re.compile(r"[_=/+-]+")
MAX_RATIO = 2.2
CACHED = 256


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX_LONG.finditer(text)]
    return sorted(found)


@functools.lru_cache(1 << 16)
def cached_ratio(run: str, vocab_path: str) -> float:
    return len(run) / len(encoder(vocab_path).encode_ordinary(run))


def ratio(run: str, vocab_path: str) -> float:
    """Characters per token; only short runs, which repeat, are remembered."""
    return cached_ratio(run, vocab_path) if len(run) <= CACHED else cached_ratio.__wrapped__(run, vocab_path)


def is_known(run: str) -> bool:
    """A digest, a UUID or a number."""
    return bool(DIGEST.fullmatch(run) or UUID.fullmatch(run) or NUMBERS.fullmatch(run))


def is_slug(run: str, vocab_path: str, max_ratio: float = MAX_RATIO) -> bool:
    """A path or slug: separated parts, each a number, at most two characters long, or efficient, and one at least efficient.

    Parts in capitals are judged in lower case, as constants' names are.
    """
    parts = [p for p in SEPARATORS.split(run) if len(p) > 2 and not p.isdigit()]
    return parts != [run] and bool(parts) and all(ratio(p.lower() if p.isupper() else p, vocab_path) > max_ratio for p in parts)


def is_random(run: str, vocab_path: str, max_ratio: float = MAX_RATIO) -> bool:
    return not is_known(run) and ratio(run, vocab_path) <= max_ratio and not is_slug(run, vocab_path, max_ratio)


def random_spans(text: str, vocab_path: str, max_ratio: float = MAX_RATIO) -> list[tuple[int, int]]:
    return [(m.start(), m.end()) for m in CANDIDATE.finditer(text) if is_random(m[0], vocab_path, max_ratio)]


SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"


def scan(text: str, vocab_path: str, max_ratio: float = MAX_RATIO) -> tuple:
    base = base_spans(text)
    name = [f"{KINDS[k]}:{a}:{b}" for a, k, b in base]
    extra = random_spans(text, vocab_path, max_ratio)
    spans = sorted([(a, k, b, n) for (a, k, b), n in zip(base, name)] + [(a, len(KINDS), b, f"random:{a}:{b}") for a, b in extra])
    counts = [sum(k == i for _, k, _ in base) for i in range(len(KINDS))]
    return (*counts, hashlib.sha256(",".join(name).encode()).hexdigest(), ",".join(s[3] for s in spans), len(extra))


def find_secrets(docs: DataFrame, vocab_path: str, max_ratio: float = MAX_RATIO, text_col: str = "text") -> DataFrame:
    """docs' columns with n_assign, n_access, n_hex, base_sha256, spans and n_random added (clashing ones replaced).

    Null text counts as empty: no spans, the digest of the empty string. Whole texts of any length are searched;
    repeated rows are searched each; an empty table gives none. Positions are code points, the end exclusive.
    """
    added = [c.split()[0] for c in SCHEMA.split(", ")]
    kept = docs.select(*[c for c in docs.columns if c not in added])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", " + SCHEMA

    def run(batches):
        for b in batches:
            rows = [scan(t or "", vocab_path, max_ratio) for t in b[text_col]]
            yield b | dict(zip(added, map(list, zip(*rows)))) if rows else b | {a: [] for a in added}

    return map_rows(kept, run, schema)


def redact(docs: DataFrame, vocab_path: str, max_ratio: float = MAX_RATIO) -> DataFrame:
    """docs with every span's text replaced by [SECRET]; documents without one are unchanged. n_chars, if there, is set anew."""

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        spans = [(a, b) for a, _, b in base_spans(text)] + random_spans(text, vocab_path, max_ratio)
        out, at = [], 0
        for a, b in sorted(spans):
            if b > at:
                if a >= at:
                    out += [text[at:a], "[SECRET]"]
                at = b
        return "".join([*out, text[at:]])

    def run(batches):
        for b in batches:
            yield b | {"text": [clean(t) for t in b["text"]]}

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    out = map_rows(docs, run, schema)
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out
