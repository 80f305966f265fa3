"""Hashes of words and of word shingles, for many texts at once.

A word's hash is a polynomial of its bytes modulo 2 ** 64 with random coefficients a byte value, so that one running
sum over a piece of text gives the hashes of all its words by subtraction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

PIECE = 1 << 18  # bytes that are hashed at once; longer words are hashed one by one
BLOCK = 4 << 20  # bytes of texts that are joined
WHITE = b" \t\n\x0b\x0c\r"
_WHITE = np.zeros(256, bool)
_WHITE[list(WHITE)] = True
_VALUE = np.array([xxhash.xxh3_64_intdigest(bytes([b])) for b in range(256)], np.uint64)
_BASE = 0xD6E8FEB86659FD93
_POWER, _INVERSE = (np.cumprod(np.array([1] + [b] * PIECE, np.uint64)) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x94D049BB133111EB, 0xBF58476D1CE4E5B9, 0xA0761D6478BD642F], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def lowered(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased; null counts as empty."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every word, a run of bytes other than space and \\t to \\r. data starts with white space."""
    starts, hashes, at, size = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0, len(data)
    while at < size:
        end = min(at + PIECE, size)
        if end < size and data[end] not in WHITE:
            end = max(data.rfind(c, at, end) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
            if end == at:  # white space, and then a word of PIECE bytes and more
                first = at + 1
                ends = [e for c in WHITE if (e := data.find(c, first)) >= 0]
                end = min(ends, default=size)
                starts.append(np.array([first]))
                hashes.append(np.array([xxhash.xxh3_64_intdigest(memoryview(data)[first:end])], np.uint64))
                at = end
                continue
        piece = np.frombuffer(data, np.uint8, end - at, at)
        edges = np.flatnonzero(np.diff(~_WHITE[piece], prepend=False, append=False))
        first, last = edges[::2], edges[1::2]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_VALUE[piece] * _POWER[: len(piece)], out=sums[1:])
        starts.append(first + at)
        hashes.append(mix((sums[last] - sums[first]) * _INVERSE[first] + (last - first).astype(np.uint64)))
        at = end
    return np.concatenate(starts), np.concatenate(hashes)


def words_of(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The hashes of each text's lower-cased words, in order."""
    at = 0
    while at < len(texts):
        block, held = [], 0
        while at < len(texts) and (not block or held < BLOCK):
            block.append(lowered(texts[at]))
            held += len(block[-1]) + 1
            at += 1
        starts, hashes = word_hashes(b"\n" + b"\n".join(block))
        ends = np.cumsum([len(t) + 1 for t in block]) + 1
        yield from np.split(hashes, np.searchsorted(starts, ends[:-1]))


def joined(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the width words from each place on."""
    n = len(words) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out += words[i : i + n] * _FACTORS[i]
    return mix(out)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    out = np.sort(values)
    keep = np.ones(len(out), bool)
    np.not_equal(out[1:], out[:-1], out=keep[1:])
    return out[keep]


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Each text's set of shingles as sorted distinct hashes; fewer words than width make one shingle, no words none."""
    return [distinct(joined(words, min(width, len(words)))) if len(words) else words for words in words_of(texts)]
