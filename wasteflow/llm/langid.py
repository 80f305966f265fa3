"""Operator 4: language ID by rank-order n-gram profiles and out-of-place distance.

N-grams of one to three letters, words padded by a space, are counted over all training documents by language; a
profile is a language's most frequent n-grams in rank order. A document's own most frequent n-grams are compared
with each profile: every n-gram costs the difference of its ranks, or the profile's length where it is absent.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows

PROFILE = 400
HELD_GRAMS = 2_000_000  # n-grams that a task holds before it passes their counts on
PROFILE_ENTRIES = 2_000_000  # most entries of all profiles together that are sent to tasks (16 bytes each)
_LETTERS = np.zeros(0x110000, bool)


def _letters() -> np.ndarray:
    if not _LETTERS.any():
        _LETTERS[[i for i in range(0x110000) if chr(i).isalpha()]] = True
    return _LETTERS


def letters_only(text: str) -> np.ndarray | None:
    """Code points of the lower-cased text with one space for each run of other characters; None without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    is_letter = _letters()[points]
    if not is_letter.any():
        return None
    points = np.where(is_letter, points, 32)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    return np.concatenate([[32], points[keep], [32]])


def grams(points: np.ndarray) -> np.ndarray:
    """Codes of the n-grams with n from 1 to 3, 21 bits a character; a space stands only at an end."""
    two = points[:-1] << 21 | points[1:]
    three = two[:-1] << 21 | points[2:]
    space = points == 32
    return np.concatenate([points[~space], two[~(space[:-1] & space[1:])], three[~(space[1:-1] | (space[:-2] & space[2:] & space[1:-1]))]])


def ranked(codes: np.ndarray, top: int) -> np.ndarray:
    """The most frequent codes, ties to the smaller code."""
    values, counts = np.unique(codes, return_counts=True)
    return values[np.argsort(-counts, kind="stable")[:top]]


def train_profiles(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", top: int = PROFILE) -> DataFrame:
    """lang, code, rank (from 0): each language's profile from all rows with a language and a text."""

    def count(batches):
        texts: dict[str, list] = {}
        held = 0

        def counted():
            for lang, found in texts.items():
                values, counts = np.unique(np.concatenate(found), return_counts=True)
                yield {"lang": [lang] * len(values), "code": values, "n": counts}

        for b in batches:
            for lang, text in zip(b["lang"], b["text"]):
                if (points := letters_only(text)) is not None:
                    texts.setdefault(lang, []).append(own := grams(points))
                    held += len(own)
                if held >= HELD_GRAMS:
                    yield from counted()
                    texts.clear()
                    held = 0
        yield from counted()

    counted = map_rows(docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null"), count, "lang string, code long, n long")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    return counted.groupBy("lang", "code").agg(F.sum("n").alias("n")).withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < top).select("lang", "code", "rank")


def predict(docs: DataFrame, profiles: DataFrame, top: int = PROFILE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All of docs' columns, and lang_pred and score.

    `und` and 0 where text is null or holds no letter, or no profile exists. Of languages at equal distance, the
    first by name. score: how much nearer the best language is than the next, or, with one language, than nothing.
    Clashing columns lang_pred and score of docs are replaced.
    """
    kept = profiles.limit(PROFILE_ENTRIES + 1).collect()
    if len(kept) > PROFILE_ENTRIES:
        raise ValueError(f"more than {PROFILE_ENTRIES} profile entries: use a shorter profile")
    langs = sorted({r["lang"] for r in kept})
    codes = np.array(sorted({r["code"] for r in kept}), np.int64)
    ranks = np.full((len(codes) + 1, len(langs)), -1, np.int32)
    place = {c: i for i, c in enumerate(codes.tolist())}
    for r in kept:
        ranks[place[r["code"]], langs.index(r["lang"])] = r["rank"]

    def label(text: str | None) -> tuple[str, float]:
        points = letters_only(text) if text and langs else None
        if points is None:
            return "und", 0.0
        own = ranked(grams(points), top)
        at = np.searchsorted(codes, own)
        at[codes[np.minimum(at, len(codes) - 1)] != own] = len(codes)
        found = ranks[at]
        cost = np.where(found < 0, top, np.abs(found - np.arange(len(own))[:, None])).sum(0)
        best = int(np.argmin(cost))
        other = np.delete(cost, best).min() if len(langs) > 1 else top * len(own)
        return langs[best], float(other - cost[best]) / float(max(other, 1))

    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema) + ", lang_pred string, score double"

    def run(batches):
        for b in batches:
            found = [label(t) for t in b[text_col]]
            yield b | {"lang_pred": [x[0] for x in found], "score": [x[1] for x in found]}

    return map_rows(docs.select(*names), run, schema)


def held_out(id_col: str = "doc_id") -> F.Column:
    """Whether crc32 of the id as text leaves remainder 2 by 4; a null id is held out of nothing."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, top: int = PROFILE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learns from those not held out that have a lang."""
    learn = docs.where(~held_out())
    out = predict(docs.select("doc_id", "text"), train_profiles(learn, top=top), top)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
