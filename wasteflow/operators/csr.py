"""Sustainability-report facts by pattern tables: waste, emissions, energy, money, carbon credits.

The patterns are fixed values in rules.py. Each has roles for its groups, so a match is read by name: n (number), unit,
times (a multiplier), kind and item. One pass over the texts in Arrow batches finds all facts of a table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules as R
from .facts import scan_texts

# For each pattern of a table in order: the roles of its groups, the words of which a text must hold one (lower case;
# what spares most texts most patterns), and for carbon credits the kind.
WASTE = (
    ("kind n unit item", "recycle dispose generate divert recover"), ("item n unit", "waste"), ("n unit item kind", "recycle dispose generate"),
    ("n unit", "waste"), ("n", "waste"), ("n", "waste"), ("item n unit", "waste"),
)
EMISSIONS = (("kind n times unit", "co2 co₂ carbon ghg greenhouse"), ("kind n unit", "scope"), ("n unit", "reduce"), ("n times unit", "footprint"), ("kind n unit", "methane ch4 nox sox"))
ENERGY = (("n unit", "consumption usage"), ("n unit", "save reduce"), ("n unit", "renewable clean green"), ("n unit", "renewable"), ("n unit", "solar"))
FINANCIALS = (
    ("n times", "sav"), ("n times", "revenue income"), ("n times", "invest"), ("n times", "cost expense"), ("n times", "cost expense"),
    ("n times", "revenue"), ("n times", "usd eur €"), ("n", "$"),
)
CARBON_CREDITS = (
    ("n", "purchase bought acquire", "purchased"), ("n", "purchase bought acquire", "purchased"), ("n", "offset", "offset"), ("n", "offset", "offset"),
    ("n times", "$", "spend"), ("n times", "carbon offset", "spend"), ("n times", "invest spen", "spend"), ("n", "price", "price"), ("n", "per /", "price"),
    ("n", "eu ets", "allowances"), ("n", "retire surrender", "retired"), ("n times", "trading", "trading"), ("n", "sold selling", "sold"), ("n", "vcs verra gold", "certified"), ("n", "neutral net", "target"),
)
ENERGY_OR_MASS = re.compile(r"\b(?:mwh|gwh|twh|kwh|gj|tj|mj|btu|tonnes|tons|kg|kilotons|kt)\b", re.I)
TIMES = {"million": 1e6, "m": 1e6, "billion": 1e9, "b": 1e9}
MULTIPLIER = re.compile(r"\s*(million|billion|m|b)\b", re.I)
MONEY_UNITS = ("spend", "price", "trading")

SCHEMA = "fact string, kind string, item string, value double, unit string, quote string"


class Rule:
    """One pattern with the roles of its groups."""

    def __init__(self, pattern: str, roles: str, words: str, label: str = ""):
        self.pattern, self.words, self.label = re.compile(pattern, re.I), words.split(), label
        self.places = {role: i for i, role in enumerate(roles.split(), 1)}

    def may_hit(self, low: str) -> bool:
        return any(w in low for w in self.words)

    def amount(self, m: re.Match) -> float | None:
        """The number, times the multiplier that follows it within the match."""
        n = self.places["n"]
        try:
            value = float(m[n].replace(",", "").rstrip("."))
        except ValueError:
            return None
        times = MULTIPLIER.match(m[0], m.end(n) - m.start())
        return value * TIMES[times[1].lower()] if times else value

    def group(self, m: re.Match, role: str) -> str | None:
        found = m[self.places[role]] if role in self.places else None
        return " ".join(found.lower().split()) if found else None


def energy_kind(quote: str) -> str:
    q = quote.lower()
    return "savings" if re.search("save|reduc", q) else "renewable" if re.search("renewable|solar|clean|green", q) else "consumption" if re.search("consum|usage", q) else "other"


def money_kind(quote: str) -> str:
    q = quote.lower()
    for name, words in (("savings", "sav|reduction"), ("revenue", "revenue|income"), ("investment", "invest"), ("unit cost", r"per|/"), ("cost", "cost|expense")):
        if re.search(words, q):
            return name
    return "other"


TABLES = {
    name: [Rule(pattern, *how) for pattern, how in zip(patterns, hows, strict=True)]
    for name, patterns, hows in (
        ("waste", R.WASTE_PATTERNS, WASTE), ("emission", R.EMISSION_PATTERNS, EMISSIONS), ("energy", R.ENERGY_PATTERNS, ENERGY),
        ("financial", R.FINANCIAL_PATTERNS, FINANCIALS), ("carbon_credit", R.CARBON_CREDIT_PATTERNS, CARBON_CREDITS),
    )
}


def facts_of(text: str, tables: tuple[str, ...] = tuple(TABLES)) -> list[tuple]:
    """(fact, kind, item, value, unit, quote) in table and pattern order; the same fact counts once."""
    out: dict[tuple, tuple] = {}
    low = text.lower() if text.isascii() else None  # other letters may fold to ASCII ones: no shortcut then
    for table in tables:
        for rule in TABLES[table]:
            if low is not None and not rule.may_hit(low):
                continue
            for m in rule.pattern.finditer(text):
                value, quote = rule.amount(m), " ".join(m[0].split())
                kind, item, unit = rule.group(m, "kind"), rule.group(m, "item"), rule.group(m, "unit")
                if value is None:
                    continue
                if table == "energy":
                    kind = energy_kind(quote)
                elif table == "financial":
                    per_ton = re.search(r"(?:per|/)\s*(?:ton|tonne|mt)", quote, re.I)
                    if (ENERGY_OR_MASS.search(quote) and not per_ton) or (not per_ton and not 1e3 <= value <= 1e11):
                        continue
                    kind, unit = money_kind(quote), "usd/ton" if per_ton else "usd"
                elif table == "carbon_credit":
                    kind, unit = rule.label, "usd" if rule.label in MONEY_UNITS else "year" if rule.label == "target" else "credits"
                out.setdefault((table, kind, item, value), (table, kind, item, value, unit, quote))
    return list(out.values())


def csr_facts(df: DataFrame, tables: tuple[str, ...] = tuple(TABLES), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Facts of every text with its key; null and empty texts give none."""
    return scan_texts(df, lambda t: facts_of(t, tables), SCHEMA, key, text)


def csr_to_tables(facts: DataFrame, company: str = "company", year: str = "year") -> tuple[DataFrame, DataFrame]:
    """Waste facts as listings, and emission facts in tonnes, tons or tCO2e as carbon rows."""
    waste = facts.where("fact = 'waste'").select(F.col(company).alias("source_company"), F.coalesce("item", F.lit("waste")).alias("material"), F.col("value").alias("quantity_tons"), F.col("kind").alias("treatment_method"), F.col("quote").alias("source_quote"), F.col(year).alias("year"))
    carbon = facts.where("fact = 'emission'").select(F.col(company).alias("company"), F.when(F.col("unit").rlike("^(tonnes?|tons?|tco2e?)$"), F.col("value")).alias("co2_tons"), F.col("kind").alias("scope"), F.col("quote").alias("source_quote"), F.col(year).alias("year"))
    return waste, carbon
