"""Each pattern of the report tables is met by the line that the queries render for it."""

import pytest

from wasteflow.operators import csr
from wasteflow.plans.facts import LINES


@pytest.mark.parametrize("table", list(csr.TABLES))
def test_each_pattern_has_its_line(table):
    rules = csr.TABLES[table]
    assert len(rules) == len(LINES[table])
    for rule, (line, *_) in zip(rules, LINES[table]):
        text = line.replace("{q50}", "57").replace("{q}", "7").replace("{year}", "1994").replace("{material}", "blue bolt")
        assert rule.pattern.search(text), (rule.pattern.pattern, text)
        assert len(csr.facts_of(text, (table,))) == 1
