from __future__ import annotations

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"
# One representative of each step; tests/oracle_check.py runs all of them.
NAMES = (
    "loan_id", "exclusion_reason", "loss_report", "amount_histogram", "control_total", "enrich", "missing_ids",
    "typo_candidates", "rate_panel", "missing_next_year", "link_candidates", "amount_matches", "unique_amount_link",
    "link_signals", "gap_candidates", "ingest_reviews", "decisions_applied",
)


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, tables, name):
    assert compare(entry.queries()[name](spark, SF), tables, entry.oracle_sql()[name]) is None


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    without = set(entry.queries()) - set(entry.oracle_sql())
    assert {n for n in without if n != "pipeline" and not n.startswith("op")} == {"purpose_similarity"}
    assert entry.entry(spark).count() == 4
