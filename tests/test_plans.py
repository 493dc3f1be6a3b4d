"""Plans that must hold at scale: no nested loops, one full-row shuffle, only
the needed columns read."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loanpanel.operators import identity, link_claims, link_rules, rate_panel, typos

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def kept(spark):
    from loanpanel.plans.queries import kept_panel

    return kept_panel(spark, SF)


def no_nested_loops(text: str) -> None:
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_repeated_ids_count_before_the_shuffle(spark, kept):
    text = plan(identity.repeated_ids(identity.with_loan_id(kept.drop("id"))))
    first = text[: text.rindex("Exchange hashpartitioning(id")]
    assert text.count("Exchange") == 2 and "HashAggregate" in text[len(first):]


def test_rate_panel_shuffles_once_and_reads_few_columns(spark, kept):
    text = plan(rate_panel.rate_panel(kept, [2022, 2023, 2024]))
    assert text.count("Exchange") == 1
    schema = text[text.index("ReadSchema"):]
    assert "agreed_amount" not in schema and "rate_text" in schema
    assert "PartitionFilters: [year" in text


def test_blocked_joins_have_no_nested_loop(spark, kept):
    ids = kept.select("source_file", F.col("lender_ico").alias("a"))
    refs = kept.select("source_file", F.col("lender_ico").alias("b"))
    no_nested_loops(plan(typos.near_pairs(ids, refs, ["source_file"], "a", "b", 1)))
    rows = link_rules.link_rows(kept, (2021, 2022, 2023, 2024), "composite_id")
    edges = link_claims.candidate_edges(rows, 0.001)
    no_nested_loops(plan(edges))
    no_nested_loops(plan(link_rules.shared_starts(rows, rows)))


def test_last_claimed_is_limited_before_the_shuffle(spark):
    rows = spark.range(100).selectExpr("id % 3 AS k", "id AS c_pos", "id AS t")
    text = plan(link_claims.last_claimed(rows, ["k"], 2))
    assert "WindowGroupLimit" in text[text.index("Exchange hashpartitioning(k"):]
