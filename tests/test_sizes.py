"""What a task holds does not grow with the table."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from loanpanel.operators import decisions, link_rules, lookup, rate_panel, typos
from loanpanel.plans import sample_panel
from loanpanel.sources import scratch


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def orders(spark, folder, n):
    rows = spark.range(0, n, 1, 2 * spark.sparkContext.defaultParallelism).selectExpr(
        "id AS o_orderkey", "id % 50 AS o_custkey", "CASE id % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS o_orderstatus",
        "id * 1000.0D AS o_totalprice", "timestamp'1995-01-01 00:00:00' AS o_orderdate", "'3-MEDIUM' AS o_orderpriority",
    )
    rows.write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_tasks_of_the_panel_follow_the_rows(spark, tmp_path, monkeypatch):
    folder = orders(spark, tmp_path, 900)
    want = sorted(map(tuple, sample_panel.derive_panel(spark, folder).collect()), key=repr)
    monkeypatch.setattr(sample_panel, "ORDERS_PER_TASK", 30)
    panel = sample_panel.derive_panel(spark, folder)
    in_task = panel.filter("statement <> 'ZZZ'").groupBy(F.spark_partition_id()).count().collect()
    assert len(in_task) > 25 and max(n for _, n in in_task) < 4 * 100
    assert sorted(map(tuple, panel.collect()), key=repr) == want


def test_tables_by_year_are_written_without_a_sort(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "CAST(2021 + id % 4 AS INT) AS year")
    stored = scratch.materialise(rows, "by-year", partition_by=["year"])
    assert stored.groupBy("year").count().count() == 4 and stored.count() == 1000
    rows.createOrReplaceTempView("rows_by_year")
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", scratch.OPEN_FILES)
    text = spark.sql(
        f"EXPLAIN INSERT OVERWRITE DIRECTORY '{tmp_path}/x' USING parquet SELECT * FROM rows_by_year"
    ).first()[0]
    assert "Sort" not in text


def test_a_lookup_without_heavy_keys_reads_the_facts_once(spark):
    facts = spark.range(100).selectExpr("id % 10 AS k", "id")
    table = spark.range(8).selectExpr("id AS k", "id * 2 AS v", "10L AS n")
    out = lookup.lookup(facts, table, ["k"], weight="n", broadcast_rows=2)
    assert "Union" not in plan(out)
    assert sorted(map(tuple, out.select("k", "id", "v").collect()), key=repr) == sorted(
        ((i % 10, i, i % 10 * 2 if i % 10 < 8 else None) for i in range(100)), key=repr
    )


DAYS = [
    "20210228", "20210229", "20200229", "16770921", "16770922", "22620411", "22620412", "99991231", "00000101",
    "2021022", "202102281", "+20210228", "-20210228", "2021-2-8", "20210 28", "2021022 ", " 20210228", "20210228\n",
    "neznámé", "", "20211301", "20210100", "２０２１０２２８", None,
]


def test_days_as_a_formatter_reads_them(spark):
    rows = spark.createDataFrame([(d,) for d in DAYS], "d string")
    was = F.try_to_date("d", "yyyyMMdd")
    was = F.when(was.between(F.lit("1677-09-22").cast("date"), F.lit("2262-04-11").cast("date")), was)
    now = link_rules._day(F.col("d"))
    assert "gettimestamp" not in plan(rows.select(now))
    for day, a, b in rows.select("d", was, now).collect():
        assert a == b, day


@pytest.mark.parametrize("few", [0, 3, 20])
def test_small_groups_are_compared_without_keys(spark, few):
    texts = ["".join(t) for n in (2, 3) for t in itertools.product("ab", repeat=n)]
    left = [(g, t) for g in "xyz" for t in texts] + [(None, "ab"), ("x", None)]
    right = [(g, t) for g, n in (("x", 2), ("y", 4), ("w", 5)) for t in texts[:n]] + [(None, "ab")]
    a, b = (spark.createDataFrame(rows, f"g string, {c} string") for rows, c in ((left, "a"), (right, "b")))
    got = typos.near_pairs(a, b, ["g"], "a", "b", 1, few)
    want = a.join(b, "g").filter("levenshtein(a, b) <= 1").distinct()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("g", "a", "b").collect()))


def test_strings_are_not_sorted_before_the_shuffle(spark):
    rows = spark.createDataFrame([("i", 2022, "1", "2", "p", None)], "id string, year int, drawn_amount string, rate_text string, purpose string, dedup_suffix string")
    text = plan(rate_panel.rate_panel(rows, [2022, 2023]))
    assert text.count("Exchange") == 1 and "Aggregate" not in text[text.index("Exchange") :]
    store = spark.createDataFrame([("a", "b", "Y", 1), ("a", "b", "N", 2)], "y1_composite_id string, y2_composite_id string, decision string, seq long")
    latest = decisions.latest_decisions(store)
    text = plan(latest)
    assert text.count("Exchange") == 1 and "Aggregate" not in text[text.index("Exchange") :]
    assert [tuple(r) for r in latest.collect()] == [("a", "b", "N")]
