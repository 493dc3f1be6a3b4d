"""A panel of yearly loan reports derived from the orders table.

Every order is a loan reported each year from 2021 to 2024. Its status and
priority decide in which years it is reported; its key decides which faults
the hand-typed columns show. All orders are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ORDERS_PER_TASK = 100_000  # some 300,000 reports, which a task sorts by year to write them

_SPARK_SQL = """
WITH base_loans AS (
  SELECT o_orderkey AS k, o_custkey AS c,
         CAST(floor(o_totalprice / 25000) * 25000 AS BIGINT) AS base,
         trunc(o_orderdate, 'month') AS month,
         o_orderstatus AS st, o_orderpriority AS pr,
         explode(sequence(2021, 2024)) AS year
  FROM {orders}
), reported AS (
  SELECT * FROM base_loans
  WHERE NOT ((st = 'F' AND pr = '5-LOW' AND year > 2022)
          OR (st = 'F' AND pr = '4-NOT SPECIFIED' AND year > 2021)
          OR (st = 'P' AND pr = '1-URGENT' AND year = 2022)
          OR (st = 'P' AND pr = '2-HIGH' AND year IN (2022, 2023))
          OR (st = 'O' AND pr = '2-HIGH' AND year < 2023))
), copied AS (
  SELECT *, explode(sequence(0, IF(k % 61 = 0 AND year = 2021 + (k DIV 61) % 4, 1, 0))) AS copy
  FROM reported
), facts AS (
  SELECT *, (c + k % 3) % 120 AS bank,
         CAST(45000000 + ((c + k % 3) % 120) * 1001 AS STRING) AS bank_ico,
         base + IF(k % 13 = 0 AND year >= 2023, 50000, 0) + IF(k % 9 = 0 AND year = 2022, 10, 0) AS amount,
         concat('Výstavba č. ', k % 17) AS use_text,
         date_add(add_months(month, CAST((22 + k % 9) * 12 AS INT)),
                  IF(k % 7 = 0 AND year >= 2022, 400, 0)
                  - IF(k % 14 = 0 AND year >= 2023, 500, 0)
                  + IF(k % 41 = 0 AND year >= 2022, 10, 0)) AS maturity
  FROM copied
)
SELECT concat('loans_', year, '012.tsv') AS source_file, year, k * 2 + copy AS pos,
       '80' AS statement,
       CAST(1000000000 + c AS STRING) AS muni_id,
       CAST(200000 + c AS STRING) AS borrower_ico,
       CASE WHEN k % 97 = 0 THEN '0'
            WHEN k % 101 = 0 THEN NULL
            WHEN k % 89 = 0 THEN left(bank_ico, 7)
            WHEN k % 83 = 0 AND year >= 2023 THEN concat(bank_ico, '.0')
            ELSE bank_ico END AS lender_ico,
       CASE WHEN k % 53 = 0 THEN NULL
            WHEN k % 31 = 0 THEN concat('Banka ', bank, ', a.s.')
            ELSE concat('Banka ', bank) END AS lender_name,
       CASE WHEN k % 47 = 0 THEN NULL
            WHEN copy = 1 AND k % 2 = 0 THEN 'rekonstrukce'
            WHEN k % 3 = 0 AND year >= 2023 THEN concat(upper(use_text), ' ')
            ELSE use_text END AS purpose,
       CASE WHEN year = 2021 THEN NULL
            WHEN k % 8 = 0 THEN '1,32'
            WHEN k % 8 = 1 THEN '2.46%'
            WHEN k % 8 = 2 THEN '4,20% p.a.'
            WHEN k % 8 = 3 THEN 'bezúročná'
            WHEN k % 8 = 4 THEN '6M PRIBOR + 0,45%p.a.'
            WHEN k % 8 = 5 THEN NULL
            WHEN k % 8 = 6 THEN concat(year - 2020, ',5')
            WHEN year = 2022 THEN '0,00'
            ELSE '0' END AS rate_text,
       CASE WHEN k % 131 = 0 THEN 'neznámé'
            WHEN k % 71 = 0 AND year = 2023 THEN concat(date_format(month, 'yyyyMM'), '11')
            ELSE date_format(month, 'yyyyMMdd') END AS signed_on,
       date_format(maturity, 'yyyyMMdd') AS matures_on,
       CASE WHEN k % 211 = 0 THEN 'neuvedeno'
            WHEN k % 5 = 0 THEN concat(amount, ',50')
            WHEN k % 11 = 0 AND amount >= 1000
              THEN concat(amount DIV 1000, ' ', lpad(CAST(amount % 1000 AS STRING), 3, '0'))
            ELSE CAST(amount AS STRING) END AS agreed_amount,
       CASE WHEN k % 43 = 0 THEN NULL
            WHEN k % 11 = 0 AND amount * 4 DIV 5 >= 1000
              THEN concat(amount * 4 DIV 5 DIV 1000, ' ', lpad(CAST(amount * 4 DIV 5 % 1000 AS STRING), 3, '0'))
            ELSE CAST(amount * 4 DIV 5 AS STRING) END AS drawn_amount,
       CAST(NULL AS STRING) AS paid_interest
FROM facts
"""

# The footer of each file: a row of zeros that states the number of rows.
_FOOTER_SQL = """
SELECT source_file, year, 9000000000000000 AS pos, 'ZZZ' AS statement,
       CAST(NULL AS STRING) AS muni_id, CAST(NULL AS STRING) AS borrower_ico,
       CAST(NULL AS STRING) AS lender_ico, CAST(NULL AS STRING) AS lender_name,
       CAST(NULL AS STRING) AS purpose, CAST(NULL AS STRING) AS rate_text,
       CAST(NULL AS STRING) AS signed_on, CAST(NULL AS STRING) AS matures_on,
       '0' AS agreed_amount, '0' AS drawn_amount, CAST(count(*) AS STRING) AS paid_interest
FROM {rows} GROUP BY source_file, year
"""


def derive_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data rows and footers of four yearly files, all columns as filed."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    tasks = max(spark.sparkContext.defaultParallelism, -(-orders.count() // ORDERS_PER_TASK))
    if orders.rdd.getNumPartitions() < tasks:
        # A file of any size is a few splits; the rows derived from it are many
        # more. Dealt out by hash, which sorts nothing first.
        key = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
        orders = orders.select(*key, "o_orderstatus", "o_orderpriority").repartition(tasks, *key)
    rows = spark.sql(_SPARK_SQL, orders=orders)
    return rows.unionByName(spark.sql(_FOOTER_SQL, rows=rows))


# The same panel for the comparison engine.
PANEL_SQL = """
base_loans AS (
  SELECT o_orderkey AS k, o_custkey AS c,
         CAST(floor(o_totalprice / 25000) * 25000 AS BIGINT) AS base,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         o_orderstatus AS st, o_orderpriority AS pr, y.year
  FROM orders CROSS JOIN (VALUES (2021), (2022), (2023), (2024)) AS y(year)
), reported AS (
  SELECT * FROM base_loans
  WHERE NOT (st = 'F' AND pr = '5-LOW' AND year > 2022)
    AND NOT (st = 'F' AND pr = '4-NOT SPECIFIED' AND year > 2021)
    AND NOT (st = 'P' AND pr = '1-URGENT' AND year = 2022)
    AND NOT (st = 'P' AND pr = '2-HIGH' AND year IN (2022, 2023))
    AND NOT (st = 'O' AND pr = '2-HIGH' AND year < 2023)
), copied AS (
  SELECT *, 0 AS copy FROM reported
  UNION ALL
  SELECT *, 1 AS copy FROM reported WHERE k % 61 = 0 AND year = 2021 + (k // 61) % 4
), facts AS (
  SELECT *,
         (c + k % 3) % 120 AS bank,
         CAST(45000000 + ((c + k % 3) % 120) * 1001 AS VARCHAR) AS bank_ico,
         base + CASE WHEN k % 13 = 0 AND year >= 2023 THEN 50000 ELSE 0 END
              + CASE WHEN k % 9 = 0 AND year = 2022 THEN 10 ELSE 0 END AS amount,
         'Výstavba č. ' || (k % 17) AS use_text,
         month + to_months(CAST((22 + k % 9) * 12 AS INTEGER))
               + to_days(CASE WHEN k % 7 = 0 AND year >= 2022 THEN 400 ELSE 0 END
                       - CASE WHEN k % 14 = 0 AND year >= 2023 THEN 500 ELSE 0 END
                       + CASE WHEN k % 41 = 0 AND year >= 2022 THEN 10 ELSE 0 END) AS maturity
  FROM copied
), data_rows AS (
  SELECT 'loans_' || year || '012.tsv' AS source_file, year, k * 2 + copy AS pos,
         '80' AS statement,
         CAST(1000000000 + c AS VARCHAR) AS muni_id,
         CAST(200000 + c AS VARCHAR) AS borrower_ico,
         CASE WHEN k % 97 = 0 THEN '0' WHEN k % 101 = 0 THEN NULL
              WHEN k % 89 = 0 THEN substr(bank_ico, 1, 7)
              WHEN k % 83 = 0 AND year >= 2023 THEN bank_ico || '.0' ELSE bank_ico END AS lender_ico,
         CASE WHEN k % 53 = 0 THEN NULL WHEN k % 31 = 0 THEN 'Banka ' || bank || ', a.s.'
              ELSE 'Banka ' || bank END AS lender_name,
         CASE WHEN k % 47 = 0 THEN NULL WHEN copy = 1 AND k % 2 = 0 THEN 'rekonstrukce'
              WHEN k % 3 = 0 AND year >= 2023 THEN upper(use_text) || ' ' ELSE use_text END AS purpose,
         CASE WHEN year = 2021 THEN NULL WHEN k % 8 = 0 THEN '1,32' WHEN k % 8 = 1 THEN '2.46%'
              WHEN k % 8 = 2 THEN '4,20% p.a.' WHEN k % 8 = 3 THEN 'bezúročná'
              WHEN k % 8 = 4 THEN '6M PRIBOR + 0,45%p.a.' WHEN k % 8 = 5 THEN NULL
              WHEN k % 8 = 6 THEN (year - 2020) || ',5' WHEN year = 2022 THEN '0,00' ELSE '0' END AS rate_text,
         CASE WHEN k % 131 = 0 THEN 'neznámé'
              WHEN k % 71 = 0 AND year = 2023 THEN strftime(month, '%Y%m') || '11'
              ELSE strftime(month, '%Y%m%d') END AS signed_on,
         strftime(maturity, '%Y%m%d') AS matures_on,
         CASE WHEN k % 211 = 0 THEN 'neuvedeno' WHEN k % 5 = 0 THEN amount || ',50'
              WHEN k % 11 = 0 AND amount >= 1000 THEN (amount // 1000) || ' ' || lpad(CAST(amount % 1000 AS VARCHAR), 3, '0')
              ELSE CAST(amount AS VARCHAR) END AS agreed_amount,
         CASE WHEN k % 43 = 0 THEN NULL
              WHEN k % 11 = 0 AND amount * 4 // 5 >= 1000
                THEN (amount * 4 // 5 // 1000) || ' ' || lpad(CAST(amount * 4 // 5 % 1000 AS VARCHAR), 3, '0')
              ELSE CAST(amount * 4 // 5 AS VARCHAR) END AS drawn_amount,
         CAST(NULL AS VARCHAR) AS paid_interest
  FROM facts
), panel AS (
  SELECT * FROM data_rows
  UNION ALL
  SELECT source_file, year, 9000000000000000, 'ZZZ', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
         '0', '0', CAST(count(*) AS VARCHAR)
  FROM data_rows GROUP BY source_file, year
)"""
