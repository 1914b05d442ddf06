"""Dirty customer and subscription tables derived from the TPC-H-like parquet tables.

The two texts run unchanged in Spark SQL and in DuckDB. The ``k % ...`` terms inject dirt
into columns (padding, typos, bad and far dates, empty fields, duplicates); no row of the source
is left out, and every rule has rows that break it. A customer without orders gets a default day.
A third of all subscriptions belong to one customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BRONZE_CUSTOMERS = """
WITH fo AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS d0 FROM {orders} GROUP BY o_custkey),
base AS (SELECT c_custkey AS k, coalesce(d0, CAST('1995-06-15' AS DATE)) AS d0, n_name AS country,
           CASE WHEN c_custkey % 50 = 0 THEN 1 ELSE 0 END AS doubled
         FROM {customer} LEFT JOIN fo ON o_custkey = c_custkey LEFT JOIN {nation} ON n_nationkey = c_nationkey),
copies AS (SELECT 0 AS doubled, 0 AS copy UNION ALL SELECT 1, 0 UNION ALL SELECT 1, 1)
SELECT k + CAST(copy AS BIGINT) * 1000000000 AS row_id,
  CASE WHEN copy = 0 AND k % 71 = 9 THEN ' ' WHEN copy = 0 AND k % 61 = 8 THEN concat('\t\u2028C', CAST(k AS STRING), '\r\n')
       WHEN copy = 0 AND k % 13 = 0 THEN concat('  C', CAST(k AS STRING), ' ') ELSE concat('C', CAST(k AS STRING)) END AS customer_id,
  CASE WHEN copy = 1 THEN CAST(d0 + 1 AS STRING) WHEN k % 97 = 5 THEN '2024-13-05' WHEN k % 89 = 7 THEN ''
       WHEN k % 41 = 3 THEN CAST(d0 + 40 AS STRING) ELSE CAST(d0 AS STRING) END AS signup_date,
  CASE WHEN copy = 1 THEN 'DUPLICATE' WHEN k % 29 = 0 THEN NULL WHEN k % 7 = 0 THEN concat(' ', lower(country)) ELSE country END AS country
FROM base JOIN copies ON copies.doubled = base.doubled
"""

BRONZE_SUBSCRIPTIONS = """
WITH o AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 1 THEN 1 ELSE o_custkey END AS c, o_orderstatus AS st, o_orderpriority AS pr, CAST(o_orderdate AS DATE) AS d FROM {orders})
SELECT k AS row_id,
  CASE WHEN k % 211 = 0 THEN concat('X', CAST(c AS STRING)) WHEN k % 223 = 0 THEN '' WHEN k % 23 = 0 THEN concat('\t\u2028C', CAST(c AS STRING), '\r\n') WHEN k % 17 = 0 THEN concat(' C', CAST(c AS STRING), ' ')
       ELSE concat('C', CAST(c AS STRING)) END AS customer_id,
  CASE WHEN k % 307 = 0 THEN 'not-a-date' WHEN k % 199 = 0 THEN '' WHEN k % 241 = 0 THEN '0001-01-01' WHEN k % 19 = 0 THEN concat(' ', CAST(d AS STRING), ' ') ELSE CAST(d AS STRING) END AS start_date,
  CASE WHEN k % 103 = 0 THEN '2024-02-30' WHEN k % 149 = 0 THEN '9999-12-31' WHEN st = 'O' AND k % 2 = 0 THEN NULL WHEN st = 'O' THEN ' '
       WHEN k % 109 = 0 THEN CAST(d - 10 AS STRING) ELSE CAST(d + CAST(k % 120 AS INT) AS STRING) END AS end_date,
  CASE WHEN k % 97 = 0 THEN 'baisc' WHEN pr = '1-URGENT' THEN 'enterprise' WHEN pr = '2-HIGH' THEN ' pro ' ELSE 'basic' END AS plan,
  CASE WHEN k % 101 = 0 THEN 'thirty' WHEN k % 113 = 0 THEN 'N/A' WHEN k % 127 = 0 THEN '-5' WHEN k % 131 = 0 THEN '500' WHEN k % 137 = 0 THEN '0' WHEN k % 1499 = 0 THEN '1e13'
       ELSE concat(CAST(10 + (k * 7) % 60 AS STRING), CASE WHEN k % 3 = 0 THEN '.50' ELSE '' END) END AS monthly_price
FROM o
"""


# Given schemas spare a footer scan per read.
SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: _read(spark, sf_dir, name) for name in ("orders", "customer", "nation")}
    return spark.sql(BRONZE_CUSTOMERS, **tables)


def bronze_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BRONZE_SUBSCRIPTIONS, orders=_read(spark, sf_dir, "orders"))
