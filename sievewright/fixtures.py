"""Dirty sales and financials views over the given tables, shared by tests, queries and SQL checks.

Both statements run unchanged in Spark SQL; for an ANSI engine write double quotes for back-ticks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SALES_RAW_SQL = """
SELECT
  CASE WHEN k = 18 THEN cast(o_orderkey - 1 AS string) WHEN k = 19 THEN concat('x', cast(o_orderkey AS string))
       WHEN k IN (20, 29) THEN NULL
       WHEN k = 27 THEN cast(o_orderkey - 21 AS string) WHEN k = 28 THEN cast(o_orderkey - 15 AS string) ELSE cast(o_orderkey AS string) END AS Order_ID,
  CASE WHEN k = 1 THEN '' WHEN k = 10 THEN concat('  customer   ', cast(o_custkey AS string)) WHEN k = 11 THEN concat('José ', cast(o_custkey AS string))
       WHEN k = 12 THEN concat('Cust\u200bomer ', cast(o_custkey AS string)) WHEN k = 13 THEN concat('A & B ', cast(o_custkey AS string))
       WHEN k = 22 THEN concat(cast(o_custkey AS string), ' Inc.') ELSE concat('Customer ', cast(o_custkey AS string)) END AS Customer_Name,
  CASE WHEN k = 2 THEN 'N/A' WHEN k = 15 THEN 'Nrth' WHEN k = 16 THEN concat(' ', lower(reg), ' ') WHEN k = 21 THEN 'null'
       WHEN k = 23 THEN CASE WHEN reg = 'North' THEN 'South' ELSE 'North' END ELSE reg END AS Region,
  CASE WHEN k = 7 THEN concat(dd, '-', mm, '-', yy) WHEN k = 8 THEN concat(yy, '/', mm, '/', dd) WHEN k = 9 THEN 'March'
       WHEN k = 24 THEN concat(yy, mm, dd) WHEN k = 25 THEN concat(yy, '-02-30') WHEN k = 26 THEN concat(mm, '/', dd, '/', yy)
       ELSE concat(yy, '-', mm, '-', dd) END AS Order_Date,
  CASE WHEN k = 14 THEN '12345' ELSE p_name END AS Product,
  CASE WHEN k = 3 THEN '-3' WHEN k = 4 THEN '0' WHEN k IN (6, 29) THEN 'twenty one' ELSE cast(qty AS string) END AS Quantity,
  CASE WHEN k = 5 THEN '$1,200' ELSE cast(price AS string) END AS Unit_Price,
  cast(qty * price AS string) AS Total_Amount,
  CASE WHEN k = 17 THEN 'Crad' WHEN o_orderkey % 3 = 0 THEN 'Cash' WHEN o_orderkey % 3 = 1 THEN 'Card' ELSE 'Online' END AS Payment_Method
FROM (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderkey % 97 AS k, p.p_name, l.qty,
    cast(floor(p.p_retailprice) AS bigint) AS price,
    cast(year(o.o_orderdate) AS string) AS yy,
    lpad(cast(month(o.o_orderdate) AS string), 2, '0') AS mm,
    lpad(cast(day(o.o_orderdate) AS string), 2, '0') AS dd,
    CASE o.o_custkey % 5 WHEN 0 THEN 'North' WHEN 1 THEN 'South' WHEN 2 THEN 'East' WHEN 3 THEN 'West' ELSE 'Central' END AS reg
  FROM orders o
  JOIN (SELECT l_orderkey, min(l_partkey) AS pk, cast(floor(max(l_quantity)) AS bigint) AS qty FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
  JOIN part p ON p.p_partkey = l.pk
) b
"""

FINANCIALS_RAW_SQL = """
SELECT
  cast(o_orderkey AS string) AS `Row ID`,
  CASE WHEN k = 1 THEN '  small   business ' WHEN k = 2 THEN 'null' WHEN k = 3 THEN 'X' ELSE c_mktsegment END AS `Segment`,
  CASE WHEN k = 4 THEN 'Canada' WHEN k = 5 THEN 'Côte' ELSE concat('Country ', cast(c_nationkey AS string)) END AS `Country`,
  CASE WHEN k = 6 THEN '00045' WHEN k = 7 THEN 'o''neil mary-jane' ELSE p_name END AS `Product`,
  CASE WHEN disc < 4 THEN 'Low' WHEN disc < 8 THEN 'Medium' ELSE 'High' END AS `Discount Band`,
  CASE WHEN k = 8 THEN 'twenty one' WHEN k = 9 THEN 'one hundred and five' WHEN k = 10 THEN '-5' ELSE cast(qty AS string) END AS `Units Sold`,
  cast(price AS string) AS `Manufacturing Price`,
  CASE WHEN k = 11 THEN '$1,200' ELSE cast(price + 20 AS string) END AS `Sale Price`,
  cast(qty * (price + 20) AS string) AS `Gross Sales`,
  cast(disc AS string) AS `Discounts`,
  cast(qty * (price + 20) - disc AS string) AS `Sales`,
  cast(qty * price AS string) AS `COGS`,
  CASE WHEN k = 12 THEN 'abc' WHEN k = 13 THEN '0' ELSE cast(qty * 20 - disc AS string) END AS `Profit`,
  CASE WHEN k = 14 THEN 'next week' WHEN k = 15 THEN concat(yy, '.', mm, '.', dd) WHEN k = 16 THEN concat(mm, '/', dd, '/', yy)
       WHEN k = 17 THEN concat(dd, '-', mm, '-', yy) ELSE concat(yy, '-', mm, '-', dd) END AS `Date`,
  cast(cast(mm AS int) AS string) AS `Month Number`,
  concat('Month ', mm) AS `Month Name`,
  yy AS `Year`
FROM (
  SELECT o.o_orderkey, o.o_orderkey % 89 AS k, c.c_mktsegment, c.c_nationkey, p.p_name, l.qty, l.disc,
    cast(floor(p.p_retailprice) AS bigint) AS price,
    cast(year(o.o_orderdate) AS string) AS yy,
    lpad(cast(month(o.o_orderdate) AS string), 2, '0') AS mm,
    lpad(cast(day(o.o_orderdate) AS string), 2, '0') AS dd
  FROM orders o
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN (SELECT l_orderkey, min(l_partkey) AS pk, cast(floor(max(l_quantity)) AS bigint) AS qty, cast(floor(max(l_discount) * 100 + 0.5) AS bigint) AS disc FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
  JOIN part p ON p.p_partkey = l.pk
) b
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, sql: str, names) -> DataFrame:
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(sql)


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, SALES_RAW_SQL, ("orders", "lineitem", "part"))


def financials_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, FINANCIALS_RAW_SQL, ("orders", "customer", "lineitem", "part"))
