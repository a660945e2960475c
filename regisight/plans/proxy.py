"""The register's concepts read from the given commercial tables.

subject = customer, district -> region = nation -> region, section = market segment,
founding / closing day = first / last order day, classification states = parts,
code history = order priorities, versions = event types of a user by day.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regisight.plans.sizing import small_side

SNAPSHOT = date(2001, 8, 1)      # day of the snapshot the subjects are read at
CLOSED_BEFORE = date(2001, 1, 1)  # a last order before this day closes the subject


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def subject_id(key: Column) -> Column:
    text = key.cast("string")
    return F.lpad(text, F.greatest(F.lit(8), F.length(text)), F.lit("0"))


def district_code(nation_key: Column) -> Column:
    return F.concat(F.lit("N"), F.lpad(nation_key.cast("string"), 2, "0"))


def region_code(region_key: Column) -> Column:
    return F.concat(F.lit("R"), region_key.cast("string"))


def territories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """District list with its region: code, name, region, region_name."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(small_side(r), n.n_regionkey == r.r_regionkey, "left").select(
        district_code(F.col("n_nationkey")).alias("district"),
        F.col("n_name").alias("district_name"),
        region_code(F.col("n_regionkey")).alias("region"),
        F.col("r_name").alias("region_name"),
        "n_nationkey",
    )


def form_code() -> Column:
    b = F.col("c_acctbal")
    return (
        F.when(b < 2500, "101").when(b < 3500, "105").when(b < 4000, "424")
        .when(b < 7500, "112").when(b < 9500, "121").otherwise("205")
    )


def size_code() -> Column:
    n = F.col("n_orders")
    return (
        F.when(n <= 3, "000").when(n <= 5, "110").when(n <= 7, "120").when(n <= 9, "130").when(n <= 11, "210")
        .when(n <= 13, "220").when(n <= 15, "240").when(n <= 18, "310").when(n > 18, "330")
    )


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per subject of the snapshot."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderstatus", "o_orderkey"
    )
    lives = orders.groupBy("o_custkey").agg(
        F.min("day").alias("founded"),
        F.max("day").alias("last_day"),
        F.count(F.lit(1)).alias("n_orders"),
        F.max_by("o_orderstatus", F.struct("day", "o_orderkey")).alias("last_status"),
    )
    places = territories(spark, sf_dir).select("n_nationkey", "district", "region")
    customers = table(spark, sf_dir, "customer").join(
        small_side(places), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    closed = F.when(F.col("last_day") < F.lit(CLOSED_BEFORE), F.col("last_day"))
    section = F.substring("c_mktsegment", 1, 1)
    band = F.floor(F.col("c_acctbal") / 2500).cast("int") + 1
    division = F.concat(
        F.when(section == "A", "1").when(section == "B", "2").when(section == "F", "3")
        .when(section == "H", "4").otherwise("5"),
        band.cast("string"),
    )
    return customers.join(lives, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        subject_id(F.col("c_custkey")).alias("ico"),
        F.col("c_name").alias("name"),
        "district", "region",
        section.alias("section"),
        division.alias("division"),
        form_code().alias("forma"),
        size_code().alias("katpo"),
        "founded",
        closed.alias("closed"),
        F.when(closed.isNotNull(), F.when(F.col("last_status") == "F", "04").when(F.col("last_status") == "O", "01")
               .otherwise("02")).alias("zpzan"),
        F.lit(SNAPSHOT).alias("snapshot"),
    )


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inhabitants of each district: 40 per supplier seated there."""
    s = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg((F.count(F.lit(1)) * 40).alias("inhabitants"))
    return s.select(district_code(F.col("s_nationkey")).alias("district"), "inhabitants")


# SQL text of the same concepts, for the independent check -----------------------------------------
SQL_SUBJECTS = """
last_order AS (
  SELECT o_custkey, o_orderstatus AS last_status FROM (
    SELECT o_custkey, o_orderstatus,
           row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rn
    FROM orders) WHERE rn = 1),
lives AS (
  SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS founded, max(CAST(o_orderdate AS DATE)) AS last_day,
         count(*) AS n_orders
  FROM orders GROUP BY o_custkey),
subj AS (
  SELECT CASE WHEN length(CAST(c_custkey AS VARCHAR)) >= 8 THEN CAST(c_custkey AS VARCHAR)
              ELSE lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS ico,
         c_name AS name,
         'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS district,
         'R' || CAST(n_regionkey AS VARCHAR) AS region,
         substr(c_mktsegment, 1, 1) AS section,
         (CASE substr(c_mktsegment, 1, 1) WHEN 'A' THEN '1' WHEN 'B' THEN '2' WHEN 'F' THEN '3' WHEN 'H' THEN '4' ELSE '5' END)
           || CAST(CAST(floor(c_acctbal / 2500) AS INTEGER) + 1 AS VARCHAR) AS division,
         CASE WHEN c_acctbal < 2500 THEN '101' WHEN c_acctbal < 3500 THEN '105' WHEN c_acctbal < 4000 THEN '424'
              WHEN c_acctbal < 7500 THEN '112' WHEN c_acctbal < 9500 THEN '121' ELSE '205' END AS forma,
         CASE WHEN n_orders <= 3 THEN '000' WHEN n_orders <= 5 THEN '110' WHEN n_orders <= 7 THEN '120'
              WHEN n_orders <= 9 THEN '130' WHEN n_orders <= 11 THEN '210' WHEN n_orders <= 13 THEN '220'
              WHEN n_orders <= 15 THEN '240' WHEN n_orders <= 18 THEN '310' WHEN n_orders > 18 THEN '330' END AS katpo,
         founded,
         CASE WHEN last_day < DATE '2001-01-01' THEN last_day END AS closed,
         CASE WHEN last_day < DATE '2001-01-01' THEN
           CASE last_status WHEN 'F' THEN '04' WHEN 'O' THEN '01' ELSE '02' END END AS zpzan
  FROM customer
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN lives ON lives.o_custkey = c_custkey
  LEFT JOIN last_order ON last_order.o_custkey = c_custkey)
"""

SQL_TERRITORY = """
terr AS (
  SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS district, n_name AS district_name,
         'R' || CAST(n_regionkey AS VARCHAR) AS region, r_name AS region_name
  FROM nation LEFT JOIN region ON r_regionkey = n_regionkey),
bridge AS (
  SELECT district, 'CR' AS level, 'CZ' AS territory, CAST(NULL AS VARCHAR) AS parent FROM terr
  UNION ALL SELECT district, 'KRAJ', region, 'CZ' FROM terr
  UNION ALL SELECT district, 'OKRES', district, region FROM terr),
places AS (SELECT DISTINCT level, territory, parent FROM bridge),
popd AS (
  SELECT 'N' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS district, count(*) * 40 AS inhabitants
  FROM supplier GROUP BY 1),
pop AS (SELECT level, territory, CAST(sum(inhabitants) AS BIGINT) AS inhabitants FROM popd JOIN bridge USING (district) GROUP BY 1, 2)
"""
