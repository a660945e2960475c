"""Recomputation of hidden cells, audits of published tables, fluctuation of rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regisight.catalog import registered, regional, snapshot
from regisight.operators import disclosure as D
from regisight.operators import dynamics as Y
from regisight.session import materialise

# Cells with a small part of their parent are hidden, without secondary suppression, so that some can be
# recomputed: one report per section, state = sum of regions, region = sum of its districts.
SQL_SCREEN = regional.SQL_CELLS + """,
v AS (SELECT c.section AS report_id, c.level || ':' || c.territory AS var, c.level = 'CR' OR 100 * c.n >= 15 * p.n AS pub
  FROM cells c LEFT JOIN cells p ON p.section = c.section AND p.territory = c.parent AND p.level <> 'OKRES'),
rel AS (SELECT section AS report_id, parent AS rel_id, level || ':' || territory AS var FROM cells WHERE level <> 'CR'
  UNION ALL SELECT DISTINCT section, parent, CASE WHEN level = 'KRAJ' THEN 'CR:CZ' ELSE 'KRAJ:' || parent END FROM cells WHERE level <> 'CR'),
k0 AS (SELECT report_id, var FROM v WHERE pub),
d1 AS (SELECT DISTINCT r.report_id, min(r.var) AS var FROM rel r LEFT JOIN k0 USING (report_id, var) WHERE k0.var IS NULL GROUP BY r.report_id, r.rel_id HAVING count(*) = 1),
k1 AS (SELECT * FROM k0 UNION SELECT * FROM d1),
d2 AS (SELECT DISTINCT r.report_id, min(r.var) AS var FROM rel r LEFT JOIN k1 USING (report_id, var) WHERE k1.var IS NULL GROUP BY r.report_id, r.rel_id HAVING count(*) = 1),
k2 AS (SELECT * FROM k1 UNION SELECT * FROM d2),
d3 AS (SELECT DISTINCT r.report_id, min(r.var) AS var FROM rel r LEFT JOIN k2 USING (report_id, var) WHERE k2.var IS NULL GROUP BY r.report_id, r.rel_id HAVING count(*) = 1)
SELECT report_id, var FROM d1 UNION SELECT report_id, var FROM d2 UNION SELECT report_id, var FROM d3"""


def cells_and_relations(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    base = materialise(regional.indicator_cells(spark, sf).select("section", "level", "territory", "parent", "n"), "cells")
    c = F.col
    var = F.concat(c("level"), F.lit(":"), c("territory"))
    above = base.filter(c("level") != "OKRES").select("section", c("territory").alias("parent"), c("n").alias("n_parent"))
    shown = (c("level") == "CR") | F.coalesce(100 * c("n") >= 15 * c("n_parent"), F.lit(False))
    cells = base.join(above, ["section", "parent"], "left").select(
        c("section").alias("report_id"), var.alias("var"), c("n").alias("value"), shown.alias("published"), F.lit(True).alias("protect"))
    parts = base.filter(c("level") != "CR").select(
        c("section").alias("report_id"), var.alias("part"),
        F.when(c("level") == "KRAJ", F.lit("CR:CZ")).otherwise(F.concat(F.lit("KRAJ:"), c("parent"))).alias("whole"))
    return cells, D.sum_relations(parts, [], "whole", "part")


@registered(SQL_SCREEN)
def recompute_screen(spark: SparkSession, sf: str) -> DataFrame:
    cells, relations = cells_and_relations(spark, sf)
    return D.derivable_by_substitution(cells, relations)


@registered(SQL_SCREEN)
def recompute_exact(spark: SparkSession, sf: str) -> DataFrame:
    """In a tree of sums exact elimination finds just what substitution finds."""
    cells, relations = cells_and_relations(spark, sf)
    return D.derivable_exactly(cells, relations).select("report_id", "var")


# Two reports on the same numbers: one shows large parts of their parent, the other one the places whose count is divisible
# by three; what one hides leaks where the other shows it, or where both together leave one unknown in a sum.
SQL_JOINT = SQL_SCREEN[: SQL_SCREEN.index("k0 AS")] + """b AS (SELECT section AS report_id, level || ':' || territory AS var FROM cells WHERE n % 3 = 0),
k0 AS (SELECT report_id, var FROM v WHERE pub UNION SELECT * FROM b),""" + SQL_SCREEN[SQL_SCREEN.index("\nd1 AS"): SQL_SCREEN.rindex("SELECT report_id, var FROM d1")] + """,
dd AS (SELECT * FROM d1 UNION SELECT * FROM d2 UNION SELECT * FROM d3),
hid AS (SELECT 'large ' || report_id AS report, report_id, var FROM v WHERE NOT pub
  UNION ALL SELECT 'thirds ' || report_id, report_id, var FROM v WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.report_id = v.report_id AND b.var = v.var))
SELECT report AS report_id, var, 'published elsewhere' AS leak FROM hid JOIN k0 USING (report_id, var)
UNION ALL SELECT report, var, 'derivable' FROM hid JOIN dd USING (report_id, var)"""


@registered(SQL_JOINT)
def report_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Leaks between reports that no single one of them shows."""
    c = F.col
    cells, relations = cells_and_relations(spark, sf)
    as_report = lambda kind: F.concat(F.lit(kind), c("report_id"))
    thirds = cells.withColumn("published", c("value") % 3 == 0)
    two = [df.withColumn("report_id", as_report(kind)) for kind, df in (("large ", cells), ("thirds ", thirds))]
    same = cells.select(F.explode(F.array(as_report("large "), as_report("thirds "))).alias("report_id"), "var", F.concat_ws("|", "report_id", "var").alias("name"))
    both = two[0].unionByName(two[1])
    return D.derivable_jointly(both, relations.withColumn("report_id", as_report("large ")), same)


# Suppressed districts of each region, checked like a finished report; two faults are injected on purpose.
SQL_AUDIT = regional.SQL_SUPPRESS + """,
st AS (SELECT *, CASE WHEN n <= 0 THEN 'zero' WHEN total < 10 THEN 'hidden' WHEN n < 10 THEN 'other'
       WHEN small > 0 AND small < 10 AND rn = 1 THEN 'other' ELSE 'published' END AS status FROM ord)
SELECT section || '/' || parent AS report_id, 'T04/' || territory || '/pocet' AS place, 'published count below the threshold' AS violation FROM st WHERE territory = 'N07' AND n < 10
UNION ALL SELECT section || '/' || parent, 'T04/' || territory || '/pocet', 'count differs from its variable' FROM st WHERE territory = 'N07' AND status <> 'published'
UNION ALL SELECT section || '/' || parent, 'T04/' || territory || '/podil', 'derived value over a hidden count' FROM st WHERE territory = 'N11' AND status <> 'published'
UNION ALL SELECT section || '/' || parent, 'other', '''other'' has a single member' FROM st WHERE status = 'other' GROUP BY 1 HAVING count(*) < 2
UNION ALL SELECT section || '/' || parent, 'other', '''other'' below the threshold' FROM st WHERE status = 'other' GROUP BY 1 HAVING sum(n) < 10"""


@registered(SQL_AUDIT)
def threshold_audit(spark: SparkSession, sf: str) -> DataFrame:
    districts = materialise(regional.section_cells(spark, sf), "cube").filter(F.col("level") == "OKRES")
    safe = D.suppress(districts, ["section", "parent"], "territory", "n").withColumn("report_id", F.concat_ws("/", "section", "parent"))
    safe = materialise(safe, "safe")
    c = F.col
    public = c("status") == D.PUBLISHED
    row = lambda col, indicator, value: F.struct(
        F.lit(col).alias("col"), F.lit(indicator).alias("indicator"), value.cast("double").alias("value"))
    shown = safe.select(
        "report_id", F.lit("T04").alias("tbl"), c("territory").alias("row"), c("territory").alias("base_var"),
        F.inline(F.array(row("pocet", "REG_POCET", F.when(public | (c("territory") == "N07"), c("n"))),
                         row("podil", "REG_PODIL", F.when(public | (c("territory") == "N11"), c("n") * 2)))))
    other = safe.filter(c("status") == D.OTHER).groupBy("report_id").agg(
        F.sum("n").alias("value"), F.count(F.lit(1)).alias("members"))
    cells = safe.select("report_id", c("territory").alias("var"), c("n").cast("double").alias("value"), public.alias("published"),
                        F.lit(True).alias("protect")).unionByName(
        other.select("report_id", F.lit("other").alias("var"), c("value").cast("double").alias("value"), F.lit(True).alias("published"),
                     F.lit(True).alias("protect")))
    catalogue = spark.range(1).select(F.inline(F.array(
        F.struct(F.lit("REG_POCET").alias("indicator"), F.lit("pocet").alias("kind")),
        F.struct(F.lit("REG_PODIL").alias("indicator"), F.lit("podil").alias("kind")))))
    others = other.select("report_id", F.lit("other").alias("var"), "members")
    return D.threshold_audit(shown, cells, catalogue, others)


@registered(regional.SQL_SUPPRESS + """, st AS (SELECT *, CASE WHEN n <= 0 THEN 'zero' WHEN total < 10 THEN 'hidden' WHEN n < 10 THEN 'other'
       WHEN small > 0 AND small < 10 AND rn = 1 THEN 'other' ELSE 'published' END AS status FROM ord),
g AS (SELECT section, parent, CASE WHEN status = 'published' THEN territory ELSE '(other)' END AS territory, CAST(sum(n) AS BIGINT) AS n, count(*) AS members
      FROM st WHERE status IN ('published', 'other') GROUP BY 1, 2, 3)
SELECT section, parent, territory, n, members, round(100.0 * n / sum(n) OVER (PARTITION BY section, parent), 1) AS share FROM g
QUALIFY count(*) FILTER (WHERE territory <> '(other)') OVER (PARTITION BY section, parent) > 0""")
def published_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    districts = materialise(regional.section_cells(spark, sf), "cube").filter(F.col("level") == "OKRES")
    safe = materialise(D.suppress(districts, ["section", "parent"], "territory", "n"), "safe")
    return D.published_breakdown(safe, ["section", "parent"], "territory", "n")


@registered(snapshot.SQL_FLOW + """,
e AS (SELECT f.section, f.level, f.territory, f.year, f.closed, round(f.stock * (CAST(s.closed AS DOUBLE)) / s.stock, 6) AS expected
  FROM flow f JOIN flow s ON s.section = f.section AND s.year = f.year AND s.level = 'CR' WHERE f.level <> 'CR' AND f.stock > 0 AND s.stock > 0),
l AS (SELECT DISTINCT expected FROM e WHERE expected > 0),
p AS (SELECT expected, k, sum(exp(k * ln(expected) - expected - lgamma(k + 1))) OVER (PARTITION BY expected ORDER BY k) AS cdf
  FROM l, unnest(generate_series(0, CAST(floor(expected + 12 * sqrt(expected) + 30) AS BIGINT))) AS u(k)),
q AS (SELECT expected, min(k) FILTER (WHERE cdf >= 0.025) AS low95, min(k) FILTER (WHERE cdf >= 0.975) AS high95,
  min(k) FILTER (WHERE cdf >= 0.0005) AS low999, min(k) FILTER (WHERE cdf >= 0.9995) AS high999 FROM p GROUP BY 1)
SELECT e.*, low95, high95, low999, high999, NOT (closed BETWEEN low999 AND high999) AS beyond FROM e JOIN q USING (expected)""")
def rate_fluctuation(spark: SparkSession, sf: str) -> DataFrame:
    return Y.fluctuation(snapshot.flows(spark, sf), ["section"])
