"""Counts, indicators and suppression over the subject snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regisight.catalog import registered
from regisight.operators import disclosure as D
from regisight.operators import indicators as I
from regisight.operators import territory as T
from regisight.plans.proxy import SQL_SUBJECTS, SQL_TERRITORY, population, subjects, territories
from regisight.session import materialise

BY = ["section"]


def living(spark: SparkSession, sf: str) -> DataFrame:
    return subjects(spark, sf).filter(F.col("closed").isNull())


def section_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Living subjects per section and territory, missing cells as 0."""
    counts = T.count_by_territory(living(spark, sf), BY)
    return T.fill_zero(counts, T.places(territories(spark, sf)), BY)


def population_cells(spark: SparkSession, sf: str) -> DataFrame:
    d = territories(spark, sf).select("district", "region").join(population(spark, sf), "district", "left")
    return T.roll_up(d, [], ["inhabitants"])


def indicator_cells(spark: SparkSession, sf: str) -> DataFrame:
    # the cube is stored once; totals and indicators read it, not the subjects
    cells = materialise(section_cells(spark, sf), "cube")
    everything = cells.groupBy("level", "territory").agg(F.sum("n").alias("n_all"))
    return I.basic_indicators(cells, everything, population_cells(spark, sf), BY)


SQL_CELLS = f"""
WITH {SQL_SUBJECTS}, {SQL_TERRITORY},
dcount AS (SELECT section, district, count(*) AS n FROM subj WHERE closed IS NULL GROUP BY 1, 2),
tcount AS (SELECT section, level, territory, CAST(sum(n) AS BIGINT) AS n FROM dcount JOIN bridge USING (district) GROUP BY 1, 2, 3),
sections AS (SELECT DISTINCT section FROM tcount),
cells AS (
  SELECT s.section, p.level, p.territory, p.parent, coalesce(t.n, 0) AS n
  FROM sections s CROSS JOIN places p LEFT JOIN tcount t USING (section, level, territory)),
alls AS (SELECT level, territory, CAST(sum(n) AS BIGINT) AS n_all FROM cells GROUP BY 1, 2),
state AS (SELECT section, n AS n_state FROM cells WHERE level = 'CR'),
wide AS (
  SELECT c.*, a.n_all, pop.inhabitants, s.n_state, (SELECT n_all FROM alls WHERE level = 'CR') AS n_all_state
  FROM cells c LEFT JOIN alls a USING (level, territory) LEFT JOIN pop USING (level, territory) LEFT JOIN state s USING (section)),
ind AS (
  SELECT section, level, territory, parent, n, n_all, inhabitants,
    round(100.0 * n / nullif(n_state, 0), 2) AS share_of_state,
    round(100.0 * n / nullif(n_all, 0), 2) AS share_of_territory,
    round((n / nullif(n_all, 0)) / nullif(n_state / nullif(n_all_state, 0), 0), 2) AS lq,
    round(1000.0 * n / nullif(inhabitants, 0), 2) AS density,
    CASE WHEN level <> 'CR' THEN rank() OVER (PARTITION BY section, level, parent ORDER BY n DESC) END AS rank_count,
    CASE WHEN level <> 'CR' AND inhabitants > 0 THEN
      rank() OVER (PARTITION BY section, level, parent ORDER BY CAST(1000.0 * n / nullif(inhabitants, 0) AS DOUBLE) DESC NULLS LAST) END AS rank_density
  FROM wide)
"""


@registered(SQL_CELLS + "SELECT section, level, territory, n FROM cells")
def territory_counts(spark: SparkSession, sf: str) -> DataFrame:
    return section_cells(spark, sf).select("section", "level", "territory", "n")


@registered(SQL_CELLS + "SELECT section, level, territory, n, share_of_state, share_of_territory, lq FROM ind")
def location_quotient(spark: SparkSession, sf: str) -> DataFrame:
    return indicator_cells(spark, sf).select(
        "section", "level", "territory", "n", "share_of_state", "share_of_territory", "lq"
    )


@registered(SQL_CELLS + "SELECT section, level, territory, inhabitants, density FROM ind")
def density(spark: SparkSession, sf: str) -> DataFrame:
    return indicator_cells(spark, sf).select("section", "level", "territory", "inhabitants", "density")


@registered(SQL_CELLS + """SELECT section, level, territory, CAST(rank_count AS INTEGER) AS rank_count,
CAST(rank_density AS INTEGER) AS rank_density FROM ind WHERE level <> 'CR'""")
def rank_territories(spark: SparkSession, sf: str) -> DataFrame:
    return indicator_cells(spark, sf).filter(F.col("level") != "CR").select(
        "section", "level", "territory", "rank_count", "rank_density"
    )


SQL_SUPPRESS = SQL_CELLS + """,
grp AS (SELECT section, parent, sum(CASE WHEN n > 0 THEN n ELSE 0 END) AS total,
               sum(CASE WHEN n > 0 AND n < 10 THEN n ELSE 0 END) AS small
        FROM cells WHERE level = 'OKRES' GROUP BY 1, 2),
ord AS (SELECT c.section, c.parent, c.territory, c.n, g.total, g.small,
               row_number() OVER (PARTITION BY c.section, c.parent ORDER BY CASE WHEN c.n >= 10 THEN 0 ELSE 1 END, c.n, c.territory) AS rn
        FROM cells c JOIN grp g USING (section, parent) WHERE c.level = 'OKRES')
"""


@registered(SQL_SUPPRESS + """
SELECT section, parent, territory, n,
  CASE WHEN n <= 0 THEN 'zero' WHEN total < 10 THEN 'hidden' WHEN n < 10 THEN 'other'
       WHEN small > 0 AND small < 10 AND rn = 1 THEN 'other' ELSE 'published' END AS status,
  (total >= 10 AND n >= 10 AND small > 0 AND small < 10 AND rn = 1) AS secondary
FROM ord""")
def suppress_cells(spark: SparkSession, sf: str) -> DataFrame:
    districts = materialise(section_cells(spark, sf), "cube").filter(F.col("level") == "OKRES")
    return D.suppress(districts, ["section", "parent"], "territory", "n").select(
        "section", "parent", "territory", "n", "status", "secondary"
    )


def published_table(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: indicators of every section in every district, small cells protected."""
    cells = materialise(indicator_cells(spark, sf), "indicators").filter(F.col("level") == "OKRES")
    safe = D.suppress(cells, ["section", "parent"], "territory", "n")
    shown = F.col("status") == D.PUBLISHED
    keep = ["n", "share_of_state", "share_of_territory", "lq", "density", "rank_count", "rank_density"]
    return safe.select("section", "parent", "territory", "status", *[F.when(shown, F.col(k)).alias(k) for k in keep])


@registered(SQL_SUPPRESS + """,
st AS (SELECT section, parent, territory,
  CASE WHEN n <= 0 THEN 'zero' WHEN total < 10 THEN 'hidden' WHEN n < 10 THEN 'other'
       WHEN small > 0 AND small < 10 AND rn = 1 THEN 'other' ELSE 'published' END AS status FROM ord)
SELECT st.section, st.parent, st.territory, status,
  CASE WHEN status = 'published' THEN n END AS n,
  CASE WHEN status = 'published' THEN share_of_state END AS share_of_state,
  CASE WHEN status = 'published' THEN share_of_territory END AS share_of_territory,
  CASE WHEN status = 'published' THEN lq END AS lq,
  CASE WHEN status = 'published' THEN density END AS density,
  CASE WHEN status = 'published' THEN CAST(rank_count AS INTEGER) END AS rank_count,
  CASE WHEN status = 'published' THEN CAST(rank_density AS INTEGER) END AS rank_density
FROM st JOIN ind USING (section, territory) WHERE ind.level = 'OKRES'""")
def published_districts(spark: SparkSession, sf: str) -> DataFrame:
    return published_table(spark, sf)
