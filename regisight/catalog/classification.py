"""Two code versions over parts: lists, crosswalk, matrix, derivation, interface."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regisight.catalog import registered
from regisight.functions import fixed as X
from regisight.operators import crosswalk as C
from regisight.operators import history as H
from regisight.operators import interface as N
from regisight.plans.proxy import subject_id, table
from regisight.session import materialise

SQL_PARTS = """
pt AS (SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS ico, CAST(substr(p_brand, 7) AS INTEGER) AS brand,
   substr(p_type, 1, 1) AS s08,
   CASE p_type WHEN 'MEDIUM' THEN '10' WHEN 'SMALL' THEN '20' WHEN 'STANDARD' THEN '21' WHEN 'ECONOMY' THEN '30' WHEN 'PROMO' THEN '40' ELSE '50' END AS d08,
   CAST(CAST(floor((p_size - 1) / 10) AS INTEGER) AS VARCHAR) AS band, p_type, p_size FROM part),
pc AS (SELECT *, d08 || band AS g08,
   CASE WHEN p_type = 'MEDIUM' THEN '61' WHEN p_type IN ('SMALL', 'STANDARD') THEN '62'
        WHEN p_type = 'ECONOMY' THEN CASE WHEN brand <= 23 THEN '63' ELSE '64' END
        WHEN p_type = 'PROMO' THEN CASE WHEN brand <= 12 THEN '65' ELSE '66' END
        ELSE CASE WHEN brand <= 13 THEN '67' ELSE '68' END END AS d25 FROM pt),
px AS (SELECT *, CASE d25 WHEN '61' THEN 'A' WHEN '62' THEN 'B' WHEN '63' THEN 'C' WHEN '64' THEN 'C' WHEN '65' THEN 'C' WHEN '66' THEN 'D' ELSE 'E' END AS s25,
   d25 || CASE WHEN brand <= 3 THEN '9' ELSE band END AS g25,
   CASE WHEN p_size < 50 THEN DATE '2010-01-01' + p_size END AS start08 FROM pc),
codes AS (SELECT *, CASE WHEN brand = 25 THEN s08 WHEN brand = 24 THEN d08 ELSE g08 END AS code08,
   CASE WHEN brand BETWEEN 20 AND 22 THEN NULL WHEN brand = 17 THEN d25 ELSE g25 END AS code25,
   CASE WHEN brand = 19 THEN DATE '2025-03-01' ELSE DATE '2025-01-01' END AS start25 FROM px),
l08 AS (SELECT DISTINCT s08 AS code, 1 AS level, CAST(NULL AS VARCHAR) AS parent FROM px UNION SELECT DISTINCT d08, 2, s08 FROM px
        UNION SELECT DISTINCT g08, 3, d08 FROM px),
l25 AS (SELECT DISTINCT s25 AS code, 1 AS level, CAST(NULL AS VARCHAR) AS parent FROM px UNION SELECT DISTINCT d25, 2, s25 FROM px
        UNION SELECT DISTINCT g25, 3, d25 FROM px),
c08 AS (SELECT code, level, parent, CASE level WHEN 1 THEN code WHEN 2 THEN parent ELSE (SELECT parent FROM l08 u WHERE u.code = l08.parent) END AS section,
        CASE level WHEN 2 THEN code WHEN 3 THEN parent END AS division, CASE level WHEN 3 THEN code END AS grp FROM l08),
c25 AS (SELECT code, level, parent, CASE level WHEN 1 THEN code WHEN 2 THEN parent ELSE (SELECT parent FROM l25 u WHERE u.code = l25.parent) END AS section,
        CASE level WHEN 2 THEN code WHEN 3 THEN parent END AS division, CASE level WHEN 3 THEN code END AS grp FROM l25),
pairs AS (SELECT DISTINCT 1 AS level, s08 AS code_2008, s25 AS code_2025 FROM px WHERE brand <= 19 UNION
          SELECT DISTINCT 2, d08, d25 FROM px WHERE brand <= 19 UNION SELECT DISTINCT 3, g08, g25 FROM px WHERE brand > 3 AND brand <= 19),
links AS (SELECT *, CASE WHEN t = 1 AND s = 1 THEN '1:1' WHEN s = 1 THEN '1:N' WHEN t = 1 THEN 'N:1' ELSE 'N:M' END AS link FROM (
   SELECT *, count(*) OVER (PARTITION BY level, code_2008) AS t, count(*) OVER (PARTITION BY level, code_2025) AS s FROM pairs)),
a08 AS (SELECT code, level, 1 AS tl, section AS anc FROM c08 UNION ALL SELECT code, level, 2, division FROM c08 WHERE level >= 2
        UNION ALL SELECT code, level, 3, grp FROM c08 WHERE level >= 3),
a25 AS (SELECT code, level, 1 AS tl, section AS anc FROM c25 UNION ALL SELECT code, level, 2, division FROM c25 WHERE level >= 2
        UNION ALL SELECT code, level, 3, grp FROM c25 WHERE level >= 3),
dual AS (SELECT code08, code25 FROM codes WHERE code25 IS NOT NULL AND start25 = DATE '2025-01-01'),
mx0 AS (SELECT x.anc AS code_2008, x.tl AS level_2008, y.tl AS level, y.anc AS code_2025, count(*) AS count
   FROM dual JOIN a08 x ON x.code = code08 JOIN a25 y ON y.code = code25 WHERE y.tl <= x.tl GROUP BY ALL),
mx AS (SELECT *, CAST(sum(count) OVER (PARTITION BY code_2008, level) AS BIGINT) AS base FROM mx0),
top AS (SELECT code_2008, level, code_2025 AS top, count AS top_count, base FROM (SELECT *, row_number() OVER (
   PARTITION BY code_2008, level ORDER BY count DESC, code_2025) AS rn FROM mx) WHERE rn = 1),
one AS (SELECT code_2008, min(code_2025) AS code_2025 FROM links GROUP BY 1 HAVING count(*) = 1 AND min(link) = '1:1'),
direct AS (SELECT one.code_2008, y.tl AS level, y.anc AS target FROM one JOIN a25 y ON y.code = one.code_2025),
cand AS (SELECT l.code_2008, y.tl AS level, list_sort(list(DISTINCT y.anc)) AS candidates FROM links l JOIN a25 y ON y.code = l.code_2025 GROUP BY 1, 2),
rule0 AS (SELECT x.code AS code_2008, x.tl AS level, coalesce(d1.target, d2.target) AS linked, candidates,
    CASE WHEN len(candidates) = 1 THEN candidates[1] END AS only1, top, top_count, coalesce(base, 0) AS base
  FROM a08 x LEFT JOIN direct d1 ON d1.code_2008 = x.code AND d1.level = x.tl
  LEFT JOIN direct d2 ON d2.code_2008 = x.anc AND d2.level = x.tl
  LEFT JOIN cand ON cand.code_2008 = x.code AND cand.level = x.tl LEFT JOIN top ON top.code_2008 = x.code AND top.level = x.tl),
rule1 AS (SELECT *, coalesce(linked, only1) AS proposed, coalesce(coalesce(linked, only1) IS NOT NULL AND base >= 20
    AND top <> coalesce(linked, only1) AND top_count / base >= 0.9, false) AS conflict FROM rule0),
rules AS (SELECT code_2008, level, CASE WHEN conflict THEN top WHEN proposed IS NOT NULL THEN proposed WHEN base >= 20 THEN top END AS code_2025,
    CASE WHEN conflict THEN round(top_count / base, 4) WHEN proposed IS NOT NULL THEN 1.0 WHEN base >= 20 THEN round(top_count / base, 4) END AS certainty,
    CASE WHEN conflict THEN 'empiricky_rozpor' WHEN linked IS NOT NULL THEN 'prevodnik_1:1' WHEN only1 IS NOT NULL THEN 'prevodnik_jediny_cil'
         WHEN base >= 20 THEN 'empiricky' ELSE 'nejednoznacne' END AS method, base, candidates,
    CASE WHEN conflict THEN proposed END AS crosswalk_target FROM rule1),
der AS (SELECT c.ico, r.code_2025 AS code, r.level, r.method AS detail, r.certainty, r.candidates, c.code08 AS derived_from, c.start08 AS start
   FROM codes c JOIN rules r ON r.code_2008 = c.code08
   WHERE NOT (c.code25 IS NOT NULL AND c.start25 = greatest(c.start08, DATE '2025-01-01')))
"""


def coded_parts(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    brand = F.substring("p_brand", 7, 10).cast("int")
    kind = F.col("p_type")
    d08 = (F.when(kind == "MEDIUM", "10").when(kind == "SMALL", "20").when(kind == "STANDARD", "21")
           .when(kind == "ECONOMY", "30").when(kind == "PROMO", "40").otherwise("50"))
    d25 = (
        F.when(kind == "MEDIUM", "61").when(kind.isin("SMALL", "STANDARD"), "62")
        .when(kind == "ECONOMY", F.when(brand <= 23, "63").otherwise("64"))
        .when(kind == "PROMO", F.when(brand <= 12, "65").otherwise("66"))
        .otherwise(F.when(brand <= 13, "67").otherwise("68"))
    )
    x = p.select(
        subject_id(F.col("p_partkey")).alias("ico"), brand.alias("brand"), F.substring("p_type", 1, 1).alias("s08"), d08.alias("d08"),
        d25.alias("d25"), F.floor((F.col("p_size") - 1) / 10).cast("string").alias("band"), "p_size",
    )
    c = F.col
    s25 = (F.when(c("d25") == "61", "A").when(c("d25") == "62", "B").when(c("d25").isin("63", "64", "65"), "C")
           .when(c("d25") == "66", "D").otherwise("E"))
    return x.select(
        "*", F.concat("d08", "band").alias("g08"), s25.alias("s25"),
        F.concat("d25", F.when(c("brand") <= 3, "9").otherwise(c("band"))).alias("g25"),
        F.when(c("p_size") < 50, F.date_add(F.lit(date(2010, 1, 1)), c("p_size"))).alias("start08"),
    ).select(
        "*",
        F.when(c("brand") == 25, c("s08")).when(c("brand") == 24, c("d08")).otherwise(c("g08")).alias("code08"),
        F.when(c("brand").between(20, 22), None).when(c("brand") == 17, c("d25")).otherwise(c("g25")).alias("code25"),
        F.when(c("brand") == 19, F.lit(date(2025, 3, 1))).otherwise(F.lit(date(2025, 1, 1))).alias("start25"),
    )


def seen_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct code combinations of the parts, stored: the lists below read this small table, not the parts."""
    return materialise(coded_parts(spark, sf).select("s08", "d08", "g08", "s25", "d25", "g25", "brand").distinct(), "codes")


def code_items(seen: DataFrame, version: str) -> DataFrame:
    """(code, level, parent) of one version."""
    s, d, g = (F.col(f"{k}{version}") for k in "sdg")
    rows = F.array(
        F.struct(s.alias("code"), F.lit(1).alias("level"), F.lit(None).cast("string").alias("parent")),
        F.struct(d.alias("code"), F.lit(2).alias("level"), s.alias("parent")),
        F.struct(g.alias("code"), F.lit(3).alias("level"), d.alias("parent")),
    )
    return seen.select(F.inline(rows)).distinct()


def code_list(seen: DataFrame, version: str) -> DataFrame:
    return C.hierarchy(code_items(seen, version).withColumn("pseudo", F.lit(False)))


def crosswalk_pairs(seen: DataFrame) -> DataFrame:
    def pair(level: int, old: str, new: str, keep: Column) -> Column:
        return F.when(keep, F.struct(F.lit(level).alias("level"), F.col(old).alias("code_2008"), F.col(new).alias("code_2025")))

    yes = F.lit(True)
    rows = F.array_compact(F.array(pair(1, "s08", "s25", yes), pair(2, "d08", "d25", yes), pair(3, "g08", "g25", F.col("brand") > 3)))
    return seen.filter(F.col("brand") <= 19).select(F.inline(rows)).distinct()


def official_history(spark: SparkSession, sf: str) -> DataFrame:
    p = coded_parts(spark, sf)
    null = lambda t: F.lit(None).cast(t)

    def state(version: int, code: str, start: str) -> Column:
        return F.struct(F.lit(version).alias("version"), F.col(code).alias("code"), F.col(start).alias("start"))

    rows = p.select("ico", F.inline(F.array(state(2008, "code08", "start08"), state(2025, "code25", "start25")))).filter(
        F.col("code").isNotNull())
    return rows.select(
        "ico", "version", "code", F.when(F.col("code").rlike("^[A-Z]$"), 1).otherwise(F.length("code")).alias("level"),
        F.lit(X.MAIN).alias("kind"), F.lit(X.OFFICIAL).alias("source"), F.lit("parts").alias("detail"),
        F.lit(1).cast("decimal(5,4)").alias("certainty"), null("string").alias("flag"), null("array<string>").alias("candidates"),
        null("string").alias("derived_from"), "start", null("date").alias("end"), null("string").alias("close_reason"),
        F.lit(1).alias("batch_id"),
    )


@dataclass
class Lists:
    """The stored tables of the classification: both code lists and the crosswalk."""

    old: DataFrame
    new: DataFrame
    links: DataFrame


def lists(spark: SparkSession, sf: str) -> Lists:
    seen = seen_codes(spark, sf)
    return Lists(
        materialise(code_list(seen, "08"), "codes-2008"), materialise(code_list(seen, "25"), "codes-2025"),
        materialise(C.link_types(crosswalk_pairs(seen)), "crosswalk"),
    )


def matrix(spark: SparkSession, sf: str, stored: Lists | None = None) -> DataFrame:
    k = stored or lists(spark, sf)
    return C.transition_matrix(official_history(spark, sf), k.old, k.new)


def rules(spark: SparkSession, sf: str, stored: Lists | None = None) -> DataFrame:
    k = stored or lists(spark, sf)
    return C.derivation_rules(k.old, k.new, k.links, materialise(matrix(spark, sf, k), "matrix"))


def derived(spark: SparkSession, sf: str, stored: Lists | None = None) -> DataFrame:
    return C.derived_codes(official_history(spark, sf), materialise(rules(spark, sf, stored), "rules"))


def interface(spark: SparkSession, sf: str) -> DataFrame:
    k = lists(spark, sf)
    history = official_history(spark, sf).select(*H.CODE_COLUMNS).unionByName(derived(spark, sf, k).select(*H.CODE_COLUMNS))
    return N.company_interface(history, k.old, k.new)


W = f"WITH {SQL_PARTS} "


@registered(W + """SELECT code, level, parent, section, division, grp, CAST(NULL AS VARCHAR) AS cls, false AS pseudo FROM c25
UNION ALL SELECT 'X', 1, NULL, 'X', NULL, NULL, NULL, true UNION ALL SELECT '04', 2, 'X', 'X', '04', NULL, NULL, true
UNION ALL SELECT 'Y', 1, NULL, 'Y', NULL, NULL, NULL, true UNION ALL SELECT '00', 2, 'Y', 'Y', '00', NULL, NULL, true""")
def hierarchy_closure(spark: SparkSession, sf: str) -> DataFrame:
    return C.hierarchy(C.with_pseudo_codes(code_items(seen_codes(spark, sf), "25")))


@registered(W + "SELECT level, code_2008, code_2025, link FROM links")
def link_types(spark: SparkSession, sf: str) -> DataFrame:
    return C.link_types(crosswalk_pairs(seen_codes(spark, sf)))


@registered(W + """SELECT DISTINCT 2008 AS version, code_2008 AS code, level FROM pairs WHERE code_2008 NOT IN (SELECT code FROM c08 WHERE section <> 'M')
UNION SELECT DISTINCT 2025, code_2025, level FROM pairs WHERE code_2025 NOT IN (SELECT code FROM c25 WHERE section <> 'D')""")
def crosswalk_integrity(spark: SparkSession, sf: str) -> DataFrame:
    """Lists with a missing section: the codes of that section must be reported."""
    seen = seen_codes(spark, sf)
    return C.unknown_codes(crosswalk_pairs(seen), code_list(seen, "08").filter("section <> 'M'"),
                           code_list(seen, "25").filter("section <> 'D'"))


@registered(W + "SELECT code_2008, level_2008, level, code_2025, count, base, round(count / base, 4) AS share FROM mx")
def transition_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return matrix(spark, sf)


@registered(W + """SELECT code_2008, level, code_2025, CAST(certainty AS DECIMAL(5,4)) AS certainty, method, base,
CASE WHEN method = 'nejednoznacne' THEN array_to_string(coalesce(candidates, []), ',') END AS candidates, crosswalk_target FROM rules""")
def derive_codes(spark: SparkSession, sf: str) -> DataFrame:
    return rules(spark, sf).withColumn("candidates", F.array_join("candidates", ","))


@registered(W + """SELECT ico, code, level, detail, CAST(certainty AS DECIMAL(5,4)) AS certainty, derived_from, start FROM der""")
def derived_history(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf).select("ico", "code", "level", "detail", "certainty", "derived_from", "start")


SQL_INTERFACE = SQL_PARTS + """,
dp AS (SELECT ico, derived_from, max(code) FILTER (WHERE level = 1) AS s, max(code) FILTER (WHERE level = 2) AS d, max(code) FILTER (WHERE level = 3) AS g,
   max(certainty) FILTER (WHERE level = 1) AS q1, max(certainty) FILTER (WHERE level = 2) AS q2, max(certainty) FILTER (WHERE level = 3) AS q3,
   arg_max(detail, level) AS deep, min(start) AS start FROM der GROUP BY 1, 2),
iface AS (SELECT c.ico, CASE WHEN code25 IS NOT NULL THEN 'RES' WHEN dp.ico IS NOT NULL THEN 'odvozeno' END AS source,
   CASE WHEN code25 IS NOT NULL THEN n.section ELSE dp.s END AS section, CASE WHEN code25 IS NOT NULL THEN n.division ELSE dp.d END AS division,
   CASE WHEN code25 IS NOT NULL THEN n.grp ELSE dp.g END AS grp, coalesce(code25, dp.g, dp.d, dp.s) AS code_2025,
   CASE WHEN code25 IS NOT NULL THEN n.level WHEN dp.g IS NOT NULL THEN 3 WHEN dp.d IS NOT NULL THEN 2 WHEN dp.s IS NOT NULL THEN 1 END AS level_2025,
   CASE WHEN code25 IS NOT NULL THEN 1.0 WHEN dp.g IS NOT NULL THEN q3 WHEN dp.d IS NOT NULL THEN q2 ELSE q1 END AS certainty,
   CASE WHEN code25 IS NOT NULL THEN CASE WHEN n.division IS NOT NULL THEN 1.0 END ELSE q2 END AS certainty_division,
   CASE WHEN code25 IS NULL AND deep = 'nejednoznacne' THEN 'nejednoznacne' END AS flag,
   c.code08 AS code_2008, p.section AS section_2008, p.division AS division_2008,
   CASE WHEN code25 IS NOT NULL THEN start25 ELSE coalesce(dp.start, start08) END AS start,
   code25 IS NOT NULL OR coalesce(q2, 0) >= 0.8 AS auto_link,
   CASE WHEN code25 IS NOT NULL THEN 'RES' WHEN dp.ico IS NULL THEN NULL WHEN coalesce(q2, 0) >= 0.8 THEN 'odvozeno' ELSE 'odvozeno, nejisté' END AS status
  FROM codes c LEFT JOIN dp ON dp.ico = c.ico AND c.code25 IS NULL LEFT JOIN c25 n ON n.code = c.code25 LEFT JOIN c08 p ON p.code = c.code08)
"""


@registered("WITH " + SQL_INTERFACE + """SELECT ico, source, section, division, grp, code_2025, level_2025, CAST(certainty AS DECIMAL(5,4)) AS certainty,
CAST(certainty_division AS DECIMAL(5,4)) AS certainty_division, flag, code_2008, section_2008, division_2008, start, auto_link, status FROM iface""")
def industry_interface(spark: SparkSession, sf: str) -> DataFrame:
    return interface(spark, sf).select(
        "ico", "source", "section", "division", "grp", "code_2025", "level_2025", "certainty", "certainty_division", "flag",
        "code_2008", "section_2008", "division_2008", "start", "auto_link", "status")


@registered("WITH " + SQL_INTERFACE + """SELECT p_size <= 40 AS living, count(*) AS n, count(*) FILTER (WHERE source = 'RES') AS official,
count(*) FILTER (WHERE source = 'odvozeno' AND flag IS NULL) AS derived, count(*) FILTER (WHERE source = 'odvozeno' AND flag IS NOT NULL) AS ambiguous,
count(*) FILTER (WHERE source = 'odvozeno' AND division IS NOT NULL) AS derived_division, count(*) FILTER (WHERE source IS NULL) AS none
FROM pt LEFT JOIN iface USING (ico) GROUP BY 1""")
def code_coverage(spark: SparkSession, sf: str) -> DataFrame:
    snap = coded_parts(spark, sf).select("ico", F.when(F.col("p_size") > 40, F.lit(date(2026, 1, 1))).alias("closed"))
    return N.coverage(snap, interface(spark, sf))


@registered(W + """SELECT level, count(*) AS codes, count(*) FILTER (WHERE base >= 20) AS codes_with_base
FROM (SELECT level, code_2008, max(base) AS base FROM mx GROUP BY 1, 2) GROUP BY 1""")
def matrix_base(spark: SparkSession, sf: str) -> DataFrame:
    return N.matrix_base(matrix(spark, sf))


@registered(W + """SELECT level, detail AS method, count(*) AS n, round(avg(CAST(certainty AS DOUBLE)), 4) AS mean_certainty FROM der GROUP BY 1, 2""")
def derived_by_method(spark: SparkSession, sf: str) -> DataFrame:
    return N.derived_by_method(derived(spark, sf))


_SECTIONS = (("A", "M"), ("B", "S"), ("C", "E"), ("D", "P"), ("E", "L"))
SQL_SECTIONS = "sec(section_2025, section_rev2) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _SECTIONS) + ")"


def section_map(spark: SparkSession) -> DataFrame:
    """Section of the new version -> its section in the old one (a fixed list of letters)."""
    rows = F.array(*[F.struct(F.lit(a).alias("section_2025"), F.lit(b).alias("section_rev2")) for a, b in _SECTIONS])
    return spark.range(1).select(F.inline(rows))


@registered("WITH " + SQL_INTERFACE + f""", {SQL_SECTIONS}
SELECT count(*) AS n, count(*) FILTER (WHERE division IS NOT NULL AND division_2008 IS NOT NULL) AS n_division,
count(*) FILTER (WHERE division <> division_2008) AS changed_division,
count(*) FILTER (WHERE coalesce(section_rev2, section) IS DISTINCT FROM section_2008) AS changed_section,
count(*) FILTER (WHERE section IS DISTINCT FROM section_2008) AS changed_letter
FROM iface LEFT JOIN sec ON section = section_2025 WHERE source = 'RES' AND code_2008 IS NOT NULL""")
def changed_branch(spark: SparkSession, sf: str) -> DataFrame:
    return N.changed_branch(interface(spark, sf), section_map(spark))


def placed(spark: SparkSession, sf: str) -> DataFrame:
    """Interface rows with a territory: the size band stands for the region, the size for the district."""
    where = coded_parts(spark, sf).select("ico", F.concat(F.lit("D"), F.col("p_size").cast("string")).alias("district"),
                                          F.concat(F.lit("R"), "band").alias("region"))
    return interface(spark, sf).join(where, "ico")


@registered("WITH " + SQL_INTERFACE + f""", {SQL_SECTIONS},
pl AS (SELECT i.*, 'D' || p_size AS district, 'R' || band AS region FROM iface i JOIN pt USING (ico)),
x AS (SELECT s.section_2025 AS industry, lv.level, CASE lv.level WHEN 'CR' THEN 'CZ' WHEN 'KRAJ' THEN region ELSE district END AS territory,
   pl.section_2008 = s.section_rev2 AS v08, coalesce(pl.section = s.section_2025, false) AND auto_link AS v25, pl.division, pl.division_2008
  FROM pl CROSS JOIN sec s CROSS JOIN (VALUES ('CR'), ('KRAJ'), ('OKRES')) lv(level)
  WHERE pl.section_2008 = s.section_rev2 OR (coalesce(pl.section = s.section_2025, false) AND auto_link)),
lf AS (SELECT industry, level, territory, division AS b, count(*) AS k, row_number() OVER (PARTITION BY industry, level, territory ORDER BY count(*) DESC, division) AS rn
   FROM x WHERE v08 AND NOT v25 AND division IS NOT NULL GROUP BY 1, 2, 3, 4),
jn AS (SELECT industry, level, territory, division_2008 AS b, count(*) AS k, row_number() OVER (PARTITION BY industry, level, territory ORDER BY count(*) DESC, division_2008) AS rn
   FROM x WHERE v25 AND NOT v08 AND division_2008 IS NOT NULL GROUP BY 1, 2, 3, 4),
g AS (SELECT industry, level, territory, count(*) FILTER (WHERE v08) AS n_2008, count(*) FILTER (WHERE v25) AS n_2025,
   count(*) FILTER (WHERE v08 AND v25) AS "both", count(*) FILTER (WHERE v08 AND NOT v25) AS "left", count(*) FILTER (WHERE v25 AND NOT v08) AS joined
   FROM x GROUP BY 1, 2, 3)
SELECT g.industry, g.level, g.territory, n_2008, n_2025, n_2025 - n_2008 AS change, lf.b AS main_left, jn.b AS main_joined,
  "left" < 10 AS left_below, joined < 10 AS joined_below, "both", "left", joined
FROM g LEFT JOIN lf ON lf.industry = g.industry AND lf.level = g.level AND lf.territory = g.territory AND lf.rn = 1
LEFT JOIN jn ON jn.industry = g.industry AND jn.level = g.level AND jn.territory = g.territory AND jn.rn = 1""")
def reclassification_effect(spark: SparkSession, sf: str) -> DataFrame:
    return N.reclassification(placed(spark, sf), section_map(spark))


@registered("WITH " + SQL_INTERFACE + """SELECT code_2025, lv.level, CASE lv.level WHEN 'CR' THEN 'CZ' WHEN 'KRAJ' THEN 'R' || band ELSE 'D' || p_size END AS territory,
count(*) AS n FROM iface JOIN pt USING (ico) CROSS JOIN (VALUES ('CR'), ('KRAJ'), ('OKRES')) lv(level)
WHERE auto_link AND (level_2025 BETWEEN 1 AND 3 OR code_2025 = '00') GROUP BY ALL""")
def complement_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Subjects known only to a section, division or group (groups are the deepest level of these lists)."""
    return N.complement_counts(placed(spark, sf))


@registered("WITH " + SQL_INTERFACE + """SELECT CASE WHEN auto_link AND (section = 'A' OR division IN ('63', '66')) THEN 'industry'
WHEN auto_link THEN 'others' ELSE 'unassigned' END AS grouping_name, count(*) AS n FROM iface GROUP BY 1""")
def industry_predicate(spark: SparkSession, sf: str) -> DataFrame:
    """Section A with divisions 63 and 66 against all other industries."""
    asked = {1: ["A"], 2: ["63", "66"]}
    name = F.when(N.in_industry(asked), "industry").when(N.in_other_industries(asked), "others").otherwise("unassigned")
    return interface(spark, sf).groupBy(name.alias("grouping_name")).agg(F.count(F.lit(1)).alias("n"))


@registered(W + """SELECT version, code, count(*) AS n FROM (SELECT 2008 AS version, code08 AS code FROM codes UNION ALL SELECT 2025, code25 FROM codes)
WHERE code IS NOT NULL AND NOT (version = 2025 AND code IN (SELECT code FROM c25 WHERE division <> '61' OR division IS NULL))
AND NOT (version = 2008 AND code IN (SELECT code FROM c08)) GROUP BY 1, 2""")
def codes_outside_list(spark: SparkSession, sf: str) -> DataFrame:
    """A list without division 61: its codes in use must be reported."""
    k = lists(spark, sf)
    new = k.new.filter("division IS NULL OR division <> '61'").withColumn("version", F.lit(2025))
    both = new.unionByName(k.old.withColumn("version", F.lit(2008)))
    return N.codes_outside_list(official_history(spark, sf), both).select("version", "code", "n")
