"""Published series and model estimates over order values."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regisight.catalog import registered
from regisight.functions import fixed as X
from regisight.operators import estimates as E
from regisight.operators import series as S
from regisight.operators import territory as T
from regisight.plans.proxy import SQL_SUBJECTS, district_code, region_code, subject_id, subjects, table
from regisight.session import materialise

# --- published series -------------------------------------------------------------------------------


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """Line items summed per district, section and order year, exact decimals."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), F.col("l_discount").cast("decimal(4,2)").alias("discount"),
        F.col("l_quantity").cast("decimal(18,0)").alias("quantity"), "l_returnflag")
    per_order = li.groupBy("l_orderkey").agg(
        F.sum("price").alias("gva"), F.sum((F.col("price") * (1 - F.col("discount"))).cast("decimal(22,4)")).alias("pyp"),
        F.sum("quantity").alias("emp"), F.sum(F.when(F.col("l_returnflag") == "R", F.col("quantity"))).alias("self"),
        F.sum(F.when(F.col("l_returnflag") == "A", F.col("price"))).alias("coe"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.substring("c_mktsegment", 1, 1).alias("section"))
    n = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    measures = ["gva", "pyp", "emp", "self", "coe"]
    return (
        per_order.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "section", "year").agg(*[F.sum(m).alias(m) for m in measures])
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(region_code(F.col("n_regionkey")).alias("region"),
                F.concat(region_code(F.col("n_regionkey")), district_code(F.col("n_nationkey"))).alias("district"),
                "section", "year", *measures))


def accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Regional accounts in long form; codes of smaller territories start with their region."""
    measures = ["gva", "pyp", "emp", "self", "coe"]
    cells = T.roll_up(sales(spark, sf), ["section", "year"], measures)
    both = cells.withColumn("nace", F.explode(F.array("section", F.lit("TOTAL")))).groupBy("territory", "nace", "year").agg(
        *[F.sum(m).alias(m) for m in measures])
    names = {"HPH_CP": "gva", "HPH_PYP": "pyp", "ZAM_EMP": "emp", "ZAM_SELF": "self", "NAHRADY": "coe"}
    rows = F.array(*[F.struct(F.lit(k).alias("indicator"), F.col(v).cast("double").alias("value")) for k, v in names.items()])
    long = both.select(F.col("territory").alias("geo"), "nace", "year", F.inline(rows)).filter(F.col("value").isNotNull())
    return materialise(long, "accounts")  # a published series is a stored table, read by every ratio


SQL_ACCOUNTS = """
WITH raw AS (SELECT 'R' || n_regionkey AS region, 'R' || n_regionkey || 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS district,
    substr(c_mktsegment, 1, 1) AS section, year(o_orderdate) AS year, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
    CAST(l_discount AS DECIMAL(4,2)) AS disc, CAST(l_quantity AS DECIMAL(18,0)) AS q, l_returnflag AS f
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
geo AS (SELECT *, unnest(['CZ', region, district]) AS g FROM raw),
nc AS (SELECT *, unnest([section, 'TOTAL']) AS nace FROM geo),
w AS (SELECT g AS geo, nace, year, CAST(sum(price) AS DOUBLE) AS cp, CAST(sum(CAST(price * (1 - disc) AS DECIMAL(22,4))) AS DOUBLE) AS pyp,
    CAST(sum(q) AS DOUBLE) AS emp, CAST(sum(q) FILTER (WHERE f = 'R') AS DOUBLE) AS self,
    CAST(sum(price) FILTER (WHERE f = 'A') AS DOUBLE) AS coe FROM nc GROUP BY ALL),
lk AS (SELECT *, pyp / CASE WHEN lag(year) OVER p = year - 1 THEN lag(cp) OVER p END AS link FROM w WINDOW p AS (PARTITION BY geo, nace ORDER BY year)),
mx AS (SELECT nace, max(year) AS y FROM w GROUP BY 1),
sh AS (SELECT lk.* FROM lk JOIN mx USING (nace) WHERE nace <> 'TOTAL' AND year > y - 5),
ix AS (SELECT *, exp(sum(CASE WHEN rn = 1 THEN 0 ELSE coalesce(ln(link), 0) END) OVER (PARTITION BY geo, nace ORDER BY year ROWS UNBOUNDED PRECEDING)) AS chain
  FROM (SELECT *, row_number() OVER (PARTITION BY geo, nace ORDER BY year) AS rn FROM sh)),
acc AS (SELECT ix.geo, ix.nace, ix.year, round(ix.cp, 0) AS gva, round(100 * ix.cp / t.cp, 2) AS gva_share_territory,
  CASE WHEN ix.geo <> 'CZ' THEN round(100 * ix.cp / s.cp, 2) END AS gva_share_state, round(100 * (ix.link - 1), 1) AS growth,
  round(100 * chain, 1) AS volume_index, round(ix.emp, 2) AS employed, round(100 * ix.self / ix.emp, 1) AS self_employed_share,
  round(ix.cp / ix.emp, 0) AS productivity,
  CASE WHEN ix.geo <> 'CZ' THEN round(100 * (ix.cp / ix.emp) / (s.cp / s.emp), 1) END AS productivity_index_state
FROM ix LEFT JOIN w t ON t.geo = ix.geo AND t.year = ix.year AND t.nace = 'TOTAL'
LEFT JOIN w s ON s.geo = 'CZ' AND s.nace = ix.nace AND s.year = ix.year)
"""


@registered(SQL_ACCOUNTS + "SELECT * FROM acc", ints=("year",))
def regional_accounts(spark: SparkSession, sf: str) -> DataFrame:
    return S.accounts_table(accounts(spark, sf))


@registered(SQL_ACCOUNTS + "SELECT geo, nace, year, growth, volume_index FROM acc", ints=("year",))
def chained_index(spark: SparkSession, sf: str) -> DataFrame:
    return S.accounts_table(accounts(spark, sf)).select("geo", "nace", "year", "growth", "volume_index")


@registered(SQL_ACCOUNTS + """SELECT w.geo, w.nace, w.year, round(w.coe, 0) AS compensation, round(w.cp, 0) AS gva, round(100 * w.coe / w.cp, 1) AS share,
round(100 * t.coe / t.cp, 1) AS share_all FROM w LEFT JOIN w t ON t.geo = w.geo AND t.year = w.year AND t.nace = 'TOTAL'
WHERE w.nace <> 'TOTAL' AND length(w.geo) = 2""", ints=("year",))
def compensation_share(spark: SparkSession, sf: str) -> DataFrame:
    return S.compensation_table(accounts(spark, sf), 2)


def wages(spark: SparkSession, sf: str) -> DataFrame:
    """Employees = orders in thousands, wage = mean order value, per territory, section and year."""
    o = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("year"), F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    s = subjects_place(spark, sf)
    base = o.join(s, "o_custkey").groupBy("section", "district", "region", "year").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))
    cells = T.roll_up(base, ["section", "year"], ["n", "v"])
    both = cells.filter(F.col("level") != T.DISTRICT).withColumn("nace", F.explode(F.array("section", F.lit("0")))).groupBy(
        "territory", "nace", "year").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    return materialise(both.select("territory", "nace", "year", (F.col("n") / 1000.0).alias("employees"),
                       (F.col("v").cast("double") / F.col("n")).alias("wage"), (F.col("year") >= 2001).alias("preliminary")), "wages")


def subjects_place(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", F.substring("c_mktsegment", 1, 1).alias("section"))
    n = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "o_custkey", "section", district_code(F.col("n_nationkey")).alias("district"), region_code(F.col("n_regionkey")).alias("region"))


SQL_WAGES = """
WITH r AS (SELECT substr(c_mktsegment, 1, 1) AS section, 'R' || n_regionkey AS region, year(o_orderdate) AS year, CAST(o_totalprice AS DECIMAL(18,2)) AS v
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
x AS (SELECT *, unnest(['CZ', region]) AS territory FROM r), y AS (SELECT *, unnest([section, '0']) AS nace FROM x),
w AS (SELECT territory, nace, year, count(*) / 1000.0 AS e, CAST(sum(v) AS DOUBLE) / count(*) AS w, year >= 2001 AS preliminary FROM y GROUP BY 1, 2, 3),
mx AS (SELECT max(year) AS y FROM w)
"""


@registered(SQL_WAGES + """SELECT a.territory, a.nace, a.year, round(a.e, 1) AS employees,
CASE WHEN a.territory <> 'CZ' THEN round(100.0 * a.e / s.e, 2) END AS employees_share_state, round(100.0 * a.e / t.e, 2) AS employees_share_territory,
round(a.w, 0) AS wage, CASE WHEN a.territory <> 'CZ' THEN round(100.0 * a.w / s.w, 1) END AS wage_index_state,
round(100.0 * a.w / t.w, 1) AS wage_index_territory, a.preliminary
FROM w a JOIN mx ON true LEFT JOIN w s ON s.territory = 'CZ' AND s.nace = a.nace AND s.year = a.year
LEFT JOIN w t ON t.nace = '0' AND t.territory = a.territory AND t.year = a.year WHERE a.nace <> '0' AND a.year > y - 5""", ints=("year",))
def wage_indices(spark: SparkSession, sf: str) -> DataFrame:
    return S.wage_table(wages(spark, sf))


@registered(SQL_WAGES + """SELECT territory, nace, year, round(e, 1) AS employees, round(w, 0) AS wage, preliminary FROM w WHERE nace = '0' AND year > 1999""", ints=("year",))
def newer_wages(spark: SparkSession, sf: str) -> DataFrame:
    w = wages(spark, sf)
    return S.newer_levels(w.filter(F.col("year") <= 1999), w.filter(F.col("nace") == "0"))


@registered(f"""WITH {SQL_SUBJECTS}, j AS (SELECT section AS industry, year(founded) AS year, 'born' AS k FROM subj WHERE founded IS NOT NULL
UNION ALL SELECT section, year(closed), 'died' FROM subj WHERE closed IS NOT NULL
UNION ALL SELECT substr(c_mktsegment, 1, 1), year(o_orderdate), 'active' FROM orders JOIN customer ON c_custkey = o_custkey),
w AS (SELECT industry, year, count(*) FILTER (WHERE k = 'active') AS active, count(*) FILTER (WHERE k = 'born') AS born,
 count(*) FILTER (WHERE k = 'died') AS died FROM j GROUP BY 1, 2),
c AS (SELECT *, row_number() OVER (PARTITION BY industry ORDER BY year DESC) AS rn FROM w WHERE active > 0 AND born > 0 AND died > 0)
SELECT industry, year, active, born, died, round(100.0 * born / active, 2) AS birth_rate, round(100.0 * died / active, 2) AS death_rate FROM c WHERE rn <= 5""", ints=("year",))
def business_demography(spark: SparkSession, sf: str) -> DataFrame:
    s = subjects(spark, sf)
    events = s.select(F.col("section").alias("industry"), F.inline(F.array(
        F.struct(F.year("founded").alias("year"), F.lit("born").alias("indicator")),
        F.struct(F.year("closed").alias("year"), F.lit("died").alias("indicator"))))).filter(F.col("year").isNotNull())
    o = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("year")).join(subjects_place(spark, sf), "o_custkey")
    counts = events.groupBy("industry", "year", "indicator").agg(F.count(F.lit(1)).alias("value")).unionByName(
        o.groupBy(F.col("section").alias("industry"), "year", F.lit("active").alias("indicator")).agg(F.count(F.lit(1)).alias("value")))
    return S.demography_table(counts)


@registered("""WITH m(section, a10) AS (VALUES ('A', 'A'), ('B', 'B-E'), ('F', 'F'), ('H', 'G-I'), ('M', 'L')),
i AS (SELECT DISTINCT p_type || '/' || CAST(CAST(floor(p_size / 10) AS INTEGER) AS VARCHAR) AS industry,
  CASE WHEN p_size < 10 THEN 'A' WHEN p_size < 20 THEN CASE WHEN p_type = 'PROMO' THEN 'B' ELSE 'F' END
       WHEN p_size < 30 THEN CASE WHEN substr(p_brand, 7) < '2' THEN 'H' ELSE 'M' END ELSE 'Z' END AS section FROM part)
SELECT industry, CASE WHEN count(DISTINCT a10) = 1 THEN min(a10) END AS a10,
CASE WHEN count(DISTINCT a10) > 1 THEN 'spans several groups' WHEN count(DISTINCT a10) = 0 THEN 'no group' END AS reason
FROM i LEFT JOIN m USING (section) GROUP BY 1""")
def a10_groups(spark: SparkSession, sf: str) -> DataFrame:
    size, kind = F.col("p_size"), F.col("p_type")
    section = (
        F.when(size < 10, "A").when(size < 20, F.when(kind == "PROMO", "B").otherwise("F"))
        .when(size < 30, F.when(F.substring("p_brand", 7, 10) < "2", "H").otherwise("M")).otherwise("Z"))
    industries = table(spark, sf, "part").select(
        F.concat(kind, F.lit("/"), F.floor(size / 10).cast("string")).alias("industry"), section.alias("section")).distinct()
    rows = F.array(*[F.struct(F.lit(s).alias("section"), F.lit(a).alias("a10")) for s, (a, _) in X.SECTION_TO_A10.items()])
    return S.section_groups(industries, spark.range(1).select(F.inline(rows))).select("industry", "a10", "reason")


# --- estimates --------------------------------------------------------------------------------------

RATE = 25.0
SQL_EST = f"""
WITH {SQL_SUBJECTS},
lv AS (SELECT *, unnest(['CZ', region]) AS territory FROM subj WHERE closed IS NULL),
cl AS (SELECT section, territory, CASE WHEN forma IN ('101', '105', '424') THEN 'FO' ELSE 'PO' END AS person,
   CASE WHEN katpo IS NULL OR katpo = '000' THEN NULL WHEN katpo IN ('110', '120', '130') THEN '0-9' WHEN katpo = '210' THEN '10-19'
        WHEN katpo IN ('220', '230') THEN '20-49' WHEN katpo IN ('240', '310', '320') THEN '50-249' ELSE 'GE250' END AS cls FROM lv),
pp AS (SELECT section, territory, person, count(*) FILTER (WHERE cls IS NULL) AS unk, count(cls) AS known FROM cl GROUP BY 1, 2, 3),
kk AS (SELECT unnest(['0-9', '10-19', '20-49', '50-249', 'GE250']) AS cls, unnest([1, 2, 3, 4, 5]) AS o),
oc AS (SELECT section, territory, person, cls, count(*) AS own FROM cl WHERE cls IS NOT NULL GROUP BY 1, 2, 3, 4),
ct AS (SELECT pp.section, pp.territory, kk.cls, kk.o, CAST(sum(coalesce(own, 0) + CASE WHEN o = 1 THEN unk ELSE 0 END) AS DOUBLE) AS basic,
   CAST(sum(coalesce(own, 0) + CASE WHEN known = 0 THEN CASE WHEN o = 1 THEN unk ELSE 0 END ELSE unk * coalesce(own, 0) / known END) AS DOUBLE) AS proportional
  FROM pp CROSS JOIN kk LEFT JOIN oc ON oc.section = pp.section AND oc.territory = pp.territory AND oc.person = pp.person AND oc.cls = kk.cls
  GROUP BY 1, 2, 3, 4),
sv0 AS (SELECT section, CASE WHEN katpo IS NULL OR katpo = '000' OR katpo IN ('110', '120', '130') THEN '0-9' WHEN katpo = '210' THEN '10-19'
        WHEN katpo IN ('220', '230') THEN '20-49' WHEN katpo IN ('240', '310', '320') THEN '50-249' ELSE 'GE250' END AS cls, ico, division FROM subj),
tu AS (SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS ico, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS t, count(*) AS k FROM orders GROUP BY 1),
sd AS (SELECT section, division, cls, count(*) AS ent, sum(k) AS emp, CAST(sum(t) AS DOUBLE) / 1000000 AS tur FROM sv0 JOIN tu USING (ico) GROUP BY 1, 2, 3),
sv AS (SELECT section, cls, CAST(sum(ent) AS DOUBLE) AS ent, CAST(sum(emp) AS DOUBLE) AS emp, 0.4 * sum(tur) + sum(ent) / 1000.0 AS av, sum(tur) AS tur,
   0.1 * sum(tur) AS gos FROM sd GROUP BY 1, 2),
gv AS (SELECT substr(c_mktsegment, 1, 1) AS section, unnest(['CZ', 'R' || n_regionkey]) AS territory, CAST(l_extendedprice AS DECIMAL(18,2)) AS p
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
ga AS (SELECT section, territory, CAST(sum(p) AS DOUBLE) / 1000000 AS gva FROM gv GROUP BY 1, 2),
st AS (SELECT section, sum(av) AS av FROM sv GROUP BY 1),
gl AS (SELECT g.section, g.territory, g.gva AS gva_accounts, st.av * 25 / s.gva AS factor, g.gva * (st.av * 25 / s.gva) AS gva
  FROM ga g JOIN ga s ON s.section = g.section AND s.territory = 'CZ' JOIN st ON st.section = g.section),
ac AS (SELECT section, unnest(['CZ', region]) AS territory, closed FROM subj),
sh AS (SELECT section, territory, count(*) FILTER (WHERE closed IS NULL) / count(*) AS active_share FROM ac GROUP BY 1, 2),
wt AS (SELECT ct.*, gl.gva, sv.av, sv.tur, ct.basic * active_share * av / ent AS wb, ct.proportional * active_share * av / ent AS wp
  FROM ct JOIN gl USING (section, territory) JOIN sh USING (section, territory) JOIN sv USING (section, cls)),
al AS (SELECT *, gva * wb / sum(wb) OVER p AS gva_basic, gva * wp / sum(wp) OVER p AS gva_proportional FROM wt WINDOW p AS (PARTITION BY section, territory)),
al2 AS (SELECT *, gva_basic * tur / av AS tur_basic, gva_proportional * tur / av AS tur_proportional FROM al)
"""


def survey(spark: SparkSession, sf: str, by_division: bool = False) -> DataFrame:
    """Business survey of the state: enterprises, persons, value added, turnover and surplus by class."""
    turnover = table(spark, sf, "orders").groupBy(subject_id(F.col("o_custkey")).alias("ico")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("t"), F.count(F.lit(1)).alias("k"))
    cls = F.coalesce(E.size_class(F.col("katpo")), F.lit(E.SMALLEST))
    d = subjects(spark, sf).select("ico", "section", "division", cls.alias("cls")).join(turnover, "ico").groupBy(
        "section", "division", "cls").agg(F.count(F.lit(1)).alias("ent"), F.sum("k").alias("emp"),
                                          (F.sum("t").cast("double") / 1000000).alias("tur"))
    whole = d.groupBy("section", "cls").agg(
        F.sum("ent").cast("double").alias("ent"), F.sum("emp").cast("double").alias("emp"),
        (0.4 * F.sum("tur") + F.sum("ent") / 1000.0).alias("av"), F.sum("tur").alias("tur"), (0.1 * F.sum("tur")).alias("gos"))
    if not by_division:
        return whole
    parts = d.select("section", "division", "cls", F.col("ent").cast("double").alias("ent"), F.col("emp").cast("double").alias("emp"),
                     F.lit(None).cast("double").alias("av"), "tur", F.lit(None).cast("double").alias("gos"))
    return whole.withColumn("division", F.lit(None).cast("string")).unionByName(parts)


def spread(df: DataFrame) -> DataFrame:
    """Rows for the state and for the region."""
    return df.withColumn("territory", F.explode(F.array(F.lit("CZ"), F.col("region"))))


def class_count_cells(spark: SparkSession, sf: str) -> DataFrame:
    # counted per attribute first, then doubled for state and region
    living = subjects(spark, sf).filter(F.col("closed").isNull()).groupBy("section", "region", "forma", "katpo").agg(
        F.count(F.lit(1)).alias("n"))
    return E.class_counts(spread(living), ["section", "territory"], F.col("n"))


def survey_level(spark: SparkSession, sf: str) -> DataFrame:
    gva = sales(spark, sf).groupBy("section", "region").agg(F.sum("gva").alias("g"))
    acc = spread(gva).groupBy("section", "territory").agg((F.sum("g").cast("double") / 1000000).alias("gva"))
    total = survey(spark, sf).groupBy("section").agg(F.sum("av").alias("av"))
    return E.survey_level(acc, total, F.lit(RATE))


def allocated(spark: SparkSession, sf: str) -> DataFrame:
    counts = subjects(spark, sf).groupBy("section", "region").agg(
        F.count_if(F.col("closed").isNull()).alias("a"), F.count(F.lit(1)).alias("b"))
    active = spread(counts).groupBy("section", "territory").agg((F.sum("a") / F.sum("b")).alias("active_share"))
    inputs = survey_level(spark, sf).select("section", "territory", "gva").join(active, ["section", "territory"])
    return E.allocate(class_count_cells(spark, sf), inputs, survey(spark, sf), ["section", "territory"], "section")


@registered(SQL_EST + "SELECT section, territory, cls, round(basic, 6) AS basic, round(proportional, 6) AS proportional FROM ct")
def size_class_counts(spark: SparkSession, sf: str) -> DataFrame:
    return class_count_cells(spark, sf).select(
        "section", "territory", "cls", F.round("basic", 6).alias("basic"), F.round("proportional", 6).alias("proportional"))


@registered(SQL_EST + """SELECT section, territory, cls, round(gva_basic, 4) AS gva_basic, round(gva_proportional, 4) AS gva_proportional,
round(tur_basic, 4) AS tur_basic, round(tur_proportional, 4) AS tur_proportional FROM al2""")
def size_allocation(spark: SparkSession, sf: str) -> DataFrame:
    m = ["gva_basic", "gva_proportional", "tur_basic", "tur_proportional"]
    return allocated(spark, sf).select("section", "territory", "cls", *[F.round(x, 4).alias(x) for x in m])


@registered(SQL_EST + "SELECT section, territory, round(gva_accounts, 4) AS gva_accounts, round(factor, 4) AS factor, round(gva, 4) AS gva FROM gl")
def survey_conversion(spark: SparkSession, sf: str) -> DataFrame:
    return survey_level(spark, sf).select("section", "territory", F.round("gva_accounts", 4).alias("gva_accounts"), "factor", F.round("gva", 4).alias("gva"))


def _conc(m: str, label: str, classes: str) -> str:
    a, b = (f"100 * sum({m}_{v}) FILTER (WHERE cls IN ({classes})) / sum({m}_{v})" for v in ("basic", "proportional"))
    return f"round(least({a}, {b}), 1) AS {m}_{label}_lo, round(greatest({a}, {b}), 1) AS {m}_{label}_hi"


_UP10, _UP50 = "'10-19', '20-49', '50-249', 'GE250'", "'50-249', 'GE250'"


@registered(SQL_EST + f"""SELECT section, territory, {_conc('gva', '10', _UP10)}, {_conc('tur', '10', _UP10)}, {_conc('gva', '50', _UP50)},
{_conc('tur', '50', _UP50)} FROM al2 GROUP BY 1, 2""")
def size_concentration(spark: SparkSession, sf: str) -> DataFrame:
    return E.concentration(allocated(spark, sf), ["section", "territory"])


SQL_GROUPS = SQL_EST + """,
mn AS (SELECT section, territory, max(least(basic, proportional)) FILTER (WHERE o = 1) AS n1, max(least(basic, proportional)) FILTER (WHERE o = 2) AS n2,
  max(least(basic, proportional)) FILTER (WHERE o = 3) AS n3, max(least(basic, proportional)) FILTER (WHERE o = 4) AS n4,
  max(least(basic, proportional)) FILTER (WHERE o = 5) AS n5 FROM ct GROUP BY 1, 2),
f1 AS (SELECT *, n1 AS a1, CASE WHEN n1 >= 10 THEN 1 ELSE 0 END AS c1 FROM mn),
f2 AS (SELECT *, CASE WHEN c1 = 1 THEN 0 ELSE a1 END + n2 AS a2 FROM f1), g2 AS (SELECT *, CASE WHEN a2 >= 10 THEN 1 ELSE 0 END AS c2 FROM f2),
f3 AS (SELECT *, CASE WHEN c2 = 1 THEN 0 ELSE a2 END + n3 AS a3 FROM g2), g3 AS (SELECT *, CASE WHEN a3 >= 10 THEN 1 ELSE 0 END AS c3 FROM f3),
f4 AS (SELECT *, CASE WHEN c3 = 1 THEN 0 ELSE a3 END + n4 AS a4 FROM g3), g4 AS (SELECT *, CASE WHEN a4 >= 10 THEN 1 ELSE 0 END AS c4 FROM f4),
f5 AS (SELECT *, CASE WHEN c4 = 1 THEN 0 ELSE a4 END + n5 AS a5 FROM g4), g5 AS (SELECT *, CASE WHEN a5 >= 10 THEN 1 ELSE 0 END AS c5 FROM f5),
gr AS (SELECT section, territory, c5, c1 + c2 + c3 + c4 AS last, [0, c1, c1 + c2, c1 + c2 + c3, c1 + c2 + c3 + c4] AS g FROM g5),
grp AS (SELECT ct.section, ct.territory, ct.cls, ct.o, CASE WHEN c5 = 0 AND g[o] = last AND last > 0 THEN last - 1 ELSE g[o] END AS grp FROM ct JOIN gr USING (section, territory))
"""


@registered(SQL_GROUPS + "SELECT section, territory, cls, grp FROM grp")
def class_merge(spark: SparkSession, sf: str) -> DataFrame:
    return E.publication_groups(class_count_cells(spark, sf), ["section", "territory"])


@registered(SQL_GROUPS + """, t AS (SELECT section, territory, grp, string_agg(cls, '+' ORDER BY grp.o) AS classes, sum(gva_basic) AS a, sum(gva_proportional) AS b,
sum(tur_basic) AS ta, sum(tur_proportional) AS tb, max(gva) AS gva FROM al2 JOIN grp USING (section, territory, cls) GROUP BY 1, 2, 3)
SELECT section, territory, classes, round(least(a, b), 0) AS gva_lo, round(greatest(a, b), 0) AS gva_hi, round(least(ta, tb), 0) AS turnover_lo,
round(greatest(ta, tb), 0) AS turnover_hi, round(least(100 * a / gva, 100 * b / gva), 1) AS share_lo, round(greatest(100 * a / gva, 100 * b / gva), 1) AS share_hi FROM t""")
def size_estimates(spark: SparkSession, sf: str) -> DataFrame:
    groups = E.publication_groups(class_count_cells(spark, sf), ["section", "territory"])
    return E.estimate_table(allocated(spark, sf), groups, ["section", "territory"])


@registered(SQL_EST + """, m AS (SELECT section, sum(tur_basic) AS a, sum(tur_proportional) AS b FROM al2 WHERE territory = 'CZ' GROUP BY 1),
f AS (SELECT section, sum(tur) * 25 AS fact FROM sv GROUP BY 1),
x AS (SELECT section, round(least(a, b), 0) AS model_lo, round(greatest(a, b), 0) AS model_hi, fact FROM m JOIN f USING (section)),
y AS (SELECT *, greatest(abs(100 * (model_lo / fact - 1)), abs(100 * (model_hi / fact - 1))) AS off FROM x)
SELECT section, model_lo, model_hi, round(fact, 0) AS fact, round(off, 2) AS deviation, model_lo <= fact AND fact <= model_hi AND off <= 1 AS met FROM y""")
def model_consistency(spark: SparkSession, sf: str) -> DataFrame:
    return E.consistency(allocated(spark, sf).filter(F.col("territory") == "CZ"), survey(spark, sf), F.lit(RATE))


@registered(SQL_EST + """, x AS (SELECT section, cls, round(least(100 * gva_basic / gva, 100 * gva_proportional / gva), 1) AS model_lo,
round(greatest(100 * gva_basic / gva, 100 * gva_proportional / gva), 1) AS model_hi FROM al2 WHERE territory = 'CZ'),
f AS (SELECT section, cls, round(100 * av / sum(av) OVER (PARTITION BY section), 1) AS fact FROM sv)
SELECT section, cls, model_lo, model_hi, fact, round(CASE WHEN fact BETWEEN model_lo AND model_hi THEN 0 ELSE least(abs(model_lo - fact), abs(model_hi - fact)) END, 1) AS gap
FROM x JOIN f USING (section, cls)""")
def model_class_shares(spark: SparkSession, sf: str) -> DataFrame:
    return E.class_consistency(allocated(spark, sf).filter(F.col("territory") == "CZ"), survey(spark, sf))


@registered(SQL_EST + """, p AS (SELECT section, cls, round(min(tur / ent * 25), 2) AS lo, round(max(tur / ent * 25), 2) AS hi FROM sd GROUP BY 1, 2)
SELECT section, cls, round(ent, 0) AS enterprises, round(emp, 0) AS persons, round(tur / ent * 25, 2) AS per_enterprise, lo AS per_enterprise_lo,
hi AS per_enterprise_hi, round(100 * gos / tur, 1) AS margin FROM sv LEFT JOIN p USING (section, cls)""")
def survey_facts(spark: SparkSession, sf: str) -> DataFrame:
    return E.survey_facts(survey(spark, sf, True), F.lit(RATE))


@registered(SQL_ACCOUNTS + f""", b AS (SELECT year(founded) AS year, section AS nace FROM ({"WITH " + SQL_SUBJECTS + "SELECT * FROM subj"}) WHERE founded IS NOT NULL)
SELECT nace, max(year) AS year FROM (SELECT DISTINCT nace, year FROM w WHERE nace <> 'TOTAL') JOIN (SELECT DISTINCT nace, year FROM b) USING (nace, year) GROUP BY 1""", ints=("year",))
def latest_common_year(spark: SparkSession, sf: str) -> DataFrame:
    """Latest year with accounts and with foundings, per section."""
    founded = subjects(spark, sf).filter(F.col("founded").isNotNull()).select(F.col("section").alias("nace"), F.year("founded").alias("year"))
    return S.latest_common_year(accounts(spark, sf).filter("nace <> 'TOTAL'"), founded, ["nace"])
