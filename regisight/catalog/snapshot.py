"""Quality, structure and dynamics of the subject snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regisight.catalog import registered
from regisight.catalog.regional import living
from regisight.functions import fixed as X
from regisight.functions.codes import person_type
from regisight.operators import dynamics as Y
from regisight.operators import indicators as I
from regisight.operators import quality as Q
from regisight.operators import structure as S
from regisight.operators import territory as T
from regisight.plans.proxy import SNAPSHOT, SQL_SUBJECTS, SQL_TERRITORY, subject_id, subjects, table, territories
from regisight.session import materialise



def day():
    return F.lit(SNAPSHOT)

FIRST, LAST = 1998, 2001

# --- labelled snapshot and quality -----------------------------------------------------------------

SQL_QUALITY_INPUT = f"""
WITH {SQL_SUBJECTS},
snap AS (
  SELECT ico, nullif(name, 'Customer#000000001') AS name, founded, closed,
         nullif(forma, '205') AS forma, nullif(district, 'N03') AS district,
         CASE WHEN section = 'M' AND closed IS NOT NULL THEN '00' ELSE nullif(division, '11') END AS nace,
         CASE WHEN closed IS NULL THEN division END AS nace2025, katpo,
         CASE WHEN forma <> '112' THEN district END AS address_code
  FROM subj),
nace_list AS (SELECT DISTINCT division AS code, false AS pseudo FROM subj WHERE division <> '21' UNION ALL SELECT '00', true),
district_list AS (SELECT DISTINCT district AS code FROM subj WHERE district < 'N20'),
size_list AS (SELECT DISTINCT katpo AS code FROM subj WHERE katpo < '300'),
form_list AS (SELECT DISTINCT forma AS code FROM subj WHERE forma <> '424')
"""


def quality_input(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """A snapshot with gaps, and code lists that miss some codes."""
    s = subjects(spark, sf)
    c = F.col
    snap = s.select(
        "snapshot", "ico", F.nullif(c("name"), F.lit("Customer#000000001")).alias("name"), "founded", "closed",
        F.nullif(c("forma"), F.lit("205")).alias("forma"), F.nullif(c("district"), F.lit("N03")).alias("district"),
        F.when((c("section") == "M") & c("closed").isNotNull(), "00").otherwise(F.nullif(c("division"), F.lit("11")))
        .alias("nace"),
        F.when(c("closed").isNull(), c("division")).alias("nace2025"), "katpo",
        F.when(c("forma") != "112", c("district")).alias("address_code"),
    )

    def codes(column: str, keep) -> DataFrame:
        return s.filter(keep).select(c(column).alias("code")).distinct()

    nace = codes("division", c("division") != "21").withColumn("pseudo", F.lit(False)).unionByName(
        spark.range(1).select(F.lit("00").alias("code"), F.lit(True).alias("pseudo"))
    )
    return (snap, nace, codes("district", c("district") < "N20"), codes("katpo", c("katpo") < "300"),
            codes("forma", c("forma") != "424"))


_FLAGS = """
flags AS (
  SELECT s.*, s.closed IS NOT NULL AS gone, s.nace IS NULL AS e_n, coalesce(n.pseudo, false) AS p_n,
         s.nace IS NOT NULL AND n.code IS NULL AS o_n, s.district IS NULL AS e_d,
         s.district IS NOT NULL AND d.code IS NULL AS o_d, s.katpo IS NULL AS e_k, coalesce(s.katpo = '000', false) AS u_k,
         s.katpo IS NOT NULL AND k.code IS NULL AS o_k, s.forma IS NULL AS e_f, s.forma IS NOT NULL AND f.code IS NULL AS o_f
  FROM snap s LEFT JOIN nace_list n ON n.code = s.nace LEFT JOIN district_list d ON d.code = s.district
  LEFT JOIN size_list k ON k.code = s.katpo LEFT JOIN form_list f ON f.code = s.forma),
z AS (SELECT 'vse' AS base, * FROM flags UNION ALL
      SELECT CASE WHEN gone THEN 'se_zanikem' ELSE 'bez_zaniku' END, * FROM flags)
"""
_METRIC_SQL = {
    "radky": "true", "se_zanikem": "gone", "bez_zaniku": "NOT gone",
    "zanik_jen_ico": "gone AND founded IS NULL AND e_f AND e_d AND e_n AND name IS NULL", "nace_prazdne": "e_n",
    "nace_pseudokod": "p_n", "nace_mimo_ciselnik": "o_n", "bez_nace_sekce": "e_n OR p_n OR o_n",
    "nace2025_prazdne": "nace2025 IS NULL", "uzemi_prazdne": "e_d", "uzemi_mimo_ciselnik": "o_d",
    "bez_kraje": "e_d OR o_d", "katpo_prazdne": "e_k", "katpo_neuvedeno": "u_k", "katpo_mimo_ciselnik": "o_k",
    "bez_kategorie_pracovniku": "e_k OR u_k OR o_k", "forma_prazdna": "e_f", "forma_mimo_ciselnik": "o_f",
    "vznik_prazdny": "founded IS NULL", "adresni_misto_prazdne": "address_code IS NULL",
}
_METRIC_UNION = " UNION ALL ".join(
    f"SELECT base, {order} AS ord, '{m}' AS metric, count(*) FILTER (WHERE {_METRIC_SQL[m]}) AS count, "
    f"count(*) AS denominator FROM z GROUP BY base" for order, m in Q.METRICS
)


@registered(SQL_QUALITY_INPUT + "," + _FLAGS + f""", u AS ({_METRIC_UNION})
SELECT base, ord, metric, count, denominator, round(count / nullif(denominator, 0), 6) AS share FROM u""")
def quality_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return Q.quality_metrics(*quality_input(spark, sf)).drop("snapshot")


@registered(SQL_QUALITY_INPUT + "," + _FLAGS + f""", u AS ({_METRIC_UNION})
SELECT metric, round(count / nullif(denominator, 0), 6) AS share FROM u
WHERE base = 'bez_zaniku' AND metric IN ('bez_nace_sekce', 'bez_kraje') AND round(count / nullif(denominator, 0), 6) > 0.2""")
def quality_exceeded(spark: SparkSession, sf: str) -> DataFrame:
    return Q.exceeded(Q.quality_metrics(*quality_input(spark, sf))).select("metric", "share")


@registered(f"""WITH {SQL_SUBJECTS}, {SQL_TERRITORY}
SELECT s.ico, s.closed IS NOT NULL AS is_closed, s.name, s.district, t.district_name, s.region, t.region_name,
       year(s.founded) AS founded_year, CASE WHEN s.forma IN ('101', '105', '424') THEN 'FO' ELSE 'PO' END AS person
FROM subj s LEFT JOIN terr t ON t.district = s.district""", ints=("founded_year",))
def labelled_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    places = territories(spark, sf).select(F.col("district").alias("_d"), "district_name", "region_name")
    return Q.label(subjects(spark, sf), [(places, "district", "_d")]).select(
        "ico", F.col("closed").isNotNull().alias("is_closed"), "name", "district", "district_name", "region",
        "region_name", F.year("founded").alias("founded_year"), person_type(F.col("forma")).alias("person"),
    )


@registered(f"WITH {SQL_SUBJECTS} SELECT region, section, count(*) AS n FROM subj WHERE closed IS NULL GROUP BY 1, 2")
def region_section_counts(spark: SparkSession, sf: str) -> DataFrame:
    return Q.region_section_counts(subjects(spark, sf)).drop("snapshot")


def published_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Published counts per region and industry for two quarters, with totals; the latest has
    customers with a positive balance as registered and those above 5000 as active."""
    c = subjects(spark, sf).select("ico", "region", "section")
    bal = table(spark, sf, "customer")
    rows = bal.select(subject_id(F.col("c_custkey")).alias("ico"), "c_acctbal").join(c, "ico")
    code = F.when(F.col("section") == "B", "05390001").otherwise(F.col("section"))
    cube = rows.withColumn("nace", code).filter(F.col("region") != "R4").cube("region", "nace").agg(
        F.count_if(F.col("c_acctbal") > 0).cast("double").alias("reg"),
        F.count_if(F.col("c_acctbal") > 5000).cast("double").alias("akt"),
    )
    value = F.array(F.struct(F.lit("reg").alias("indicator"), F.col("reg").alias("value")),
                    F.struct(F.lit("akt").alias("indicator"), F.col("akt").alias("value")))
    return cube.select(
        F.lit("Q").alias("selection"), F.coalesce("region", F.lit("CZ")).alias("territory"),
        F.coalesce("nace", F.lit("0")).alias("nace"), F.explode(F.array(F.lit("2000-Q4"), F.lit("2001-Q1"))).alias("period"),
        F.inline(value),
    )


@registered(f"""WITH {SQL_SUBJECTS},
bal AS (SELECT ico, region, CASE WHEN section = 'B' THEN '05390001' ELSE section END AS nace, c_acctbal
        FROM subj JOIN customer ON lpad(CAST(c_custkey AS VARCHAR), 8, '0') = ico WHERE region <> 'R4'),
pub AS (SELECT coalesce(region, 'CZ') AS territory, coalesce(nace, '0') AS nace,
        count(*) FILTER (WHERE c_acctbal > 0) AS registered, count(*) FILTER (WHERE c_acctbal > 5000) AS active
        FROM bal GROUP BY CUBE (region, nace)),
mine AS (SELECT region, CASE WHEN section = 'B' THEN '05390001' WHEN section IS NULL THEN '8' ELSE section END AS nace,
        closed IS NULL AS living,
        coalesce(founded <= DATE '2001-03-31' AND (closed IS NULL OR closed > DATE '2001-03-31'), false) AS existed FROM subj),
own AS (SELECT CASE WHEN grouping(region) = 1 THEN 'CZ' ELSE coalesce(region, '?') END AS territory,
        CASE WHEN grouping(nace) = 1 THEN '0' ELSE nace END AS nace,
        count(*) FILTER (WHERE living) AS l, count(*) FILTER (WHERE existed) AS e
        FROM mine WHERE living OR existed GROUP BY CUBE (region, nace))
SELECT coalesce(pub.territory, own.territory) AS territory, coalesce(pub.nace, own.nace) AS nace,
  coalesce(l, 0) AS own_living, coalesce(e, 0) AS own_existing, registered, active,
  coalesce(l, 0) - registered AS difference,
  round(100.0 * (coalesce(l, 0) - registered) / nullif(registered, 0), 2) AS difference_pct,
  round(100.0 * (coalesce(e, 0) - registered) / nullif(registered, 0), 2) AS difference_existing_pct,
  CASE WHEN registered IS NULL OR registered = 0 THEN coalesce(l, 0) > 0
       ELSE abs(coalesce(l, 0) - registered) > 0.1 * registered END AS over_10_pct,
  round(100.0 * active / nullif(registered, 0), 1) AS active_share_pct
FROM pub FULL JOIN own ON pub.territory = own.territory AND pub.nace = own.nace""")
def cube_vs_published(spark: SparkSession, sf: str) -> DataFrame:
    section = F.col("section")
    category = F.when(section == "B", "05390001").when(section.isNull(), "8").otherwise(section)
    return Q.compare_with_published(subjects(spark, sf), published_counts(spark, sf), "Q", category)


_DIMS = (("pravni_forma", 1, "forma"), ("kategorie_pracovniku", 2, "katpo"),
         ("rok_vzniku", 3, "CAST(year(founded) AS VARCHAR)"))


@registered(f"""WITH {SQL_SUBJECTS}, p AS (SELECT * FROM subj WHERE closed IS NULL),
c AS (SELECT section, region, 'celkem' AS breakdown, 0 AS breakdown_order, CAST(NULL AS VARCHAR) AS code, count(*) AS n
      FROM p GROUP BY 1, 2 UNION ALL """ + " UNION ALL ".join(
    f"SELECT section, region, '{d}', {o}, {e} AS code, count(*) FROM p GROUP BY section, region, {e}" for d, o, e in _DIMS)
    + """) SELECT *, n < 10 AS below_threshold, CASE WHEN n >= 10 THEN n END AS n_publishable FROM c""")
def intersection_summary(spark: SparkSession, sf: str) -> DataFrame:
    return Q.intersection_summary(subjects(spark, sf))


@registered(f"""WITH {SQL_SUBJECTS}, p AS (SELECT * FROM subj WHERE closed IS NULL AND section = 'F' AND region = 'R3'),
c AS (SELECT 'celkem' AS breakdown, 0 AS o, CAST(NULL AS VARCHAR) AS code, count(*) AS n FROM p UNION ALL """
    + " UNION ALL ".join(f"SELECT '{d}', {o}, {e} AS code, count(*) FROM p GROUP BY {e}" for d, o, e in _DIMS)
    + """) SELECT row_number() OVER (ORDER BY o, CASE WHEN breakdown = 'rok_vzniku' THEN code END, n DESC, code) AS position,
breakdown, code, n, n < 10 AS below_threshold FROM c""", ints=("position",))
def pilot_intersection(spark: SparkSession, sf: str) -> DataFrame:
    """Preset view of one section in one region, in reading order."""
    from pyspark.sql import Window

    one = subjects(spark, sf).filter((F.col("section") == "F") & (F.col("region") == "R3"))
    rows = Q.intersection_summary(one)  # as many rows as the code lists of one cell have items
    order = Window.partitionBy("section", "region").orderBy(*Q.intersection_order())
    return rows.select(F.row_number().over(order).alias("position"), "breakdown", "code", "n", "below_threshold")


# --- structure -------------------------------------------------------------------------------------

SQL_BAND = """CASE WHEN age < 3 THEN '0-2' WHEN age < 6 THEN '3-5' WHEN age < 11 THEN '6-10' WHEN age < 21 THEN '11-20'
WHEN age < 31 THEN '21-30' WHEN age >= 31 THEN '31+' ELSE '?' END"""
SQL_STRUCTURE = f"""
WITH {SQL_SUBJECTS}, {SQL_TERRITORY},
p AS (SELECT *, CASE WHEN forma IN ('101', '105', '424') THEN 'FO' ELSE 'PO' END AS person,
        CASE WHEN katpo IS NULL THEN '000' WHEN katpo IN ('120', '130') THEN '1-9' WHEN katpo IN ('210', '220', '230') THEN '10-49'
             WHEN katpo IN ('240', '310', '320') THEN '50-249' WHEN katpo IN ('110', '000') THEN katpo ELSE '250+' END AS size,
        (DATE '2001-08-01' - founded) / 365.25 AS age, DATE '2001-08-01' - founded AS days
      FROM subj WHERE closed IS NULL),
items AS (
  SELECT section, district, 'fopo' AS dim, person AS item FROM p UNION ALL
  SELECT section, district, 'forma:' || person, forma FROM p UNION ALL
  SELECT section, district, 'vel:' || person, size FROM p UNION ALL
  SELECT section, district, 'vek', {SQL_BAND} FROM p),
st AS (SELECT section, level, territory, dim, item, count(*) AS n FROM items JOIN bridge USING (district) GROUP BY ALL)
"""


def structure(spark: SparkSession, sf: str) -> DataFrame:
    # read several times by shares, benchmarks and cascades
    return materialise(S.structure_cells(living(spark, sf), ["section"], day()), "structure")


@registered(SQL_STRUCTURE + """SELECT section, level, territory, dim, item, n,
CAST(sum(n) OVER (PARTITION BY section, level, territory, dim) AS BIGINT) AS total,
round(100.0 * n / sum(n) OVER (PARTITION BY section, level, territory, dim), 1) AS share FROM st""")
def structure_shares(spark: SparkSession, sf: str) -> DataFrame:
    return S.with_shares(structure(spark, sf), ["section", "level", "territory"])


@registered(SQL_STRUCTURE + """SELECT section, level, territory, count(*) AS n, count(*) FILTER (WHERE days IS NULL) AS n_missing,
round(avg(days) / 365.25, 1) AS mean_age, round(median(days) / 365.25, 1) AS median_age
FROM p JOIN bridge USING (district) GROUP BY 1, 2, 3""")
def age_stats(spark: SparkSession, sf: str) -> DataFrame:
    return S.age_statistics(living(spark, sf), ["section"], day())


@registered(f"""WITH {SQL_SUBJECTS}, {SQL_TERRITORY}
SELECT section, year(closed) AS year, level, territory, count(*) AS n FROM subj JOIN bridge USING (district)
WHERE year(closed) >= 1998 AND forma NOT IN ('101', '105', '424') GROUP BY ALL""", ints=("year",))
def closures_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return S.closures_by_year(subjects(spark, sf), ["section"], FIRST)


SQL_BENCH = SQL_STRUCTURE + """,
own0 AS (SELECT *, sum(n) OVER w AS total, coalesce(sum(n) FILTER (WHERE n < 10) OVER w, 0) AS small,
           row_number() OVER (PARTITION BY section, territory, dim ORDER BY CASE WHEN n >= 10 THEN 0 ELSE 1 END, n, item) AS rn
         FROM st WHERE level = 'KRAJ' WINDOW w AS (PARTITION BY section, territory, dim)),
own AS (SELECT section, territory, dim, item, n, total < 10 AS hid,
          n >= 10 AND NOT (small > 0 AND small < 10 AND rn = 1) AND total >= 10 AS pub FROM own0),
groups AS (SELECT DISTINCT section, territory, dim FROM own),
pairs AS (SELECT g.*, s.item, s.n AS n_state FROM groups g JOIN st s USING (section, dim) WHERE s.level = 'CR'),
merged AS (SELECT p.section, p.territory, p.dim, CASE WHEN o.pub THEN p.item ELSE '(other)' END AS label,
             coalesce(sum(o.n), 0) AS n, sum(p.n_state) AS n_state, bool_or(coalesce(o.hid, false)) AS hid
           FROM pairs p LEFT JOIN own o USING (section, territory, dim, item) GROUP BY 1, 2, 3, 4),
tot AS (SELECT *, sum(n) OVER w AS total, sum(n_state) OVER w AS total_state,
          coalesce(sum(n_state) FILTER (WHERE n_state < 10) OVER w, 0) AS small,
          row_number() OVER (PARTITION BY section, territory, dim ORDER BY CASE WHEN n_state >= 10 THEN 0 ELSE 1 END, n_state, label) AS rn
        FROM merged WINDOW w AS (PARTITION BY section, territory, dim)),
sh AS (SELECT section, territory, dim, label AS item,
         CASE WHEN n > 0 OR label <> '(other)' THEN round(100.0 * n / nullif(total, 0), 1) END AS share,
         CASE WHEN label <> '(other)' AND total_state >= 10 AND n_state >= 10 AND NOT (small > 0 AND small < 10 AND rn = 1)
              THEN round(100.0 * n_state / total_state, 1) END AS share_state FROM tot WHERE NOT hid)
SELECT *, round(share - share_state, 1) AS difference FROM sh"""


@registered(SQL_BENCH)
def structure_benchmark(spark: SparkSession, sf: str) -> DataFrame:
    return S.benchmark(structure(spark, sf), ["section"])


CHOSEN = ["R1", "R3"]
SQL_REGIONAL = SQL_STRUCTURE + """,
o0 AS (SELECT *, sum(n) OVER w AS total, coalesce(sum(n) FILTER (WHERE n < 10) OVER w, 0) AS small,
  row_number() OVER (PARTITION BY section, territory, dim ORDER BY CASE WHEN n >= 10 THEN 0 ELSE 1 END, n, item) AS rn
  FROM st WHERE level <> 'CR' WINDOW w AS (PARTITION BY section, territory, dim)),
own AS (SELECT *, n >= 10 AND NOT (small > 0 AND small < 10 AND rn = 1) AS pub FROM o0 WHERE total >= 10),
tot AS (SELECT section, territory, dim, level, max(total) AS total, coalesce(sum(n) FILTER (WHERE NOT pub), 0) AS other FROM own GROUP BY 1, 2, 3, 4),
cnt AS (SELECT region AS parent, count(*) AS districts FROM terr GROUP BY 1),
refs AS (SELECT p.level, p.territory, r.reference FROM places p, (VALUES ('CZ'), ('R1'), ('R3')) AS r(reference) LEFT JOIN cnt ON cnt.parent = p.parent
  WHERE p.level <> 'CR' AND r.reference <> p.territory AND NOT (p.level = 'OKRES' AND p.parent = r.reference AND cnt.districts = 1)),
beside AS (SELECT t.*, r.reference FROM tot t JOIN refs r USING (level, territory)),
there AS (SELECT section, territory AS reference, dim, item, n AS nt FROM st WHERE level = 'CR' OR level = 'KRAJ' AND territory IN ('R1', 'R3')),
whole AS (SELECT section, reference, dim, sum(nt) AS total_there FROM there GROUP BY 1, 2, 3),
its AS (SELECT b.section, b.territory, b.reference, b.dim, o.item, o.n, coalesce(t.nt, 0) AS nt FROM own o JOIN beside b USING (section, territory, dim)
  LEFT JOIN there t ON t.section = b.section AND t.reference = b.reference AND t.dim = b.dim AND t.item = o.item WHERE o.pub),
al AS (SELECT * FROM its UNION ALL SELECT b.section, b.territory, b.reference, b.dim, '(rest)', NULL, w.total_there - coalesce((SELECT sum(i.nt) FROM its i
    WHERE i.section = b.section AND i.territory = b.territory AND i.reference = b.reference AND i.dim = b.dim), 0) AS nt
  FROM beside b JOIN whole w USING (section, reference, dim)),
ch AS (SELECT *, sum(nt) OVER w AS tt, coalesce(sum(nt) FILTER (WHERE nt < 10) OVER w, 0) AS sm,
  row_number() OVER (PARTITION BY section, territory, reference, dim ORDER BY CASE WHEN nt >= 10 THEN 0 ELSE 1 END, nt, item) AS rn
  FROM al WHERE nt > 0 OR item <> '(rest)' WINDOW w AS (PARTITION BY section, territory, reference, dim)),
st2 AS (SELECT *, CASE WHEN nt <= 0 THEN 'zero' WHEN tt < 10 THEN 'hidden' WHEN item = '(rest)' OR nt < 10 OR (sm > 0 AND sm < 10 AND rn = 1) THEN 'other' ELSE 'published' END AS s FROM ch),
ot AS (SELECT section, territory, reference, dim, sum(nt) AS other_there FROM st2 WHERE s = 'other' GROUP BY 1, 2, 3, 4),
fin AS (SELECT section, territory, reference, dim, item, n, CASE WHEN s = 'published' THEN nt END AS nt, total, total_there FROM st2
    JOIN beside USING (section, territory, reference, dim) LEFT JOIN whole USING (section, reference, dim) WHERE item <> '(rest)'
  UNION ALL SELECT section, territory, reference, dim, '(other)', nullif(other, 0), other_there, total, total_there FROM beside
    LEFT JOIN whole USING (section, reference, dim) LEFT JOIN ot USING (section, territory, reference, dim) WHERE other > 0 OR other_there > 0)
SELECT section, territory, reference, dim, item, round(100.0 * n / total, 1) AS share, round(100.0 * nt / total_there, 1) AS share_reference,
  round(round(100.0 * n / total, 1) - round(100.0 * nt / total_there, 1), 1) AS difference FROM fin"""


@registered(SQL_REGIONAL)
def regional_benchmark(spark: SparkSession, sf: str) -> DataFrame:
    """Structure of every region and district beside the state and two chosen regions."""
    return S.benchmark_regions(structure(spark, sf), ["section"], T.places(territories(spark, sf)), CHOSEN)[0]


# --- dynamics --------------------------------------------------------------------------------------

SQL_FLOW = f"""
WITH {SQL_SUBJECTS}, {SQL_TERRITORY}, years AS (SELECT unnest([1998, 1999, 2000, 2001]) AS year),
po AS (SELECT section, level, territory, greatest(coalesce(year(founded), 0), 1997) AS born, year(closed) AS ended, closed,
         CASE WHEN zpzan IN ('01', '04') THEN zpzan ELSE 'jiny' END AS mode,
         strftime(closed, '%m%d') <= '0801' AS comparable
       FROM subj JOIN bridge USING (district)
       WHERE forma NOT IN ('101', '105', '424') AND (closed IS NULL OR year(closed) >= 1998)),
flow AS (SELECT section, level, territory, year,
  count(*) FILTER (WHERE born < year AND (closed IS NULL OR ended >= year)) AS stock,
  count(*) FILTER (WHERE born = year) AS born,
  count(*) FILTER (WHERE ended = year AND mode = '04') AS closed_04,
  count(*) FILTER (WHERE ended = year AND mode = '01') AS closed_01,
  count(*) FILTER (WHERE ended = year AND mode = 'jiny') AS closed_jiny,
  count(*) FILTER (WHERE ended = year AND comparable AND mode = '04') AS period_04,
  count(*) FILTER (WHERE ended = year AND comparable AND mode = '01') AS period_01,
  count(*) FILTER (WHERE ended = year AND comparable AND mode = 'jiny') AS period_jiny,
  count(*) FILTER (WHERE ended = year) AS closed, count(*) FILTER (WHERE ended = year AND comparable) AS period,
  count(*) FILTER (WHERE closed IS NULL) AS now
  FROM po CROSS JOIN years GROUP BY 1, 2, 3, 4)
"""


def flows(spark: SparkSession, sf: str) -> DataFrame:
    lives = Y.life_counts(subjects(spark, sf), ["section"], day(), FIRST)
    return Y.stock_and_flow(lives, ["section"], FIRST, LAST)


@registered(SQL_FLOW + """SELECT *, coalesce(lead(stock) OVER (PARTITION BY section, level, territory ORDER BY year), now)
= stock - closed + born AS identity_holds FROM flow""")
def stock_flow(spark: SparkSession, sf: str) -> DataFrame:
    return flows(spark, sf)


SQL_RATES = """SELECT section, level, territory, year, stock, closed, period,
CASE WHEN year < 2001 THEN round(100.0 * closed / nullif(stock, 0), 2) END AS rate,
round(100.0 * period / nullif(stock, 0), 2) AS rate_period,
CASE WHEN year < 2001 THEN round(100.0 * (closed - closed_04) / nullif(stock, 0), 2) END AS rate_without_04,
round(100.0 * (period - period_04) / nullif(stock, 0), 2) AS rate_period_without_04"""


@registered(SQL_FLOW + SQL_RATES + " FROM flow")
def closure_rate(spark: SparkSession, sf: str) -> DataFrame:
    return Y.closure_rates(flows(spark, sf), ["section"], LAST)


def others_flows(spark: SparkSession, sf: str) -> DataFrame:
    measures = ["stock", "born", "closed", "period", "closed_04", "period_04"]
    return Y.others(flows(spark, sf), "section", measures)


@registered(SQL_FLOW + """, tot AS (SELECT level, territory, year, sum(stock) s, sum(closed) c, sum(period) p, sum(closed_04) c4,
sum(period_04) p4 FROM flow GROUP BY 1, 2, 3),
o AS (SELECT section, level, territory, year, CAST(s - stock AS BIGINT) AS stock, CAST(c - closed AS BIGINT) AS closed,
CAST(p - period AS BIGINT) AS period, CAST(c4 - closed_04 AS BIGINT) AS closed_04, CAST(p4 - period_04 AS BIGINT) AS period_04
FROM flow JOIN tot USING (level, territory, year)) """ + SQL_RATES + " FROM o")
def others_rate(spark: SparkSession, sf: str) -> DataFrame:
    return Y.closure_rates(others_flows(spark, sf), ["section"], LAST)


SQL_VISIBLE = SQL_FLOW + """,
v AS (SELECT *, closed >= 10 AS show_closed,
  CASE WHEN year < 2001 THEN period >= 10 AND (closed < 10 OR closed - period >= 10) ELSE closed >= 10 END AS show_period FROM flow),
s01 AS (SELECT *, stock >= 10 AND NOT (now >= 10 AND show_closed AND born < 10) AS show_stock FROM v WHERE year = 2001),
s00 AS (SELECT v.*, v.stock >= 10 AND NOT (n.show_stock AND v.show_closed AND v.born < 10) AS show_stock
        FROM v JOIN s01 n USING (section, level, territory) WHERE v.year = 2000),
s99 AS (SELECT v.*, v.stock >= 10 AND NOT (n.show_stock AND v.show_closed AND v.born < 10) AS show_stock
        FROM v JOIN s00 n USING (section, level, territory) WHERE v.year = 1999),
s98 AS (SELECT v.*, v.stock >= 10 AND NOT (n.show_stock AND v.show_closed AND v.born < 10) AS show_stock
        FROM v JOIN s99 n USING (section, level, territory) WHERE v.year = 1998),
vis AS (SELECT * FROM s01 UNION ALL SELECT * FROM s00 UNION ALL SELECT * FROM s99 UNION ALL SELECT * FROM s98)
"""


@registered(SQL_VISIBLE + "SELECT section, level, territory, year, show_stock, show_closed, show_period FROM vis")
def rate_visibility(spark: SparkSession, sf: str) -> DataFrame:
    return Y.rate_visibility(flows(spark, sf), ["section"], "now", LAST).select(
        "section", "level", "territory", "year", "show_stock", "show_closed", "show_period"
    )


@registered(SQL_VISIBLE + """, m AS (SELECT *, show_closed AND closed_04 >= 10 AND closed - closed_04 >= 10 AS show_mode FROM vis)
SELECT section, level, territory, year, closed,
CASE WHEN show_mode THEN closed_04 END AS closed_04, CASE WHEN show_mode THEN closed - closed_04 END AS closed_without_04,
CASE WHEN show_mode AND closed_01 >= 10 AND closed_jiny >= 10 THEN closed_01 END AS closed_01,
CASE WHEN show_mode AND closed_01 >= 10 AND closed_jiny >= 10 THEN closed_jiny END AS closed_jiny,
CASE WHEN show_mode THEN round(100.0 * closed_04 / closed, 1) END AS share_04,
CASE WHEN year < 2001 THEN show_period AND least(period_04, period - period_04) >= 10
     AND (NOT show_mode OR least(closed_04 - period_04, (closed - closed_04) - (period - period_04)) >= 10)
     ELSE show_mode END AS show_mode_period,
CASE WHEN NOT show_mode AND closed_04 >= 10 AND closed - closed_04 < 10 THEN 'aspoň'
     WHEN NOT show_mode AND closed_04 < 10 AND closed - closed_04 >= 10 THEN 'nejvýš' END AS bound_kind,
CASE WHEN NOT show_mode AND closed_04 >= 10 AND closed - closed_04 < 10 THEN CAST(floor(100 * (closed - 9) / closed) AS BIGINT)
     WHEN NOT show_mode AND closed_04 < 10 AND closed - closed_04 >= 10 THEN CAST(ceil(900 / closed) AS BIGINT) END AS bound_value
FROM m WHERE show_closed""")
def closure_by_mode(spark: SparkSession, sf: str) -> DataFrame:
    from regisight.functions.numbers import pct, share_bound

    v = Y.mode_visibility(Y.rate_visibility(flows(spark, sf), ["section"], "now", LAST), LAST).filter("show_closed")
    c = F.col
    without = c("closed") - c("closed_04")
    bound = F.when(~c("show_mode"), share_bound(c("closed_04"), c("closed"), X.MIN_CELL))
    return v.select(
        "section", "level", "territory", "year", "closed",
        F.when(c("show_mode"), c("closed_04")).alias("closed_04"), F.when(c("show_mode"), without).alias("closed_without_04"),
        F.when(c("show_mode_fine"), c("closed_01")).alias("closed_01"),
        F.when(c("show_mode_fine"), c("closed_jiny")).alias("closed_jiny"),
        F.when(c("show_mode"), pct(c("closed_04"), c("closed"), 1)).alias("share_04"), "show_mode_period",
        bound["kind"].alias("bound_kind"), bound["value"].alias("bound_value"),
    )


# --- scope, reliability, activity ------------------------------------------------------------------

SQL_SCOPE = f"""
WITH {SQL_SUBJECTS}, {SQL_TERRITORY},
ind AS (SELECT section, division AS industry, district FROM subj WHERE closed IS NULL
        UNION ALL SELECT section, section, district FROM subj WHERE closed IS NULL),
c AS (SELECT section, industry, level, territory, parent, count(*) AS n FROM ind JOIN bridge USING (district) GROUP BY ALL)
"""


def scope_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of divisions and of whole sections in every territory."""
    base = living(spark, sf).groupBy("section", "division", "district", "region").agg(F.count(F.lit(1)).alias("n"))
    both = base.withColumn("industry", F.explode(F.array("division", "section")))
    return T.roll_up(both, ["section", "industry"], ["n"])


@registered(SQL_SCOPE + """
SELECT c.section, c.industry, c.level, c.territory, c.n, c.n < 100 AS refused,
  CASE WHEN c.n < 100 THEN concat_ws(';',
    CASE WHEN c.level = 'OKRES' AND p.n IS NOT NULL THEN c.industry || '/' || c.parent || '=' || p.n END,
    CASE WHEN c.industry <> c.section AND s.n IS NOT NULL THEN c.section || '/' || c.territory || '=' || s.n END,
    CASE WHEN c.industry <> c.section AND c.level = 'OKRES' AND q.n IS NOT NULL THEN c.section || '/' || c.parent || '=' || q.n END)
  END AS options
FROM c LEFT JOIN c p ON p.level = 'KRAJ' AND p.industry = c.industry AND p.territory = c.parent
LEFT JOIN c s ON s.industry = c.section AND s.level = c.level AND s.territory = c.territory
LEFT JOIN c q ON q.level = 'KRAJ' AND q.industry = c.section AND q.territory = c.parent""")
def minimum_scope(spark: SparkSession, sf: str) -> DataFrame:
    r = I.scope_check(scope_cells(spark, sf))
    text = F.transform("options", lambda o: F.concat(o["industry"], F.lit("/"), o["territory"], F.lit("="), o["n"].cast("string")))
    return r.withColumn("options", F.array_join(text, ";"))


@registered(SQL_SCOPE + """, only_s AS (
  SELECT section, level, territory, count(*) AS k FROM subj JOIN bridge USING (district)
  WHERE closed IS NULL AND katpo = '000' GROUP BY ALL)
SELECT c.section, c.industry, c.level, c.territory, c.n, coalesce(k, 0) AS n_only_section,
  round(100.0 * coalesce(k, 0) / c.n, 1) AS share_only_section, round(100.0 * coalesce(k, 0) / c.n, 1) > 25 AS unreliable
FROM c LEFT JOIN only_s USING (section, level, territory) WHERE c.industry <> c.section""")
def reliability_warning(spark: SparkSession, sf: str) -> DataFrame:
    only = T.count_by_territory(living(spark, sf).filter(F.col("katpo") == "000"), ["section"], "n_only_section")
    cells = scope_cells(spark, sf).filter(F.col("industry") != F.col("section")).drop("parent")
    return I.reliability(cells, only.drop("parent"), ["section", "industry"])


@registered(f"""WITH {SQL_SUBJECTS}
SELECT section, region, round(100.0 * count(*) FILTER (WHERE closed IS NULL) / count(*), 1) AS activity_share
FROM subj GROUP BY 1, 2""")
def activity_share(spark: SparkSession, sf: str) -> DataFrame:
    p = subjects(spark, sf).groupBy("section", "region").agg(
        F.count_if(F.col("closed").isNull()).alias("active"), F.count(F.lit(1)).alias("registered")
    )
    return I.activity_share(p, ["section", "region"])


SQL_ANNUAL = f"""WITH {SQL_SUBJECTS},
q AS (SELECT region, year(founded) || '-Q' || quarter(founded) AS period,
        CASE WHEN forma IN ('101', '105', '424') THEN 'FO' ELSE 'PO' END AS person, count(*) AS n
      FROM subj WHERE founded IS NOT NULL GROUP BY 1, 2, 3)
SELECT region, CAST(substr(period, 1, 4) AS INTEGER) AS year, CAST(sum(n) AS BIGINT) AS total,
  CAST(sum(n) FILTER (WHERE person = 'FO') AS BIGINT) AS "FO", CAST(sum(n) FILTER (WHERE person = 'PO') AS BIGINT) AS "PO", true AS ok
FROM q GROUP BY 1, 2"""


@registered(SQL_ANNUAL)
def annual_sums(spark: SparkSession, sf: str) -> DataFrame:
    """Quarterly births by person type, summed per year; the published total is the sum of both."""
    person = person_type(F.col("forma"))
    q = subjects(spark, sf).filter(F.col("founded").isNotNull()).select(
        "region", F.concat(F.year("founded"), F.lit("-Q"), F.quarter("founded")).alias("period"),
        F.explode(F.array(person, F.lit("total"))).alias("person"),
    ).groupBy("region", "period", "person").agg(F.count(F.lit(1)).alias("value"))
    return Y.yearly_sums(q, ["region"])


@registered(SQL_STRUCTURE + f""",
cell AS (SELECT section, level, territory, parent, n FROM (
   SELECT section, b.level, b.territory, b.parent, count(*) AS n FROM p JOIN bridge b USING (district) GROUP BY ALL)),
stt AS (SELECT section, n >= 10 AS state_ok FROM cell WHERE level = 'CR'),
lv AS (SELECT c.*, sum(n) OVER w AS total, coalesce(sum(n) FILTER (WHERE n < 10) OVER w, 0) AS small,
        row_number() OVER (PARTITION BY section, level, parent ORDER BY CASE WHEN n >= 10 THEN 0 ELSE 1 END, n, territory) AS rn
       FROM cell c WHERE level <> 'CR' WINDOW w AS (PARTITION BY section, level, parent)),
basic AS (SELECT section, level, territory, parent,
        total >= 10 AND n >= 10 AND NOT (small > 0 AND small < 10 AND rn = 1) AS own_ok FROM lv),
reg AS (SELECT b.section, b.territory, own_ok AND state_ok AS visible FROM basic b JOIN stt USING (section) WHERE level = 'KRAJ'),
vis AS (SELECT section, 'CR' AS level, 'CZ' AS territory, state_ok AS visible FROM stt
   UNION ALL SELECT section, 'KRAJ', territory, visible FROM reg
   UNION ALL SELECT b.section, 'OKRES', b.territory, b.own_ok AND coalesce(r.visible, false)
     FROM basic b LEFT JOIN reg r ON r.section = b.section AND r.territory = b.parent WHERE b.level = 'OKRES'),
fp AS (SELECT section, level, territory, min(n) >= 10 AS ok FROM st WHERE dim = 'fopo' GROUP BY 1, 2, 3),
gate AS (SELECT v.*, coalesce(fp.ok, false) AND visible AS fopo_ok FROM vis v LEFT JOIN fp USING (section, level, territory)),
d AS (SELECT st.section, st.level, st.territory, CASE WHEN dim LIKE 'forma:%' AND NOT fopo_ok THEN 'forma' ELSE dim END AS breakdown,
        dim, item, n, NOT visible OR ((dim LIKE 'vel:%' OR dim = 'fopo') AND NOT fopo_ok) AS hide
      FROM st JOIN gate USING (section, level, territory)),
r AS (SELECT *, sum(n) OVER w AS total, coalesce(sum(n) FILTER (WHERE n < 10) OVER w, 0) AS small, bool_or(hide) OVER w AS gone,
        row_number() OVER (PARTITION BY section, level, territory, breakdown ORDER BY CASE WHEN n >= 10 THEN 0 ELSE 1 END, n, item) AS rn
      FROM d WINDOW w AS (PARTITION BY section, level, territory, breakdown))
SELECT section, level, territory, breakdown, dim, item, n,
  CASE WHEN total < 10 OR gone THEN 'hidden' WHEN n < 10 THEN 'other'
       WHEN small > 0 AND small < 10 AND rn = 1 THEN 'other' ELSE 'published' END AS status,
  NOT (total < 10 OR gone) AND n >= 10 AND small > 0 AND small < 10 AND rn = 1 AS secondary
FROM r""")
def cascade_visibility(spark: SparkSession, sf: str) -> DataFrame:
    from regisight.operators.disclosure import cascade

    cells = materialise(T.count_by_territory(living(spark, sf), ["section"]), "cube")
    return cascade(cells, structure(spark, sf), ["section"])
