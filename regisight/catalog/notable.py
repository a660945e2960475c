"""Findings over indicators, rates, wages and accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regisight.catalog import ORACLE, registered
from regisight.catalog import economy, regional, snapshot
from regisight.operators import dynamics as Y
from regisight.operators import findings as K
from regisight.operators import series as S
from regisight.session import materialise

SHOWN = ["section", "territory", "kind", "subtype", "value", "reference", "strength", "difference_pct", "direction"]


def _sql_found(kind: str, subtype: str, a: str, b: str, source: str, strength: str | None = None) -> str:
    """SQL of one comparison with the 3 % rule."""
    s = strength or f"abs({a} / {b} - 1)"
    pct = "NULL" if strength else f"round(abs(100 * ({a} / {b} - 1)), 1)"
    way = "NULL" if strength else f"CASE WHEN {a} / {b} - 1 > 0 THEN 'vyšší' ELSE 'nižší' END"
    return (f"SELECT section, territory, '{kind}' AS kind, {subtype} AS subtype, CAST({a} AS DOUBLE) AS value, CAST({b} AS DOUBLE) AS reference, "
            f"round({s}, 4) AS strength, CAST({pct} AS DOUBLE) AS difference_pct, CAST({way} AS VARCHAR) AS direction "
            f"FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL AND {b} <> 0 AND {s} >= 0.03")


def stored_indicators(spark: SparkSession, sf: str) -> DataFrame:
    return materialise(regional.indicator_cells(spark, sf), "indicators")


def indicator_pairs(cells: DataFrame) -> DataFrame:
    """Indicators of regions and districts beside those of the state."""
    state = cells.filter(F.col("level") == "CR").select(
        "section", F.col("lq").alias("lq_state"), F.col("density").alias("density_state"))
    return cells.filter(F.col("level") != "CR").join(state, "section")


SQL_PAIRS = regional.SQL_CELLS + """, pr AS (SELECT i.*, s.lq AS lq_state, s.density AS density_state FROM ind i
JOIN ind s ON s.section = i.section AND s.level = 'CR' WHERE i.level <> 'CR')"""


@registered(SQL_PAIRS + _sql_found("odchylka_od_cr", "'LQ'", "lq", "lq_state", "pr") + " UNION ALL "
            + _sql_found("odchylka_od_cr", "'hustota'", "density", "density_state", "pr"))
def findings_deviation(spark: SparkSession, sf: str) -> DataFrame:
    return K.deviation_from_state(indicator_pairs(stored_indicators(spark, sf)), ["section", "territory"]).select(*SHOWN)


@registered(snapshot.SQL_BENCH.replace("SELECT *, round(share - share_state, 1) AS difference FROM sh", "") + ", big AS (SELECT * FROM sh WHERE item <> '(other)' AND (share >= 5 OR share_state >= 5)) "
            + _sql_found("odchylka_od_cr", "'struktura: ' || dim", "share", "share_state", "big"))
def findings_structure(spark: SparkSession, sf: str) -> DataFrame:
    return K.structure_deviation(snapshot.structure_benchmark(spark, sf), ["section", "territory"]).select(*SHOWN)


SQL_RT = snapshot.SQL_FLOW + """,
rt AS (SELECT section, territory, year, CASE WHEN year < 2001 THEN round(100.0 * closed / nullif(stock, 0), 2) END AS rate FROM flow),
tt AS (SELECT territory, year, sum(stock) AS s, sum(closed) AS c FROM flow GROUP BY 1, 2),
ot AS (SELECT section, territory, year, CASE WHEN year < 2001 THEN round(100.0 * (c - closed) / nullif(s - stock, 0), 2) END AS o
  FROM flow JOIN tt USING (territory, year)),
r2 AS (SELECT *, max(year) OVER p AS ly, min(year) OVER p AS fy, count(*) OVER p AS n FROM rt WHERE rate IS NOT NULL WINDOW p AS (PARTITION BY section, territory)),
r3 AS (SELECT r2.*, ot.o FROM r2 LEFT JOIN ot USING (section, territory, year)),
ow AS (SELECT section, territory, max(ly) AS ly, min(fy) AS fy, max(n) AS n, max(rate) FILTER (WHERE year = ly) AS a, max(rate) FILTER (WHERE year = fy) AS f,
   CASE WHEN count(*) > 1 THEN floor((2 * sum(CAST(round(rate * 100) AS BIGINT)) FILTER (WHERE year < ly) + count(*) FILTER (WHERE year < ly)) / (2 * count(*) FILTER (WHERE year < ly))) / 100.0 END AS m, max(o) FILTER (WHERE year = ly) AS oa, max(o) FILTER (WHERE year = fy) AS of,
   CASE WHEN count(*) = count(o) AND count(*) > 1 THEN floor((2 * sum(CAST(round(o * 100) AS BIGINT)) FILTER (WHERE year < ly) + count(*) FILTER (WHERE year < ly)) / (2 * count(*) FILTER (WHERE year < ly))) / 100.0 END AS om FROM r3 GROUP BY 1, 2),
jn AS (SELECT ow.*, sl.rate AS s, s0.rate AS sf, ol.o AS os, o0.o AS osf FROM ow
  LEFT JOIN rt sl ON sl.section = ow.section AND sl.territory = 'CZ' AND sl.year = ow.ly
  LEFT JOIN rt s0 ON s0.section = ow.section AND s0.territory = 'CZ' AND s0.year = ow.fy
  LEFT JOIN ot ol ON ol.section = ow.section AND ol.territory = 'CZ' AND ol.year = ow.ly
  LEFT JOIN ot o0 ON o0.section = ow.section AND o0.territory = 'CZ' AND o0.year = ow.fy),
ix AS (SELECT *, CASE WHEN n > 1 AND f <> 0 THEN round(a / f, 2) END AS i, CASE WHEN n > 1 AND s <> 0 AND sf <> 0 THEN round(s / sf, 2) END AS si,
   CASE WHEN oa <> 0 AND of <> 0 AND os <> 0 AND osf <> 0 THEN round(oa / of, 2) END AS oi,
   CASE WHEN oa <> 0 AND of <> 0 AND os <> 0 AND osf <> 0 THEN round(os / osf, 2) END AS osi FROM jn),
k AS (SELECT section, territory, 'poslední rok proti předchozím' AS t, a AS v, m AS b, oa AS ov, om AS ob FROM ix
  UNION ALL SELECT section, territory, 'proti ČR', a, s, oa, os FROM ix WHERE territory <> 'CZ'
  UNION ALL SELECT section, territory, 'vývoj proti ČR', i, si, oi, osi FROM ix WHERE territory <> 'CZ'),
e AS (SELECT section, territory, 'míra zániku PO za rok: ' || t AS subtype, v AS value, b AS reference, v / b - 1 AS r, CASE WHEN ob <> 0 THEN ov / ob - 1 END AS ro
  FROM k WHERE v IS NOT NULL AND b IS NOT NULL AND b <> 0 AND abs(v / b - 1) >= 0.03),
tr AS (SELECT *, coalesce(r * ro > 0 AND abs(ro) >= 0.03 AND abs(ro) >= 0.5 * abs(r), false) AS territory_effect FROM e)
"""


def trend_findings(spark: SparkSession, sf: str) -> DataFrame:
    series = Y.rates_beside_others(snapshot.flows(spark, sf), "section", snapshot.LAST)
    return K.trend_changes(series, ["section"], "rate", "other_rate", "za rok")


@registered(SQL_RT + """SELECT section, territory, subtype, value, reference, round(abs(r), 4) AS original, round(abs(100 * r), 1) AS difference_pct FROM tr""")
def findings_trend(spark: SparkSession, sf: str) -> DataFrame:
    f = trend_findings(spark, sf)
    return f.select("section", "territory", "subtype", "value", "reference",
                    F.coalesce("original_strength", "strength").alias("original"), "difference_pct")


PERIOD = "za období do 1. 8."
SQL_RT_PERIOD = SQL_RT.replace("CASE WHEN year < 2001 THEN round(100.0 * closed / nullif(stock, 0), 2) END AS rate", "round(100.0 * period / nullif(stock, 0), 2) AS rate").replace(
    "sum(closed) AS c", "sum(period) AS c").replace("CASE WHEN year < 2001 THEN round(100.0 * (c - closed) / nullif(s - stock, 0), 2) END AS o", "round(100.0 * (c - period) / nullif(s - stock, 0), 2) AS o").replace(
    "míra zániku PO za rok: ", f"míra zániku PO {PERIOD}: ")


@registered(SQL_RT_PERIOD + """SELECT section, territory, subtype, value, reference, round(abs(r), 4) AS original, round(abs(100 * r), 1) AS difference_pct, territory_effect FROM tr""")
def findings_trend_period(spark: SparkSession, sf: str) -> DataFrame:
    """The same trend over the part of each year that the last one has too."""
    series = Y.rates_beside_others(snapshot.flows(spark, sf), "section", snapshot.LAST, measure="period")
    return K.trend_changes(series, ["section"], "rate", "other_rate", PERIOD).select(
        "section", "territory", "subtype", "value", "reference", F.coalesce("original_strength", "strength").alias("original"), "difference_pct", "territory_effect")


@registered(SQL_RT + """SELECT section, territory, subtype, territory_effect, round(abs(100 * ro), 1) AS others_difference_pct,
CASE WHEN territory_effect AND 1 + ro <> 0 THEN round(least(round(abs(r), 4), abs((1 + r) / (1 + ro) - 1)), 4) ELSE round(abs(r), 4) END AS strength FROM tr""")
def findings_territory_effect(spark: SparkSession, sf: str) -> DataFrame:
    return trend_findings(spark, sf).select("section", "territory", "subtype", "territory_effect", "others_difference_pct", "strength")


def district_density(spark: SparkSession, sf: str) -> DataFrame:
    cells = stored_indicators(spark, sf).select("section", "level", "territory", "parent", "density")
    region = cells.filter(F.col("level") == "KRAJ").select(
        "section", F.col("territory").alias("region"), F.col("density").alias("density_region"))
    state = cells.filter(F.col("level") == "CR").select("section", F.col("density").alias("density_state"))
    return cells.filter(F.col("level") == "OKRES").select(
        "section", F.col("parent").alias("region"), F.col("territory").alias("district"), "density"
    ).join(region, ["section", "region"]).join(state, "section")


SQL_DENS = regional.SQL_CELLS + """, dd AS (SELECT d.section, d.parent AS territory, d.territory AS district, d.density, r.density AS dr, s.density AS ds
FROM ind d JOIN ind r ON r.section = d.section AND r.level = 'KRAJ' AND r.territory = d.parent
JOIN ind s ON s.section = d.section AND s.level = 'CR' WHERE d.level = 'OKRES'),
ends AS (SELECT section, territory, max(density) AS hi, min(density) AS lo FROM dd WHERE density IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 2)"""


@registered(SQL_DENS + _sql_found("rozdily_uvnitr_uzemi", "'hustota okresu proti kraji'", "density", "dr", "dd") + " UNION ALL "
            + _sql_found("rozdily_uvnitr_uzemi", "'hustota okresu proti ČR'", "density", "ds", "dd") + " UNION ALL "
            + _sql_found("rozdily_uvnitr_uzemi", "'rozpětí hustoty mezi okresy'", "hi", "lo", "ends"))
def findings_inside(spark: SparkSession, sf: str) -> DataFrame:
    return K.inside_differences(materialise(district_density(spark, sf), "density"), ["section"]).select(*SHOWN)


def activity_pairs(spark: SparkSession, sf: str) -> DataFrame:
    counts = snapshot.subjects(spark, sf).groupBy("section", "region").agg(
        F.count_if(F.col("closed").isNull()).alias("a"), F.count(F.lit(1)).alias("b"))
    everything = counts.groupBy("region").agg(F.round(100.0 * F.sum("a") / F.sum("b"), 1).alias("share_all"))
    return counts.select("section", "region", F.round(100.0 * F.col("a") / F.col("b"), 1).alias("share")).join(
        everything, "region").withColumnRenamed("region", "territory")


@registered(f"""WITH {snapshot.SQL_SUBJECTS}, c AS (SELECT section, region AS territory, round(100.0 * count(*) FILTER (WHERE closed IS NULL) / count(*), 1) AS share
FROM subj GROUP BY 1, 2), a AS (SELECT region AS territory, round(100.0 * count(*) FILTER (WHERE closed IS NULL) / count(*), 1) AS share_all FROM subj GROUP BY 1),
p AS (SELECT * FROM c JOIN a USING (territory)) """
            + _sql_found("aktivita_oboru", "'podíl se zjištěnou aktivitou: sekce proti všem oborům'", "share", "share_all", "p"))
def findings_activity(spark: SparkSession, sf: str) -> DataFrame:
    return K.activity_deviation(activity_pairs(spark, sf), ["section", "territory"]).select(*SHOWN)


def divergence(indicators: DataFrame) -> DataFrame:
    cells = indicators.filter(F.col("level") != "CR")
    peers = cells.groupBy("section", "level", "parent").agg(F.count(F.lit(1)).alias("peers"))
    r = cells.join(peers, ["section", "level", "parent"]).withColumn("place", F.col("territory"))
    regions = K.rank_divergence(r.filter(F.col("level") == "KRAJ"), ["section", "territory"], "kraj mezi kraji", True, "T03_kraje")
    districts = K.rank_divergence(r.filter(F.col("level") == "OKRES").withColumn("territory", F.col("parent")),
                                  ["section", "territory"], "okres mezi okresy kraje", False, "T04_okresy")
    return regions.unionByName(districts)


SQL_RANK = regional.SQL_CELLS + """, rk AS (SELECT section, level, territory AS place, parent, rank_count AS p1, rank_density AS p2,
count(*) OVER (PARTITION BY section, level, parent) AS n FROM ind WHERE level <> 'CR'),
rr AS (SELECT section, place AS territory, p1, p2, n FROM rk WHERE level = 'KRAJ' AND n >= 3),
dr AS (SELECT section, parent AS territory, p1, p2, n FROM rk WHERE level = 'OKRES' AND n >= 3 AND abs(p1 - p2) >= 2)"""


@registered(SQL_RANK + _sql_found("divergence_poradi", "'kraj mezi kraji'", "p1", "p2", "rr", "abs(p1 - p2) / (n - 1)") + " UNION ALL "
            + _sql_found("divergence_poradi", "'okres mezi okresy kraje'", "p1", "p2", "dr", "abs(p1 - p2) / (n - 1)"))
def findings_rank(spark: SparkSession, sf: str) -> DataFrame:
    return divergence(stored_indicators(spark, sf)).select(*SHOWN)


WAGE_MEASURES = [("wage", "průměrná mzda v oboru proti ČR"), ("wage_index_territory", "mzda v oboru proti všem odvětvím území, kraj proti ČR"),
                 ("employees_share_territory", "podíl oboru na zaměstnancích, kraj proti ČR")]


def wage_findings(spark: SparkSession, sf: str) -> DataFrame:
    w = materialise(S.wage_table(economy.wages(spark, sf)), "wage-table").withColumnRenamed("nace", "section")
    last = w.groupBy("section").agg(F.max("year").alias("year"))
    now = w.join(last, ["section", "year"])
    state = now.filter(F.col("territory") == "CZ").select("section", *[F.col(m).alias(f"{m}_state") for m, _ in WAGE_MEASURES])
    rows = now.filter(F.col("territory") != "CZ").join(state, "section")
    return K.published_deviation(rows, ["section", "territory"], "mzdy_zamestnanost", WAGE_MEASURES, "T20_mzdy_obor")


SQL_WG = economy.SQL_WAGES + """, t AS (SELECT a.territory, a.nace AS section, round(a.w, 0) AS wage, round(100.0 * a.w / x.w, 1) AS wi,
round(100.0 * a.e / x.e, 2) AS es FROM w a JOIN mx ON a.year = y JOIN w x ON x.nace = '0' AND x.territory = a.territory AND x.year = a.year WHERE a.nace <> '0'),
p AS (SELECT t.*, s.wage AS s1, s.wi AS s2, s.es AS s3 FROM t JOIN t s ON s.section = t.section AND s.territory = 'CZ' WHERE t.territory <> 'CZ')"""


@registered(SQL_WG + " UNION ALL ".join(_sql_found("mzdy_zamestnanost", f"'{label}'", col, f"s{i}", "p")
                                       for i, (col, (_, label)) in enumerate(zip(("wage", "wi", "es"), WAGE_MEASURES), 1)))
def findings_wages(spark: SparkSession, sf: str) -> DataFrame:
    return wage_findings(spark, sf).select(*SHOWN)


ACCOUNT_MEASURES = [("productivity", "produktivita (HPH na zaměstnaného) proti ČR"), ("gva_share_territory", "podíl skupiny na HPH území proti ČR"),
                    ("self_employed_share", "podíl sebezaměstnaných proti ČR"), ("volume_index", "objemový vývoj HPH proti ČR")]


def account_findings(spark: SparkSession, sf: str) -> DataFrame:
    a = materialise(S.accounts_table(economy.accounts(spark, sf)), "account-table").withColumnRenamed("nace", "section").withColumnRenamed("geo", "territory")
    last = a.groupBy("section").agg(F.max("year").alias("year"))
    now = a.join(last, ["section", "year"]).filter(F.length("territory") == 2)
    state = now.filter(F.col("territory") == "CZ").select("section", *[F.col(m).alias(f"{m}_state") for m, _ in ACCOUNT_MEASURES])
    rows = now.filter(F.col("territory") != "CZ").join(state, "section")
    return K.published_deviation(rows, ["section", "territory"], "ekonomika", ACCOUNT_MEASURES, "T22_ekonomika")


SQL_AC = economy.SQL_ACCOUNTS + """, t AS (SELECT geo AS territory, nace AS section, * FROM acc JOIN (SELECT nace AS nn, max(year) AS yy FROM acc GROUP BY 1) ON nace = nn AND year = yy WHERE length(geo) = 2),
p AS (SELECT t.*, s.productivity AS s1, s.gva_share_territory AS s2, s.self_employed_share AS s3, s.volume_index AS s4
FROM t JOIN t s ON s.section = t.section AND s.territory = 'CZ' WHERE t.territory <> 'CZ')"""


@registered(SQL_AC + " UNION ALL ".join(_sql_found("ekonomika", f"'{label}'", col, f"s{i}", "p") for i, (col, label) in enumerate(ACCOUNT_MEASURES, 1)))
def findings_economy(spark: SparkSession, sf: str) -> DataFrame:
    return account_findings(spark, sf).select(*SHOWN)


GROWTH_MEASURES = [("wage", "vývoj: průměrná mzda proti ČR"), ("employees", "vývoj: počet zaměstnanců proti ČR")]
SQL_GROWTH = economy.SQL_WAGES + """, t AS (SELECT territory, nace AS section, year, round(e, 1) AS employees, round(w, 0) AS wage FROM w JOIN mx ON year > y - 5 WHERE nace <> '0'),
g AS (SELECT section, territory, min(year) AS y0, max(year) AS y1, arg_min(employees, year) AS e0, arg_max(employees, year) AS e1,
  arg_min(wage, year) AS w0, arg_max(wage, year) AS w1 FROM t GROUP BY 1, 2),
p AS (SELECT g.section, g.territory, CASE WHEN g.w0 <> 0 AND g.w1 <> 0 AND s.w0 <> 0 AND s.w1 <> 0 THEN round(g.w1 / g.w0, 2) END AS a1,
  CASE WHEN g.w0 <> 0 AND g.w1 <> 0 AND s.w0 <> 0 AND s.w1 <> 0 THEN round(s.w1 / s.w0, 2) END AS b1,
  CASE WHEN g.e0 <> 0 AND g.e1 <> 0 AND s.e0 <> 0 AND s.e1 <> 0 THEN round(g.e1 / g.e0, 2) END AS a2,
  CASE WHEN g.e0 <> 0 AND g.e1 <> 0 AND s.e0 <> 0 AND s.e1 <> 0 THEN round(s.e1 / s.e0, 2) END AS b2
  FROM g JOIN g s ON s.section = g.section AND s.territory = 'CZ' AND s.y0 = g.y0 AND s.y1 = g.y1 WHERE g.territory <> 'CZ' AND g.y0 < g.y1)"""


@registered(SQL_GROWTH + " UNION ALL ".join(_sql_found("mzdy_zamestnanost", f"'{label}'", f"a{i}", f"b{i}", "p")
                                           for i, (_, label) in enumerate(GROWTH_MEASURES, 1)))
def findings_development(spark: SparkSession, sf: str) -> DataFrame:
    w = materialise(S.wage_table(economy.wages(spark, sf)), "wage-table").withColumnRenamed("nace", "section")
    return K.development(w, ["section"], "mzdy_zamestnanost", GROWTH_MEASURES, "T20_mzdy_obor").select(*SHOWN)


COMPENSATION = [("share", "podíl náhrad zaměstnancům na HPH (region soudržnosti) proti ČR")]


@registered(economy.SQL_ACCOUNTS + """, t AS (SELECT geo AS territory, nace AS section, round(100 * coe / cp, 1) AS share FROM w
  JOIN (SELECT nace AS n2, max(year) AS y2 FROM w GROUP BY 1) ON nace = n2 AND year = y2 WHERE nace <> 'TOTAL' AND length(geo) = 2),
p AS (SELECT t.*, s.share AS b FROM t JOIN t s ON s.section = t.section AND s.territory = 'CZ' WHERE t.territory <> 'CZ') """
            + _sql_found("ekonomika", f"'{COMPENSATION[0][1]}'", "share", "b", "p"))
def findings_compensation(spark: SparkSession, sf: str) -> DataFrame:
    t = materialise(S.compensation_table(economy.accounts(spark, sf), 2), "compensation").withColumnsRenamed({"nace": "section", "geo": "territory"})
    now = t.join(t.groupBy("section").agg(F.max("year").alias("year")), ["section", "year"])
    state = now.filter(F.col("territory") == "CZ").select("section", F.col("share").alias("share_state"))
    rows = now.filter(F.col("territory") != "CZ").join(state, "section")
    return K.published_deviation(rows, ["section", "territory"], "ekonomika", COMPENSATION, "T23_nahrady").select(*SHOWN)


@registered(SQL_RANK.replace(", rk AS", """, pr AS (SELECT i.*, s.lq AS lq_state, s.density AS density_state FROM ind i
JOIN ind s ON s.section = i.section AND s.level = 'CR' WHERE i.level <> 'CR'), rk AS""") + f""",
u AS ({_sql_found("odchylka_od_cr", "'LQ'", "lq", "lq_state", "pr")} UNION ALL {_sql_found("odchylka_od_cr", "'hustota'", "density", "density_state", "pr")}
  UNION ALL {_sql_found("divergence_poradi", "'kraj mezi kraji'", "p1", "p2", "rr", "abs(p1 - p2) / (n - 1)")})
SELECT section, territory, kind, subtype, strength,
  rank() OVER (PARTITION BY section ORDER BY strength DESC, CASE kind WHEN 'odchylka_od_cr' THEN 1 ELSE 5 END, subtype) AS place FROM u""", ints=("place",))
def findings_ranked(spark: SparkSession, sf: str) -> DataFrame:
    """Deviations from the state and divergent ranks of regions by section, in order of strength, kind and subtype; equals
    share a place. findings_all_ranked has all seven kinds."""
    from pyspark.sql import Window

    cells = stored_indicators(spark, sf)
    parts = [K.deviation_from_state(indicator_pairs(cells), ["section", "territory"]),
             divergence(cells).filter(F.col("subtype") == "kraj mezi kraji")]
    full = K.assemble(parts, ["section", "territory"])
    kind = F.array_position(F.array(*[F.lit(k) for k in K.KINDS]), F.col("kind"))
    order = Window.partitionBy("section").orderBy(F.desc("strength"), kind, "subtype")
    return full.select("section", "territory", "kind", "subtype", "strength", F.rank().over(order).alias("place"))


TREND = "zmena_trendu"
ALL_FINDINGS = (findings_deviation, findings_structure, findings_inside, findings_activity, findings_rank, findings_wages, findings_development,
                findings_economy, findings_compensation)
SQL_ALL = " UNION ALL ".join([f"SELECT section, territory, kind, subtype, strength FROM ({ORACLE[f.__name__]})" for f in ALL_FINDINGS]
                             + [f"SELECT section, territory, '{TREND}', subtype, strength FROM ({ORACLE['findings_territory_effect']})"])


@registered(f"""SELECT section, territory, kind, subtype, strength, rank() OVER (PARTITION BY section ORDER BY strength DESC,
CASE kind {" ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(K.KINDS))} END, subtype) AS place FROM ({SQL_ALL})""", ints=("place",))
def findings_all_ranked(spark: SparkSession, sf: str) -> DataFrame:
    """All seven kinds of findings of a section in order of strength, kind and subtype; equals share a place."""
    from pyspark.sql import Window

    shown = ["section", "territory", "kind", "subtype", "strength"]
    full = findings_territory_effect(spark, sf).withColumn("kind", F.lit(TREND)).select(*shown)
    for f in ALL_FINDINGS:
        full = full.unionByName(f(spark, sf).select(*shown))
    kind = F.array_position(F.array(*[F.lit(k) for k in K.KINDS]), F.col("kind"))
    return full.withColumn("place", F.rank().over(Window.partitionBy("section").orderBy(F.desc("strength"), kind, "subtype")))
