"""What is loaded, replaced and read back: code lists, published series, keyed tables, batches, interface, report, findings with ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regisight.catalog import ORACLE, classification, feeds, notable, protection, registered, temporal
from regisight.functions import numbers as N
from regisight.operators import crosswalk as C
from regisight.operators import findings as K
from regisight.operators import history as H
from regisight.operators import reconcile
from regisight.operators import rules as V
from regisight.plans.proxy import SQL_SUBJECTS, subject_id, subjects, table
from regisight.session import work_path
from regisight.sources import codelists as L
from regisight.sources import published as P
from regisight.sources import registry as R
from regisight.sources import report_sink
from regisight.sources import snapshot_csv as S
from regisight.sources import tables as B


# --- code lists ------------------------------------------------------------------------------------

@registered("""SELECT 'okres' AS list, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, n_name AS name, 'R' || n_regionkey AS region, DATE '1990-01-01' + n_nationkey AS valid_from FROM nation
UNION ALL SELECT 'kraj', 'R' || r_regionkey, r_name, NULL, DATE '1990-01-01' FROM region
UNION ALL SELECT 'forma', o_orderpriority, min(lower(o_orderpriority)), NULL, NULL FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 2""")
def code_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Districts with their regions, regions and legal forms, written as published lists and read back."""
    root, none = work_path(spark, "lists"), F.lit(None).cast("string")
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    code, region = F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")), F.concat(F.lit("R"), F.col("n_regionkey").cast("string"))
    day = F.date_add(F.lit("1990-01-01").cast("date"), F.col("n_nationkey")).cast("string")
    written = {
        "okres": n.select(code.alias("CHODNOTA"), F.col("n_name").alias("TEXT"), day.alias("ADMPLOD"), none.alias("ADMNEPO")),
        "vazba": n.select(F.lit("109").alias("KODCIS1"), code.alias("CHODNOTA1"), F.lit("108").alias("KODCIS2"), region.alias("CHODNOTA2")),
        "kraj": r.select(F.col("r_regionkey").cast("string").alias("CHODNOTA"), F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("CZNUTS"), F.col("r_name").alias("TEXT"),
                         F.col("r_name").alias("ZKRKRAJ"), F.lit("1").alias("KOD_RUIAN"), F.lit("1990-01-01").alias("ADMPLOD"), none.alias("ADMNEPO")),
        "forma": table(spark, sf, "orders").filter("o_orderpriority IS NOT NULL").groupBy(F.col("o_orderpriority").alias("CHODNOTA")).agg(
            F.min(F.lower("o_orderpriority")).alias("TEXT")).select("*", none.alias("ZKRTEXT"), none.alias("ADMPLOD"), none.alias("ADMNEPO"))}
    for name, df in written.items():
        df.write.option("header", True).csv(f"{root}/{name}")
    read = {name: L.read_list(spark, f"{root}/{name}") for name in written}
    rows = lambda df, name, region: df.select(F.lit(name).alias("list"), "code", "name", region.alias("region"), "valid_from")
    return rows(L.districts(read["okres"], read["vazba"]), "okres", F.col("region")).unionByName(rows(L.regions(read["kraj"]), "kraj", none)).unionByName(
        rows(L.legal_forms(read["forma"], 56), "forma", none))


# --- published series ------------------------------------------------------------------------------

SQL_COUNTED = """n AS (SELECT 'R' || n_regionkey AS region, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS district, year(o_orderdate) AS year, CAST(quarter(o_orderdate) AS VARCHAR) AS q,
  substr(c_mktsegment, 1, 1) AS nace, c_mktsegment, o_orderstatus FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)"""


def counted(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return o.select(F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("region"), F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("district"),
                    F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").cast("string").alias("q"), F.substring("c_mktsegment", 1, 1).alias("nace"), "o_orderstatus")


@registered(f"""WITH {SQL_COUNTED}, c AS (SELECT region, district, year, q, count(*) AS n FROM n GROUP BY GROUPING SETS ((region, district, year, q), (region, year, q)))
SELECT coalesce(district, region) AS territory, CASE WHEN district IS NULL THEN 'KRAJ' ELSE 'OKRES' END AS level, 'VZNIK' AS indicator, year || '-Q' || q AS period, CAST(n AS DOUBLE) AS value FROM c
UNION ALL SELECT coalesce(district, region), CASE WHEN district IS NULL THEN 'KRAJ' ELSE 'OKRES' END, 'OBYV', CAST(year AS VARCHAR), CAST(sum(n) AS DOUBLE) FROM c GROUP BY region, district, year""")
def published_territories(spark: SparkSession, sf: str) -> DataFrame:
    """Quarterly births and yearly inhabitants in long form with one column for each territory level: the deepest filled
    level names the territory."""
    root = work_path(spark, "territories")
    n = counted(spark, sf).groupBy("region", "district", "year", "q").agg(F.count(F.lit(1)).alias("n"))
    both = n.unionByName(n.groupBy("region", "year", "q").agg(F.sum("n").alias("n")).withColumn("district", F.lit(None).cast("string")))

    def levels(dim: str) -> list:
        names = {"OKRES": ("Okres", "district"), "KRAJ": ("Kraj", "region")}
        return [x for level, (title, c) in names.items() for x in (F.col(c).alias(f"{dim}.{level}.Polozka"), F.lower(c).alias(f"Území-{title}"))]

    births = both.select(F.lit("Počet vzniků").alias("Ukazatel"), *levels("UZ023H2U"), F.concat("year", F.lit("-Q"), "q").alias("CasQ.Polozka"), F.lit("0").alias("FORMA0.Polozka"), F.col("n").cast("string").alias("Hodnota"))
    people = both.groupBy("region", "district", "year").agg(F.sum("n").alias("n")).select(
        F.lit("Obyvatelé").alias("Ukazatel"), *levels("Uz0123h2"), F.col("year").cast("string").alias("CasR.Polozka"), F.explode(F.array(F.lit("0"), F.lit("1"))).alias("POHL2.Polozka"),
        F.col("n").cast("string").alias("Hodnota"))
    births.write.option("header", True).csv(f"{root}/births")
    people.write.option("header", True).csv(f"{root}/people")
    got = P.births_closures(P.read_long(spark, f"{root}/births"), {"Počet vzniků": "VZNIK"}).select("territory", "level", "indicator", "period", "value")
    return got.unionByName(P.population(P.read_long(spark, f"{root}/people"), {"Obyvatelé": "OBYV"}).select("territory", "level", "indicator", F.col("year").cast("string").alias("period"), "value"))


@registered(f"""WITH {SQL_COUNTED}, c AS (SELECT region, year, nace, count(*) AS n FROM n GROUP BY GROUPING SETS ((region, year, nace), (region, year)))
SELECT region AS territory, coalesce(nace, '0') AS nace, year, 'MZDA_FYZ' AS indicator, CAST(n AS DOUBLE) AS value, year = 2001 AS preliminary FROM c
UNION ALL SELECT 'CZ', '0', year, 'ZAM_FYZ', CAST(count(*) AS DOUBLE), year = 2001 FROM n GROUP BY year""", ints=("year",))
def published_wages(spark: SparkSession, sf: str) -> DataFrame:
    """Wages by region and section and employees of the state; other indicators and cohesion regions drop out, no section reads 0."""
    root = work_path(spark, "wages")
    n = counted(spark, sf)
    names = {code: name for name, code in P.WAGE_INDICATORS.items()}
    none = F.lit(None).cast("string")
    status = F.when(F.col("year") == 2001, "p").alias("OBS_STATUS")

    def rows(df: DataFrame, indicator: str, region, kraj, state, nace) -> DataFrame:
        return df.select(F.lit(indicator).alias("Ukazatel"), none.alias("Uz2.Polozka"), none.alias("Uz0.Polozka"), region.alias("Uz0123vm.REGION.Polozka"), kraj.alias("Uz0123vm.KRAJ.Polozka"),
                         state.alias("Uz0123vm.STAT.Polozka"), nace.alias("CZNACEMZDY.Polozka"), F.col("year").cast("string").alias("CasR.Polozka"), F.col("n").cast("string").alias("Hodnota"), status)

    count = F.count(F.lit(1)).alias("n")
    by_section, by_region, state = (n.groupBy(*by).agg(count) for by in (("region", "year", "nace"), ("region", "year"), ("year",)))
    wage, c = names["MZDA_FYZ"], F.col
    every = rows(by_section, wage, none, c("region"), none, c("nace")).unionByName(rows(by_region, wage, none, c("region"), none, none)).unionByName(
        rows(state, names["ZAM_FYZ"], none, none, F.lit("CZ"), none)).unionByName(rows(by_region, wage, c("region"), none, none, none)).unionByName(
        rows(by_region, "Počet úrazů", none, c("region"), none, none))
    every.write.option("header", True).csv(root)
    return P.wages(P.read_long(spark, root), "MZDCRRT2").select("territory", "nace", "year", "indicator", "value", "preliminary")


# --- stored tables ---------------------------------------------------------------------------------

@registered("""SELECT year(o_orderdate) AS year, o_orderstatus AS status, count(*) AS n, CASE WHEN year(o_orderdate) >= 1997 THEN 'second' ELSE 'first' END AS batch FROM orders
WHERE year(o_orderdate) < 1997 OR o_orderstatus <> 'F' GROUP BY ALL""", ints=("year",))
def replace_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by year and status; a second load without one status replaces the years from 1997 on as a whole."""
    root = work_path(spark, "keyed")
    n = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    B.replace_by_key(n.withColumn("batch", F.lit("first")), root, "years", ["year"], "first")
    B.replace_by_key(n.filter("year >= 1997 AND status <> 'F'").withColumn("batch", F.lit("second")), root, "years", ["year"], "second")
    return B.read_keyed(spark, root, "years")


@registered("""SELECT 'regions' AS source, 'OK' AS state, count(*) AS rows, '' AS note FROM region UNION ALL SELECT 'nations', 'OK', count(*), '' FROM nation
UNION ALL SELECT 'customers', 'error', NULL, 'LoadRefused: ' || count(*) || ' rows refused' FROM customer""")
def batch_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """Every load leaves its last state: rows of those that ended, the whole message of those that failed."""
    root = work_path(spark, "batches")
    for source, name in (("regions", "region"), ("nations", "nation"), ("customers", "customer")):
        try:
            with B.batch(spark, root, source) as b:
                b.rows = table(spark, sf, name).count()
                if source == "customers":
                    raise B.LoadRefused(f"{b.rows} rows refused")
        except B.LoadRefused:
            pass  # what the query is about
    return B.batches(spark, root).select("source", "state", "rows", "note")


@registered(f"""WITH {SQL_SUBJECTS} SELECT DATE '2001-08-01' AS snapshot, count(*) AS n, true AS latest FROM subj
UNION ALL SELECT DATE '2001-07-01', count(*) FILTER (WHERE founded < DATE '1996-01-01'), false FROM subj""")
def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Two snapshots, the newer one loaded first: rows of each, and which one the manifest gives as the latest."""
    root, s = work_path(spark, "snapshots"), subjects(spark, sf)
    feeds.write_metadata(spark, S.SUBJECTS, f"{root}/meta")
    for day, rows in (("2001-08-01", s), ("2001-07-01", s.filter("founded < date'1996-01-01'"))):
        given = {"ICO": F.col("ico"), "DATPLAT": F.lit(day)}
        rows.select(*[given.get(c, F.lit(None).cast("string")).alias(c) for c in S.SUBJECTS.columns]).write.option("header", True).csv(f"{root}/{day}")
        S.load_snapshot(spark, S.SUBJECTS, f"{root}/{day}", f"{root}/meta", f"{root}/tables", day)
    last = B.latest_snapshot(spark, f"{root}/tables", S.SUBJECTS.name)
    return S.snapshots(spark, S.SUBJECTS, f"{root}/tables").groupBy("snapshot").agg(F.count(F.lit(1)).alias("n")).withColumn("latest", F.col("snapshot") == F.lit(last).cast("date"))


@registered(ORACLE["industry_interface"])
def stored_interface(spark: SparkSession, sf: str) -> DataFrame:
    """The interface published as a table, unique by subject, replaced once and read as its current version."""
    root, rows = work_path(spark, "interface"), classification.industry_interface(spark, sf)
    B.publish(rows.limit(10), root, "interface", "b1", ["ico"])
    B.publish(rows.repartition("division").sortWithinPartitions("division", "ico"), root, "interface", "b2", ["ico"])
    return B.current(spark, root, "interface")


@registered(ORACLE["published_breakdown"])
def report_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Published breakdowns written by the report sink and read from its public output."""
    root, rows = work_path(spark, "report"), protection.published_breakdown(spark, sf)
    as_report = rows.withColumn("report_id", F.concat_ws("@", "section", F.concat(F.lit("KRAJ:"), F.col("parent"))))
    none = as_report.select("report_id").limit(0)
    report_sink.write_report(as_report, none, none, none, f"{root}/public", f"{root}/internal")
    return spark.read.schema(rows.schema).json(f"{root}/public/tables").select(*rows.columns)


# --- findings with ids -----------------------------------------------------------------------------

_ID = "list_reduce(list_prepend(0::HUGEINT, list_transform(range(8), lambda i: ('0x' || substr(h, 8 * i + 1, 8))::BIGINT::HUGEINT)), lambda a, b: (a * 4294967296 + b) % 456976)"


@registered(f"""WITH f AS ({ORACLE['findings_deviation']}),
s AS (SELECT *, sha256(kind || '|' || subtype || '|' || array_to_string(list_sort(['T02_srovnani/' || territory || '/' || x, 'T02_srovnani/CZ/' || x]), '|')) AS h
  FROM (SELECT *, CASE subtype WHEN 'LQ' THEN 'lq' ELSE 'density' END AS x FROM f)),
v AS (SELECT *, CAST({_ID} AS BIGINT) AS id FROM s)
SELECT section, territory, kind, subtype, strength, 'ZOD-' || chr(CAST(65 + id % 26 AS INTEGER)) || chr(CAST(65 + id // 26 % 26 AS INTEGER)) || chr(CAST(65 + id // 676 % 26 AS INTEGER))
  || chr(CAST(65 + id // 17576 % 26 AS INTEGER)) AS finding_id, row_number() OVER (PARTITION BY section, territory ORDER BY strength DESC, subtype) AS position FROM v""", ints=("position",))
def findings_assembled(spark: SparkSession, sf: str) -> DataFrame:
    """Deviations of each section and territory in order of strength, with ids that depend on their content only."""
    cells = notable.stored_indicators(spark, sf)
    found = K.assemble([K.deviation_from_state(notable.indicator_pairs(cells), ["section", "territory"])], ["section", "territory"])
    return found.select("section", "territory", "kind", "subtype", "strength", "finding_id", "position")


# --- crosswalk sheets, record codes, addresses -----------------------------------------------------

SQL_SHEETS = """WITH u AS (SELECT DISTINCT lpad(CAST(p_size AS VARCHAR), 2, '0') || '.' || substr(p_brand, 7, 1) || substr(p_brand, 8, 1) AS a,
  lpad(CAST(p_size % 7 AS VARCHAR), 2, '0') || '.' || substr(p_brand, 7, 1) || substr(p_brand, 8, 1) AS b, p_size % 3 AS third FROM part),
c AS (SELECT DISTINCT replace(a, '.', '') AS x, replace(b, '.', '') AS y, third FROM u)
SELECT 4 AS level, x AS code_2008, y AS code_2025, false AS partial, 1 AS src FROM c GROUP BY x, y
UNION ALL SELECT 5, x || '0', y || '0', bool_or(third = 1), min(CASE WHEN third = 1 THEN 2 ELSE 3 END) FROM c GROUP BY x, y"""


@registered(SQL_SHEETS, ints=("level", "src"))
def crosswalk_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of both converter directions, a national sheet with partial codes, and four-digit pairs lifted to five digits."""
    p = table(spark, sf, "part")
    brand = F.substring("p_brand", 7, 2)
    two = lambda x: F.concat_ws(".", F.lpad(x.cast("string"), 2, "0"), brand)
    u = p.select(two(F.col("p_size")).alias("a"), two(F.col("p_size") % 7).alias("b"), (F.col("p_size") % 3).alias("third")).distinct()
    level = F.lit(4).alias("level")
    forward = u.filter("third <> 0").select(level, "a", "b").unionByName(u.filter("third = 2").select(level, "a", F.lit("*").alias("b")))
    backward = u.filter("third = 0").select(level, F.col("b").alias("a"), F.col("a").alias("b"))
    five = lambda c: F.concat(c, F.lit(".0"))
    national = u.filter("third = 1").select(F.concat(five("a"), F.lit(" (částečně)")).alias("a"), five("b").alias("b"))
    nothing = u.select("a", "b").limit(0)
    codes = lambda c: u.select(F.concat(F.replace(F.col(c), F.lit("."), F.lit("")), F.lit("0")).alias("code"), F.lit(5).alias("level")).distinct()
    return C.assemble_pairs(forward, backward, national, nothing, codes("a"), codes("b"))


@registered("""WITH o AS (SELECT o_custkey, o_orderpriority AS code, CAST(o_orderdate AS DATE) AS day, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS rn FROM orders),
r AS (SELECT o_custkey, max(code) FILTER (WHERE rn = 1) AS main, max(day) AS updated, list(DISTINCT code) AS codes FROM o GROUP BY 1)
SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS ico, 'hlavni' AS kind, main AS code, updated AS start FROM r WHERE main IS NOT NULL
UNION ALL SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0'), 'vedlejsi', c, updated FROM (SELECT *, unnest(codes) AS c FROM r) WHERE c <> main""")
def record_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Main and secondary codes of registry records, staged for the code history; every code but the main one is secondary."""
    o = table(spark, sf, "orders")
    day = F.to_date("o_orderdate")
    records = o.groupBy(subject_id(F.col("o_custkey")).alias("ico")).agg(
        F.min_by("o_orderpriority", F.struct(day, "o_orderkey")).alias("main"), F.collect_set("o_orderpriority").alias("codes"), F.max(day).alias("updated"), F.lit(None).cast("date").alias("closed"))
    main, secondary = H.staged_from_record(records, 2008)
    return main.select("ico", F.lit("hlavni").alias("kind"), "code", "start").unionByName(secondary.select("ico", F.lit("vedlejsi").alias("kind"), "code", "start"))


@registered("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_custkey END AS ruian, CASE WHEN c_custkey % 2 = 1 THEN CAST(c_custkey % 500 AS VARCHAR) END AS house,
CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey % 500 AS VARCHAR) END AS registration, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_nationkey AS VARCHAR) || CASE WHEN c_custkey % 4 = 0 THEN 'a' ELSE '' END END AS orientation,
CASE WHEN c_custkey % 7 = 0 THEN 'WC1' WHEN c_custkey % 7 = 1 THEN 'txt' ELSE lpad(CAST(c_custkey % 9000 AS VARCHAR), 5, '0') END AS zip, c_mktsegment AS town FROM customer""")
def address_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers, orientation letters and postcodes of structured addresses."""
    k = F.col("c_custkey")
    none = F.lit(None).cast("string")
    parts = {"kodAdresnihoMista": F.when(k % 3 == 0, k), "nazevUlice": none, "cisloDomovni": (k % 500).cast("int"), "typCisloDomovni": F.when(k % 2 == 1, 1).otherwise(2),
             "cisloOrientacni": F.when(k % 5 != 0, F.col("c_nationkey")), "cisloOrientacniPismeno": F.when(k % 4 == 0, "a"), "nazevObce": F.col("c_mktsegment"), "nazevCastiObce": none,
             "psc": F.when(k % 7 == 0, F.lit("WC1")).when(k % 7 == 1, none).otherwise((k % 9000).cast("string")), "pscTxt": F.lit("txt"), "kodStatu": none, "kodKraje": F.lit(None).cast("int"),
             "textovaAdresa": none}
    a = table(spark, sf, "customer").select("c_custkey", F.struct(*[v.alias(n) for n, v in parts.items()]).alias("a"))
    return a.select("c_custkey", *R.address_columns(F.col("a"))).select("c_custkey", "ruian", "house", "registration", "orientation", "zip", "town")


# --- rules, audits and bounds of stored rows -------------------------------------------------------

SQL_RULES = """WITH r AS (SELECT lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS ico, CASE WHEN l_linenumber % 4 IN (0, 1) THEN lpad(CAST(l_suppkey AS VARCHAR), 8, '0') END AS firm,
  CASE WHEN l_linenumber % 4 IN (1, 2) THEN 'name' END AS named, CASE WHEN l_linenumber % 4 = 2 THEN CASE WHEN l_quantity > 40 THEN 'cz' ELSE 'CZ' END END AS state,
  l_quantity * 3 AS share, l_linenumber, l_quantity, CAST(l_shipdate AS DATE) AS day FROM lineitem)
SELECT 'relation' AS tbl, 'one_member' AS rule, count(*) FILTER (WHERE (firm IS NOT NULL)::INT + (named IS NOT NULL)::INT <> 1) AS violations FROM r
UNION ALL SELECT 'relation', 'name_with_state', count(*) FILTER (WHERE (named IS NULL) <> (state IS NULL)) FROM r
UNION ALL SELECT 'relation', 'state', count(*) FILTER (WHERE state = 'cz') FROM r
UNION ALL SELECT 'relation', 'currency', 0 FROM (SELECT 1) UNION ALL SELECT 'relation', 'registered_order', count(*) FILTER (WHERE l_quantity < 3) FROM r
UNION ALL SELECT 'relation', 'share', count(*) FILTER (WHERE share > 100) FROM r UNION ALL SELECT 'relation', 'paid', count(*) FILTER (WHERE l_quantity > 45) FROM r
UNION ALL SELECT 'relation', 'not_itself', count(*) FILTER (WHERE firm = ico) FROM r UNION ALL SELECT 'relation', 'from_not_after_to', 0 FROM (SELECT 1)
UNION ALL SELECT 'code', 'version', count(*) FILTER (WHERE l_linenumber = 3) FROM r UNION ALL SELECT 'code', 'level', count(*) FILTER (WHERE l_linenumber > 5) FROM r
UNION ALL SELECT 'code', 'certainty', count(*) FILTER (WHERE l_quantity > 40) FROM r UNION ALL SELECT 'code', 'code_or_flag', count(*) FILTER (WHERE l_linenumber = 2 AND l_quantity <= 20) FROM r
UNION ALL SELECT 'code', 'from_not_after_to', count(*) FILTER (WHERE l_quantity < 3) FROM r
UNION ALL SELECT 'address', 'state', count(*) FILTER (WHERE state = 'cz') FROM r UNION ALL SELECT 'address', 'one_number', count(*) FILTER (WHERE firm IS NOT NULL AND named IS NOT NULL) FROM r
UNION ALL SELECT 'version', 'id', count(*) FILTER (WHERE l_linenumber = 7) FROM r UNION ALL SELECT 'version', 'from_not_after_to', count(*) FILTER (WHERE l_quantity < 3) FROM r
UNION ALL SELECT 'version', 'recorded_order', 0 FROM (SELECT 1) UNION ALL SELECT 'version', 'closed_after_founded', count(*) FILTER (WHERE l_quantity < 3) FROM r
UNION ALL SELECT 'version', 'tax_id', count(*) FILTER (WHERE l_linenumber = 4) FROM r UNION ALL SELECT 'version', 'currency', count(*) FILTER (WHERE l_linenumber = 5) FROM r"""


@registered(SQL_RULES)
def table_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Violations of the rules of relations, codes, addresses and versions over rows with faults of every kind; NULL holds."""
    li, c = table(spark, sf, "lineitem"), F.col
    line, n, day, none = c("l_linenumber"), c("l_quantity"), F.to_date("l_shipdate"), F.lit(None).cast("string")
    state = F.when(line % 4 == 2, F.when(n > 40, "cz").otherwise("CZ"))
    firm, named = F.when((line % 4).isin(0, 1), subject_id(c("l_suppkey"))), F.when((line % 4).isin(1, 2), "name")
    before = F.when(n < 3, F.date_sub(day, 1)).otherwise(day)
    period = {"start": day, "end": before}
    kinds = {
        "relation": (V.relation_rules(), {"ico": subject_id(c("l_orderkey")), "member_person": none, "member_ico": firm, "member_name": named, "member_state": state, "deposit_currency": none,
                                          "registered": day, "deleted": before, "share_percent": n * 3, "paid_percent": n + 55, "start": day, "end": F.lit(None).cast("date")}),
        "code": (V.code_rules(), {"version": F.when(line == 3, 2000).otherwise(2008), "level": line, "certainty": n / 40, "code": F.when(line != 2, "01"), "flag": F.when(n > 20, "flag"), **period}),
        "address": (V.address_rules(), {"state": state, "house": firm, "registration": named}),
        "version": (V.version_rules(), {"ico": F.when(line == 7, "1").otherwise(subject_id(c("l_orderkey"))), "recorded_from": day, "recorded_to": day, "founded": day, "closed": before,
                                        "tax_id": F.when(line == 4, "SK1").otherwise("CZ12345678"), "currency": F.when(line == 5, "Kč").otherwise("CZK"), **period})}
    out = None
    for name, (rules, columns) in kinds.items():
        one = V.violation_counts(li.select(*[v.alias(k) for k, v in columns.items()]), rules).select(F.lit(name).alias("tbl"), "rule", "violations")
        out = one if out is None else out.unionByName(one)
    return out


@registered("""SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS ico, o_orderpriority AS code, CASE WHEN o_orderpriority = '5-LOW' THEN 'deleted' ELSE 'changed' END AS violation
FROM orders WHERE o_orderdate < DATE '2000-01-01' AND o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED', '5-LOW') GROUP BY 1, 2""")
def code_audit(spark: SparkSession, sf: str) -> DataFrame:
    """A next code history that deletes, changes levels and moves starts; closing a code and adding a reason is allowed."""
    before, code = temporal.code_history_before(spark, sf), F.col("code")
    after = before.filter(code != "5-LOW").withColumn("level", F.when(code == "4-NOT SPECIFIED", F.col("level") + 1).otherwise(F.col("level"))).withColumn(
        "start", F.when(code == "3-MEDIUM", F.date_add("start", 1)).otherwise(F.col("start"))).withColumn(
        "end", F.when(code == "2-HIGH", F.lit("2002-01-01").cast("date")).otherwise(F.col("end"))).withColumn("close_reason", F.when(code == "1-URGENT", "reason"))
    return H.audit_codes(before, after, ["ico", "code"])


@registered("""SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS n, count(*) AS stock,
CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'F') < 10 THEN ceil(10000 / count(*)) / 10.0 END AS bound FROM orders GROUP BY 1""")
def rate_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Upper bounds of rates whose count is too small to be shown."""
    n = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("n"), F.count(F.lit(1)).alias("stock"))
    return n.withColumn("bound", N.rate_upper_bound(F.col("n"), F.col("stock"), 10))


@registered("""SELECT o_orderkey AS person_id, o_orderpriority AS last FROM orders WHERE o_orderstatus <> 'F' AND CAST(o_orderdate AS DATE) <= DATE '2000-06-30'
AND DATE '2000-06-30' < CAST(o_orderdate AS DATE) + 1000""")
def current_persons(spark: SparkSession, sf: str) -> DataFrame:
    """Persons by their version in force on a day, closed records left out."""
    day = F.to_date("o_orderdate")
    versions = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("person_id"), F.col("o_orderpriority").alias("last"), day.alias("start"), F.date_add(day, 1000).alias("end"), F.lit("2002-01-01").cast("date").alias("recorded_from"),
        F.when(F.col("o_orderstatus") == "F", F.lit("2002-02-01").cast("date")).alias("recorded_to"), F.lit(1).alias("batch_id"))
    return reconcile.current_persons(versions, F.lit("2000-06-30").cast("date"))


@registered(f"""WITH {SQL_COUNTED} SELECT nace AS industry, o_orderstatus AS form, year, 'AKTIVNI' AS indicator, CAST(count(*) AS DOUBLE) AS value, year = 2001 AS preliminary
FROM n GROUP BY ALL""", ints=("year",))
def published_demography(spark: SparkSession, sf: str) -> DataFrame:
    """Enterprise demography by industry, form and year in long form; a status marks preliminary values, blank values drop out."""
    root = work_path(spark, "demography")
    n = counted(spark, sf).groupBy("nace", "o_orderstatus", "year").agg(F.count(F.lit(1)).alias("n"))
    rows = n.select(F.lit("Aktivní").alias("Ukazatel"), F.col("nace").alias("CZNACERES.Polozka"), F.col("o_orderstatus").alias("FORMA.Polozka"), F.col("year").cast("string").alias("CasR.Polozka"),
                    F.explode(F.array(F.col("n").cast("string"), F.lit(""))).alias("Hodnota"), F.when(F.col("year") == 2001, "p").otherwise("").alias("OBS_STATUS"))
    rows.write.option("header", True).csv(root)
    return P.demography(P.read_long(spark, root), {"Aktivní": "AKTIVNI"})
