"""Source formats over data that Spark derives from the given tables: written, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regisight.catalog import registered
from regisight.catalog.economy import sales
from regisight.plans.proxy import SQL_SUBJECTS, subjects, table
from regisight.session import work_path
from regisight.sources import jsonstat as J
from regisight.sources import published as P
from regisight.sources import registry as R
from regisight.sources import snapshot_csv as S


def write_metadata(spark: SparkSession, contract: S.FileContract, path: str) -> None:
    """Metadata document of a snapshot file, as the source publishes it."""
    columns = F.array(*[
        F.struct(F.lit(c).alias("name"), F.lit("date" if c in contract.dates else "string").alias("datatype")) for c in contract.columns])
    doc = spark.range(1).select(F.to_json(F.struct(F.struct(columns.alias("columns")).alias("tableSchema"))).alias("value"))
    doc.coalesce(1).write.text(path)


@registered(f"""WITH {SQL_SUBJECTS} SELECT ico, district AS okreslau, founded AS ddatvzn, closed AS ddatzan, zpzan, forma, katpo,
name || chr(13) || chr(10) || '"' || section || '", ' || division AS firma, DATE '2001-08-01' AS datplat FROM subj""")
def snapshot_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Subjects written as a register snapshot (quotes and CRLF line ends inside names), loaded through the
    contract, the reconciliation and the manifest, and read back with types."""
    root = work_path(spark, "snapshot")
    s = subjects(spark, sf)
    given = {
        "ICO": F.col("ico"), "OKRESLAU": F.col("district"), "DDATVZN": F.col("founded").cast("string"), "DDATZAN": F.col("closed").cast("string"),
        "ZPZAN": F.col("zpzan"), "FORMA": F.col("forma"), "KATPO": F.col("katpo"), "DATPLAT": F.col("snapshot").cast("string"),
        "FIRMA": F.concat("name", F.lit('\n"'), "section", F.lit('", '), "division"),
    }
    rows = s.select(*[given.get(c, F.lit(None).cast("string")).alias(c) for c in S.SUBJECTS.columns])
    rows.write.option("header", True).option("lineSep", "\r\n").option("quote", '"').option("escape", '"').csv(f"{root}/csv")
    write_metadata(spark, S.SUBJECTS, f"{root}/meta")
    S.load_snapshot(spark, S.SUBJECTS, f"{root}/csv", f"{root}/meta", f"{root}/tables", "b1")
    S.load_snapshot(spark, S.SUBJECTS, f"{root}/csv", f"{root}/meta", f"{root}/tables", "b2")  # the same again: skipped
    return S.snapshots(spark, S.SUBJECTS, f"{root}/tables").select(
        "ico", "okreslau", "ddatvzn", "ddatzan", "zpzan", "forma", "katpo", "firma", "datplat")


@registered("""SELECT l_orderkey AS ico_key, CAST(l_linenumber AS VARCHAR) AS zdrud, '80004' AS kodcis, l_returnflag AS hodn, CAST(l_shipdate AS DATE) AS ddatpakt
FROM lineitem""")
def activity_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Activity file: several rows per subject, no quoted text, so its files split; loaded through the contract, the
    reconciliation and the manifest."""
    root = work_path(spark, "activities")
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("ICO"), F.col("l_linenumber").cast("string").alias("ZDRUD"), F.lit("80004").alias("KODCIS"),
        F.col("l_returnflag").alias("HODN"), F.lit("2001-08-01").alias("DATPLAT"), F.to_date("l_shipdate").cast("string").alias("DDATPAKT"),
        F.lit(None).cast("string").alias("PRIZNAK"))
    rows.write.option("header", True).csv(f"{root}/csv")
    write_metadata(spark, S.ACTIVITIES, f"{root}/meta")
    S.load_snapshot(spark, S.ACTIVITIES, f"{root}/csv", f"{root}/meta", f"{root}/tables", "b1")
    return S.snapshots(spark, S.ACTIVITIES, f"{root}/tables").select(F.col("ico").cast("bigint").alias("ico_key"), "zdrud", "kodcis", "hodn", "ddatpakt")


@registered("""SELECT 'V1' AS selection, 'SUM' AS indicator, 'R' || n_regionkey AS territory, substr(c_mktsegment, 1, 1) AS nace,
CAST(year(o_orderdate) AS VARCHAR) AS period, CAST(count(*) AS DOUBLE) AS value
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE c_mktsegment <> 'BUILDING' GROUP BY ALL""")
def published_long(spark: SparkSession, sf: str) -> DataFrame:
    """Counts written as a published long CSV with dimension codes, one section blank; read by definition."""
    root = work_path(spark, "published")
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    n = o.groupBy("n_regionkey", "c_mktsegment", F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    rows = n.select(
        F.lit("Počet, celkem").alias("Ukazatel"), F.concat(F.lit("R"), "n_regionkey").alias("UZ.Polozka"), F.lit("kraj").alias("Území"),
        F.substring("c_mktsegment", 1, 1).alias("NACE.Polozka"), F.col("c_mktsegment").alias("Odvětví"), F.col("y").cast("string").alias("CAS.Polozka"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("n").cast("string")).alias("Hodnota"))
    rows.write.option("header", True).csv(root)
    definition = {"selection": "V1", "indicators": {"Počet, celkem": "SUM"}, "territory": {"code": "UZ", "name": "Území"},
                  "industry": {"code": "NACE", "name": "Odvětví"}, "time": {"code": "CAS", "name": "CAS"}}
    return P.aggregates(P.read_long(spark, root), definition).select("selection", "indicator", "territory", "nace", "period", "value")


@registered("""SELECT 'R' || n_regionkey || 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS geo, substr(c_mktsegment, 1, 1) AS nace, year(o_orderdate) AS year,
CAST(sum(CAST(l_quantity AS DECIMAL(18,0))) AS DOUBLE) AS value, CASE WHEN year(o_orderdate) = 2001 THEN 'p' ELSE '' END AS status
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL""", ints=("year",))
def json_stat(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON-stat document per region (its districts x years x sections), decoded again."""
    s = sales(spark, sf).select("region", "district", "section", "year", F.col("emp").cast("double").alias("v"))
    lists = {"geos": "district", "years": "year", "sections": "section"}
    geo = s.groupBy("region").agg(*[F.array_sort(F.collect_set(c)).alias(a) for a, c in lists.items()])
    j = s.join(geo, "region")
    g, y, k = (F.array_position(a, F.col(c)) - 1 for a, c in lists.items())
    index = ((g * F.size("years") + y) * F.size("sections") + k).cast("string")
    docs = j.groupBy("region", *lists).agg(
        F.map_from_entries(F.collect_list(F.struct(index.alias("i"), F.col("v").alias("v")))).alias("value"),
        F.map_from_entries(F.array_compact(F.collect_list(F.when(F.col("year") == 2001, F.struct(index.alias("i"), F.lit("p").alias("f")))))).alias("status"))

    def dimension(names):
        return F.struct(F.struct(F.map_from_arrays(names, F.transform(names, lambda x, i: i)).alias("index")).alias("category"))

    year_list = F.transform("years", lambda y: y.cast("string"))
    text = docs.select(F.to_json(F.struct(
        F.array(F.lit("geo"), F.lit("time"), F.lit("nace_r2")).alias("id"),
        F.struct(dimension(F.col("geos")).alias("geo"), dimension(year_list).alias("time"),
                 dimension(F.col("sections")).alias("nace_r2")).alias("dimension"),
        "value", "status", F.lit("2026-01-01").alias("updated"))).alias("value"))
    root = work_path(spark, "jsonstat")
    text.write.text(root)
    at = F.col("at")
    return J.decode(spark.read.text(root)).select(at["geo"].alias("geo"), at["nace_r2"].alias("nace"), at["time"].cast("int").alias("year"), "value", "status")


# --- registry records: each order is a subject, its line items are its history ----------------------

def order_records(spark: SparkSession, sf: str) -> DataFrame:
    """Base and history record of each order as JSON, with all its lines in the order of number, day, quantity, status, part and supplier."""
    c = F.col
    # of lines equal in all these the roles come in the order of their texts
    place = F.when(c("l_returnflag") == "R", 0).when(c("l_returnflag") == "A", 1).otherwise(2)
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", F.struct("l_linenumber", F.to_date("l_shipdate").alias("d"), c("l_quantity").cast("int").alias("q"), "l_linestatus", "l_partkey", "l_suppkey",
                               place.alias("place"), "l_returnflag").alias("line"))
    text = lambda day: day.cast("string")

    def dates(x, until):
        return text(x["d"]).alias("datumZapisu"), text(until).alias("datumVymazu")

    def valued(x):
        return F.struct(*dates(x, F.date_add(x["d"], x["q"] * 10)), F.concat(x["l_linestatus"], x["l_linenumber"].cast("string")).alias("hodnota"))

    def mark(x):
        return F.struct(*dates(x, F.date_add(x["d"], x["q"] * 10)), x["l_linestatus"].alias("oddil"), x["l_linenumber"].cast("string").alias("vlozka"), F.lit("KS").alias("soud"))

    def member(x):
        function = F.when(x["place"] == 1, "jednatel").when(x["place"] == 0, "Místopředseda představenstva").otherwise("zástupce")
        return F.struct(
            *dates(x, F.when(x["q"] > 25, F.date_add(x["d"], 100))), F.struct(F.struct(function.alias("nazev")).alias("funkce")).alias("clenstvi"),
            F.struct(F.concat(F.lit("Žofie"), x["l_partkey"].cast("string")).alias("jmeno"), F.concat(F.lit("Dvořák "), x["l_suppkey"].cast("string")).alias("prijmeni"),
                     F.lit("1970-05-05").alias("datumNarozeni")).alias("fyzickaOsoba"))

    def listed(flag: str, what):
        return F.transform(F.filter("lines", lambda x: x["l_returnflag"] == flag), what)

    # each line is shuffled and sorted once; the lists are cut from the sorted lines
    g = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("line")).alias("lines")).select(
        "l_orderkey", listed("A", valued).alias("names"), listed("R", valued).alias("forms"), listed("N", mark).alias("marks"),
        F.transform("lines", member).alias("members"))
    ico = F.lpad(c("l_orderkey").cast("string"), 8, "0")
    base = F.to_json(F.struct(ico.alias("ico"), F.lit("Base name").alias("obchodniJmeno"), F.lit("112").alias("pravniForma"),
                              F.lit("1990-01-01").alias("datumVzniku"), F.lit("CZ12345678").alias("dic")))
    history = F.to_json(F.struct(ico.alias("icoId"), F.array(F.struct(
        F.lit(True).alias("primarniZaznam"), c("names").alias("obchodniJmeno"), c("forms").alias("pravniForma"), c("marks").alias("spisovaZnacka"),
        F.array(F.struct(F.lit("STATUTARNI_ORGAN").alias("typOrganu"), F.lit("Orgán").alias("nazevOrganu"), c("members").alias("clenoveOrganu"))).alias("statutarniOrgany"))).alias("zaznamy")))
    return g.select(base.alias("base_json"), history.alias("history_json"))


_ATTR = ("name", "form", "mark")
SQL_LINES = """
WITH lines AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_linenumber, CAST(l_shipdate AS DATE), CAST(l_quantity AS INTEGER), l_linestatus, l_partkey, l_suppkey) AS pos FROM lineitem)"""

SQL_RECORDS = SQL_LINES + """,
iv AS (SELECT l_orderkey AS k, pos, CASE l_returnflag WHEN 'A' THEN 'name' WHEN 'R' THEN 'form' ELSE 'mark' END AS attribute,
   CAST(l_shipdate AS DATE) AS s, CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) * 10 AS e,
   CASE WHEN l_returnflag = 'N' THEN l_linestatus || ' ' || l_linenumber || '/KS' ELSE l_linestatus || l_linenumber END AS value FROM lines
 WHERE CAST(l_quantity AS INTEGER) > 0),
nm AS (SELECT DISTINCT k FROM iv WHERE attribute = 'name'),
iv2 AS (SELECT * FROM iv UNION ALL SELECT DISTINCT l_orderkey, 0, 'name', DATE '1990-01-01', CAST(NULL AS DATE), 'Base name' FROM lineitem WHERE l_orderkey NOT IN (SELECT k FROM nm)),
b AS (SELECT k, s AS day FROM iv2 UNION SELECT k, e FROM iv2 WHERE e IS NOT NULL),
f AS (SELECT k, min(s) AS first FROM iv2 WHERE attribute = 'name' GROUP BY 1),
cuts AS (SELECT b.k, day, lead(day) OVER (PARTITION BY b.k ORDER BY day) AS nxt FROM b JOIN f USING (k) WHERE day >= first),
""" + ",\n".join(
    f"""{a}_v AS (SELECT k, day, value FROM (SELECT c.k, c.day, i.value, row_number() OVER (PARTITION BY c.k, c.day ORDER BY i.s DESC, i.pos) AS rn
      FROM cuts c JOIN iv2 i ON i.k = c.k AND i.attribute = '{a}' AND i.s <= c.day AND (i.e IS NULL OR c.day < i.e)) WHERE rn = 1)""" for a in _ATTR) + """,
v AS (SELECT c.k, c.day AS start, c.nxt AS fin, n.value AS name, fo.value AS form, m.value AS mark
      FROM cuts c JOIN name_v n USING (k, day) LEFT JOIN form_v fo USING (k, day) LEFT JOIN mark_v m USING (k, day)),
g AS (SELECT *, CASE WHEN lag(fin) OVER w IS NOT DISTINCT FROM start AND lag(name) OVER w IS NOT DISTINCT FROM name
        AND lag(form) OVER w IS NOT DISTINCT FROM form AND lag(mark) OVER w IS NOT DISTINCT FROM mark THEN 0 ELSE 1 END AS new
      FROM v WINDOW w AS (PARTITION BY k ORDER BY start)),
r AS (SELECT *, sum(new) OVER (PARTITION BY k ORDER BY start ROWS UNBOUNDED PRECEDING) AS run FROM g)
SELECT lpad(CAST(k AS VARCHAR), 8, '0') AS ico, min(start) AS start, arg_max(coalesce(fin, DATE '9999-12-31'), start) AS until, min(name) AS name,
  min(form) AS form_code, min(mark) AS file_mark, max(CASE WHEN fin IS NULL THEN 'CZ12345678' END) AS tax_id FROM r GROUP BY k, run"""


@registered(SQL_RECORDS)
def registry_versions(spark: SparkSession, sf: str) -> DataFrame:
    records, _ = R.parse(order_records(spark, sf))
    v, _ = R.versions(R.store(records))
    return v.select("ico", "start", F.coalesce("end", F.lit("9999-12-31").cast("date")).alias("until"), "name", "form_code", "file_mark", "tax_id")


@registered(SQL_LINES + """, m AS (SELECT l_orderkey AS k, CAST(l_shipdate AS DATE) AS s, CASE WHEN l_quantity > 25 THEN CAST(l_shipdate AS DATE) + 100 END AS e,
  CASE l_returnflag WHEN 'A' THEN 'JEDNATEL' WHEN 'R' THEN 'MISTOPREDSEDA_PREDSTAVENSTVA' END AS role_code,
  'OSOBA|zofie' || l_partkey || '|dvorak ' || l_suppkey || '|1970-05-05' AS member_key FROM lines WHERE l_returnflag <> 'N'),
o AS (SELECT k, role_code, member_key, s, CASE WHEN count(*) = count(e) THEN max(e) END AS e FROM m GROUP BY 1, 2, 3, 4),
j AS (SELECT *, CASE WHEN lag(e) OVER w = s THEN 0 ELSE 1 END AS new FROM o WINDOW w AS (PARTITION BY k, role_code, member_key ORDER BY s)),
r AS (SELECT *, sum(new) OVER (PARTITION BY k, role_code, member_key ORDER BY s ROWS UNBOUNDED PRECEDING) AS run FROM j)
SELECT lpad(CAST(k AS VARCHAR), 8, '0') AS ico, role_code, member_key, min(s) AS start, arg_max(coalesce(e, DATE '9999-12-31'), s) AS until FROM r GROUP BY k, role_code, member_key, run""")
def registry_relations(spark: SparkSession, sf: str) -> DataFrame:
    records, _ = R.parse(order_records(spark, sf))
    records = R.store(records)
    r, _ = R.relations(records, records.select("ico", F.lit("112").alias("form_code")))
    return r.select("ico", "role_code", "member_key", "start", F.coalesce("end", F.lit("9999-12-31").cast("date")).alias("until"))


@registered(SQL_LINES + """ SELECT lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS ico, 'unknown role / STATUTARNI_ORGAN / Orgán / zástupce' AS note, count(*) AS n
FROM lines WHERE l_returnflag = 'N' GROUP BY 1""")
def registry_skipped(spark: SparkSession, sf: str) -> DataFrame:
    """Members whose role cannot be told go to the side output."""
    records, _ = R.parse(order_records(spark, sf))
    records = R.store(records)
    _, skipped = R.relations(records, records.select("ico", F.lit("112").alias("form_code")))
    return skipped.groupBy("ico", "note").agg(F.count(F.lit(1)).alias("n"))
