"""Scalar functions, row rules, text checks and request validation over whole tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regisight.catalog import registered
from regisight.functions import codes as C
from regisight.functions import numbers as N
from regisight.functions import text as X
from regisight.operators import rules as R
from regisight.operators import territory as T
from regisight.operators import textcheck as K
from regisight.plans.proxy import SQL_SUBJECTS, SQL_TERRITORY, subject_id, subjects, table, territories

_ICO = "lpad(CAST(c_custkey AS VARCHAR), 8, '0')"
_SUM = " + ".join(f"CAST(substr(ico, {i}, 1) AS INTEGER) * {9 - i}" for i in range(1, 8))


@registered(f"""WITH c AS (SELECT {_ICO} AS ico FROM customer), r AS (SELECT ico, ({_SUM}) % 11 AS rest FROM c)
SELECT ico, CAST(substr(ico, 8, 1) AS INTEGER) = CASE rest WHEN 0 THEN 1 WHEN 1 THEN 0 ELSE 11 - rest END AS valid FROM r""")
def id_checksum(spark: SparkSession, sf: str) -> DataFrame:
    ids = table(spark, sf, "customer").select(subject_id(F.col("c_custkey")).alias("ico"))
    return ids.select("ico", X.valid_id(F.col("ico")).alias("valid"))


@registered(r"""SELECT doc_id, md5(lower(regexp_replace(trim(strip_accents(text), ' '), '[\s]+', ' ', 'g'))) AS plain FROM documents""")
def text_normalise(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.md5(X.plain_text(F.col("text"))).alias("plain"))


@registered(r"""SELECT doc_id, md5(trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', ' ', 'g'), ' ')) AS words FROM documents""")
def text_words(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.md5(X.plain_words(F.col("text"))).alias("words"))


@registered(f"""WITH {SQL_SUBJECTS} SELECT ico, lower(section) || '|' || lower(name) || '|' || coalesce(strftime(closed, '%Y-%m-%d'), '?') AS person_key FROM subj""")
def person_keys(spark: SparkSession, sf: str) -> DataFrame:
    return subjects(spark, sf).select("ico", X.person_key(F.col("section"), F.col("name"), F.col("closed")).alias("person_key"))


@registered(f"""WITH {SQL_SUBJECTS} SELECT ico, md5(lower(coalesce(name, '')) || '|' || coalesce(katpo, '') || '||' || coalesce(forma, '') || '|' || lower(district)
|| '|' || lower(region) || '|' || division || '|' || 'CZ' || '|' || lower(section)) AS fingerprint FROM subj""")
def address_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    return subjects(spark, sf).select("ico", X.address_fingerprint(
        c("name"), c("katpo"), F.lit(None).cast("string"), c("forma"), c("district"), c("region"),
        F.concat(F.substring("division", 1, 1), F.lit(" "), F.substring("division", 2, 9)), F.lit("cz"), c("section")).alias("fingerprint"))


@registered("""SELECT o_orderkey, last_day(make_date(year(o_orderdate), 3 * quarter(o_orderdate), 1)) AS quarter_end,
greatest(CAST(o_orderdate AS DATE) + 10000, DATE '2025-01-01') AS start_2025,
CASE WHEN CAST(o_orderdate AS DATE) + 10000 < DATE '2025-01-01' THEN DATE '2025-01-01' ELSE CAST(o_orderdate AS DATE) + 10000 END AS end_2025,
strftime(o_orderdate, '%m%d') <= '0801' AS comparable FROM orders""")
def dates(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    period = F.concat(F.year(day), F.lit("-Q"), F.quarter(day))
    late = F.date_add(day, 10000)
    return table(spark, sf, "orders").select(
        "o_orderkey", C.quarter_end(period).alias("quarter_end"), C.start_2025(late).alias("start_2025"),
        C.end_2025(late).alias("end_2025"), C.comparable_period(day, F.lit(date(2001, 8, 1))).alias("comparable"))


@registered("""SELECT p_partkey, substr(p_brand, 7) || CAST(p_size AS VARCHAR) AS code, p_size > 25 AS partial,
CASE WHEN p_size <= 10 THEN 1 ELSE length(substr(p_brand, 7) || CAST(p_size AS VARCHAR)) END AS level FROM part""", ints=("level",))
def code_normalise(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(F.substring("p_brand", 7, 9), F.lit(". "), F.col("p_size").cast("string"),
                   F.when(F.col("p_size") > 25, " (částečně)").otherwise(""))
    code = C.clean_code(raw)
    letter = F.when(F.col("p_size") <= 10, F.lit("A")).otherwise(code)
    return table(spark, sf, "part").select("p_partkey", code.alias("code"), C.is_partial(raw).alias("partial"),
                                           C.code_level(letter).alias("level"))


@registered("""SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN 'CZK' ELSE 'EUR' END AS currency,
CASE WHEN o_orderstatus = 'F' THEN CAST(round(100.0 * month(o_orderdate) / 120, 4) AS DECIMAL(7,4))
     WHEN o_orderstatus = 'O' AND day(o_orderdate) <= 20 THEN CAST(day(o_orderdate) * 5 AS DECIMAL(7,4)) END AS share FROM orders""")
def number_parsing(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts written with ';', shares as fractions, percents and free text."""
    o = table(spark, sf, "orders")
    written = F.replace(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(";"))
    status = F.col("o_orderstatus")
    kind = F.when(status == "F", "KORUNY").when(status == "O", "EURA").otherwise("TEXT")
    share_kind = F.when(status == "F", "ZLOMEK").otherwise("TEXT")
    share = F.when(status == "F", F.concat(F.month("o_orderdate").cast("string"), F.lit(" / 120"))).when(
        status == "O", F.concat((F.day("o_orderdate") * 5).cast("string"), F.lit(",0 %"))).otherwise("polovina")
    return o.select("o_orderkey", N.parse_number(written).cast("decimal(18,2)").alias("amount"),
                    N.money_currency(kind).alias("currency"), N.share_percent(share_kind, share).alias("share"))


@registered("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_props(spark: SparkSession, sf: str) -> DataFrame:
    """Permissive JSON read: a broken record keeps its row with NULL fields."""
    parsed = F.from_json("props", "k bigint", {"mode": "PERMISSIVE"})
    return table(spark, sf, "events").select("event_id", parsed["k"].alias("k"))


@registered("""SELECT o_orderstatus AS state, round(t / a - 1, 6) AS relative,
CASE WHEN abs(t / a - 1) < 0.03 THEN 'srovnatelné' WHEN t > a THEN 'vyšší' ELSE 'nižší' END AS words FROM (
SELECT o_orderstatus, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS t, CAST(count(*) * 250000 AS DOUBLE) AS a FROM orders GROUP BY 1)""")
def relative_words(spark: SparkSession, sf: str) -> DataFrame:
    g = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("state")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("t"), (F.count(F.lit(1)) * 250000).alias("a"))
    return g.select("state", F.round(N.relative(F.col("t"), F.col("a")), 6).alias("relative"), N.verbal(F.col("t"), F.col("a")).alias("words"))


# --- rules ------------------------------------------------------------------------------------------

@registered(f"""WITH {SQL_SUBJECTS}, v AS (SELECT * FROM subj)
SELECT 'id' AS rule, count(*) FILTER (WHERE NOT regexp_full_match(ico, '[0-9]{{8}}')) AS violations FROM v
UNION ALL SELECT 'from_not_after_to', count(*) FILTER (WHERE founded > closed) FROM v
UNION ALL SELECT 'long_life', count(*) FILTER (WHERE closed - founded > 1500) FROM v
UNION ALL SELECT 'known_form', count(*) FILTER (WHERE forma = '205') FROM v""")
def row_rules(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    rules = {"id": c("ico").rlike(R.ID), **R.period_rules("founded", "closed"),
             "long_life": F.date_diff("closed", "founded") <= 1500, "known_form": c("forma") != "205"}
    return R.violation_counts(subjects(spark, sf), rules)


@registered("SELECT o_custkey, o_orderpriority, count(*) AS rows FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return R.duplicate_keys(table(spark, sf, "orders"), ["o_custkey", "o_orderpriority"])


# --- texts ------------------------------------------------------------------------------------------

_WORD = r"[\p{L}\p{N}_]*"


@registered(rf"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(text, '(?i){_WORD}licen[cs]{_WORD}(?:\s+under)?')) AS w FROM documents),
k AS (SELECT doc_id, regexp_replace(w, '(?i)\s+under$', '') AS w FROM w WHERE NOT regexp_matches(w, '(?i)^licensed{_WORD}\s+under$'))
SELECT doc_id, count(*) AS n, min(w) AS first_word FROM k WHERE NOT contains(w, '_') GROUP BY 1""")
def banned_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """The rule with another stem: licence words, except "licensed under"."""
    found = K.banned_vocabulary(table(spark, sf, "documents"), "doc_id", "text", stem="licen[cs]",
                                allowed_start="licensed", allowed_next="under")
    return found.select("doc_id", F.size("words").cast("bigint").alias("n"), F.array_min("words").alias("first_word"))


_NUM = r"\d+(?:[\x{202f}\x{a0}]\d{3})*(?:[,.]\d+)?"
_NORM = """(CASE WHEN rtrim(regexp_extract({t}, '\\.(\\d+)$', 1), '0') = '' THEN coalesce(nullif(ltrim(regexp_extract({t}, '^(\\d+)', 1), '0'), ''), '0')
 ELSE coalesce(nullif(ltrim(regexp_extract({t}, '^(\\d+)', 1), '0'), ''), '0') || '.' || rtrim(regexp_extract({t}, '\\.(\\d+)$', 1), '0') END)"""


@registered(rf"""WITH b AS (SELECT doc_id, regexp_replace(regexp_replace(text, '(?i)strana\s+\d+\s+z\s+\d+', ' ', 'g'), '(?i)\b(?:tab\.|tabulk[ay]|graf[uy]?)\s+\d+\b', ' ', 'g') AS text FROM documents),
r AS (SELECT doc_id, unnest(regexp_extract_all(text, '{_NUM}')) AS raw FROM b),
t AS (SELECT doc_id, replace(regexp_replace(raw, '[\s\x{{202f}}\x{{a0}}]', '', 'g'), ',', '.') AS t FROM r),
n AS (SELECT DISTINCT doc_id, {_NORM.format(t='t')} AS number FROM t),
ok AS (SELECT DISTINCT CAST(n_chars AS VARCHAR) AS number FROM documents UNION SELECT DISTINCT CAST(p_size AS VARCHAR) FROM part)
SELECT doc_id, number FROM n WHERE number NOT IN (SELECT number FROM ok)""")
def number_grounding(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers of the documents that are neither a length of a document nor a size of a part."""
    docs = table(spark, sf, "documents")
    allowed = K.source_numbers(docs, ["n_chars"], []).unionByName(K.source_numbers(table(spark, sf, "part"), ["p_size"], [])).distinct()
    return K.ungrounded_numbers(docs, "doc_id", "text", allowed)


# --- requests ---------------------------------------------------------------------------------------

SQL_REQUESTS = f"""WITH {SQL_TERRITORY},
rq AS (SELECT c_custkey AS request_id, CASE WHEN c_acctbal < 0 THEN 'Česko' WHEN c_acctbal < 2000 THEN ' nation_' || CAST(c_nationkey AS VARCHAR)
  WHEN c_acctbal < 4000 THEN r_name WHEN c_acctbal < 6000 THEN 'r' || CAST(n_regionkey AS VARCHAR) WHEN c_acctbal < 8000 THEN 'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0')
  ELSE c_mktsegment END AS text FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
nm AS (SELECT DISTINCT upper(region) AS key, 1 AS rk, 'KRAJ' AS level, region AS t FROM terr UNION SELECT DISTINCT upper(region_name), 1, 'KRAJ', region FROM terr
  UNION SELECT upper(district), 2, 'OKRES', district FROM terr UNION SELECT upper(district_name), 2, 'OKRES', district FROM terr),
rs AS (SELECT request_id, text, CASE WHEN upper(trim(text)) IN ('CZ', 'ČR', 'CR', 'ČESKO') THEN 'CR' ELSE level END AS level,
  CASE WHEN upper(trim(text)) IN ('CZ', 'ČR', 'CR', 'ČESKO') THEN 'CZ' ELSE t END AS territory FROM rq LEFT JOIN nm ON key = upper(trim(text)))
"""


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """One territory request per customer, written in different ways."""
    b = F.col("c_acctbal")
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    j = table(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    text = (
        F.when(b < 0, F.lit("Česko")).when(b < 2000, F.concat(F.lit(" nation_"), F.col("c_nationkey").cast("string")))
        .when(b < 4000, F.col("r_name")).when(b < 6000, F.concat(F.lit("r"), F.col("n_regionkey").cast("string")))
        .when(b < 8000, F.concat(F.lit("N"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"))).otherwise(F.col("c_mktsegment")))
    return j.select(F.col("c_custkey").alias("request_id"), text.alias("text"))


@registered(SQL_REQUESTS + "SELECT request_id, level, territory, CAST(NULL AS VARCHAR) AS reason FROM rs WHERE level IS NOT NULL "
            "UNION ALL SELECT request_id, NULL, NULL, 'unknown' FROM rs WHERE level IS NULL")
def territory_requests(spark: SparkSession, sf: str) -> DataFrame:
    good, bad = T.resolve_requests(requests(spark, sf), territories(spark, sf))
    null = F.lit(None).cast("string")
    return good.select("request_id", "level", "territory", null.alias("reason")).unionByName(
        bad.select("request_id", null.alias("level"), null.alias("territory"), "reason"))


@registered("""WITH cl(code, level, section, division) AS (VALUES ('A', 1, 'A', NULL), ('10', 2, 'A', '10'), ('20', 2, 'A', '20'), ('B', 1, 'B', NULL), ('30', 2, 'B', '30'), ('Y', 1, 'Y', NULL)),
rq AS (SELECT DISTINCT o_custkey AS request_id, CASE WHEN o_orderpriority = '1-URGENT' THEN 'A' WHEN o_orderpriority = '2-HIGH' THEN '10'
 WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' THEN 'Y' WHEN o_orderpriority = '3-MEDIUM' THEN '30' WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN '99' ELSE '20' END AS code
 FROM orders),
j AS (SELECT rq.*, level, section FROM rq LEFT JOIN cl USING (code)),
ck AS (SELECT *, CASE WHEN level IS NULL THEN 'unknown code' WHEN section = 'Y' THEN 'pseudo-code'
  WHEN level = 2 AND EXISTS (SELECT 1 FROM rq q WHERE q.request_id = j.request_id AND q.code = j.section) THEN 'inside another requested code' END AS reason FROM j)
SELECT request_id, code, reason FROM ck WHERE reason IS NOT NULL
UNION ALL SELECT request_id, code, NULL FROM ck WHERE request_id NOT IN (SELECT request_id FROM ck WHERE reason IS NOT NULL)""")
def industry_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Industry requests of all customers, checked against a small list."""
    from regisight.operators.interface import validate_requests

    rows = [("A", 1, "A", None, False), ("10", 2, "A", "10", False), ("20", 2, "A", "20", False), ("B", 1, "B", None, False),
            ("30", 2, "B", "30", False), ("Y", 1, "Y", None, True)]
    codes = spark.createDataFrame(rows, "code string, level int, section string, division string, pseudo boolean").select(
        "*", F.lit(None).cast("string").alias("grp"), F.lit(None).cast("string").alias("cls"))
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    code = (F.when(p == "1-URGENT", "A").when(p == "2-HIGH", "10").when((p == "3-MEDIUM") & (s == "F"), "Y").when(p == "3-MEDIUM", "30")
            .when((p == "4-NOT SPECIFIED") & (s == "O"), "99").otherwise("20"))
    asked = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("request_id"), code.alias("code"))
    good, bad = validate_requests(asked, codes)
    return good.select("request_id", "code", F.lit(None).cast("string").alias("reason")).unionByName(bad.select("request_id", "code", "reason"))


# --- memberships of all kinds and the role each has ----------------------------------------------
ROLE_CASES = (
    ("PROKURA", None, "prokurista", "112", "PROKURISTA"), ("LIKVIDATOR", "Likvidátor", None, "121", "LIKVIDATOR"), ("KOMPLEMENTAR", None, None, "118", "KOMPLEMENTAR"),
    ("SPOLECNIK", "Společníci", "", "112", "SPOLECNIK"), ("KOMANDITISTA", None, None, "118", "KOMANDITISTA"), ("AKCIONAR", None, None, "121", "JEDINY_AKCIONAR"),
    ("DOZORCI_RADA", "Dozorčí rada", "předseda dozorčí rady", "121", "PREDSEDA_DOZORCI_RADY"), ("DOZORCI_RADA", "Dozorčí rada", "Místopředseda", "121", "MISTOPREDSEDA_DOZORCI_RADY"),
    ("DOZORCI_RADA", "Dozorčí rada", None, "121", "CLEN_DOZORCI_RADY"), ("DOZORCI_RADA", "Dozorčí rada", "tajemník", "121", None),
    ("KONTROLNI_KOMISE", None, "člen kontrolní komise", "205", "CLEN_KONTROLNI_KOMISE"), ("STATUTARNI_ORGAN", "Komplementáři", "jednatel", "118", "KOMPLEMENTAR"),
    ("STATUTARNI_ORGAN", "Statutární orgán - společník", None, "111", "SPOLECNIK"), ("STATUTARNI_ORGAN", "Statutární orgán", "statutární ředitel", "121", "STATUTARNI_REDITEL"),
    ("STATUTARNI_ORGAN", "Správní rada", "předseda správní rady", "121", "PREDSEDA_SPRAVNI_RADY"), ("STATUTARNI_ORGAN", "Správní rada", "místopředseda správní rady", "121", None),
    ("STATUTARNI_ORGAN", "Statutární orgán", "jednatel", "112", "JEDNATEL"), ("STATUTARNI_ORGAN", "Statutární orgán", None, "112", "JEDNATEL"),
    ("STATUTARNI_ORGAN", "Statutární orgán", "předseda družstva", "205", "PREDSEDA_DRUZSTVA"), ("STATUTARNI_ORGAN", "Představenstvo", "člen družstva", "205", "CLEN_PREDSTAVENSTVA"),
    ("STATUTARNI_ORGAN", "Představenstvo", "místopředseda představenstva", "121", "MISTOPREDSEDA_PREDSTAVENSTVA"), ("STATUTARNI_ORGAN", "Statutární orgán", "generální ředitel", "121", None),
    ("STATUTARNI_ORGAN", "Statutární orgán", "člen", "101", None), ("JINY_ORGAN", "Správní rada", "předseda", "121", None),
)
_SQL_ROLES = ", ".join(f"({i}, {'NULL' if r is None else repr(r)})" for i, (*_, r) in enumerate(ROLE_CASES))


@registered(f"""SELECT role, l_returnflag, count(*) AS n FROM lineitem JOIN (VALUES {_SQL_ROLES}) AS v(i, role) ON i = (l_orderkey + 7 * l_linenumber) % {len(ROLE_CASES)} GROUP BY 1, 2""")
def member_roles(spark: SparkSession, sf: str) -> DataFrame:
    """Roles of members of all organ types, by organ, function and legal form; those that cannot be told have none."""
    cases = F.array(*[F.struct(*[F.lit(x).cast("string").alias(n) for n, x in zip(("kind", "organ", "job", "form"), case, strict=False)]) for case in ROLE_CASES])
    picked = table(spark, sf, "lineitem").select("l_returnflag", cases[((F.col("l_orderkey") + 7 * F.col("l_linenumber")) % len(ROLE_CASES)).cast("int")].alias("m")).select("l_returnflag", "m.*")
    return X.with_role(picked, "kind", "organ", "job", "form", "role").groupBy("role", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
