"""Intervals, versions and histories over orders and events."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regisight.catalog import registered
from regisight.functions import fixed as X
from regisight.functions.text import address_fingerprint
from regisight.operators import history as H
from regisight.operators import reconcile as R
from regisight.operators import temporal as W
from regisight.plans.core import address_key
from regisight.plans.proxy import SQL_SUBJECTS, subject_id, subjects, table
from regisight.session import materialise, work_path
from regisight.sources import buckets as T

SPLIT = date(2024, 1, 20)


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority", F.to_date("o_orderdate").alias("day")
    )


def shipping_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Per order: from the first to the last ship day, keyed by customer."""
    spans = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.min(F.to_date("l_shipdate")).alias("start"), F.max(F.to_date("l_shipdate")).alias("end")
    )
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return spans.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_custkey", "start", "end", F.col("o_orderkey").alias("value"), F.col("o_orderkey").alias("pos")
    )


SQL_SHIP = """
ship AS (SELECT o_custkey, o_orderkey, min(CAST(l_shipdate AS DATE)) AS s, max(CAST(l_shipdate AS DATE)) AS e
         FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2)"""


@registered(f"""WITH {SQL_SHIP}, pts AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders),
j AS (SELECT p.o_custkey, p.day, s.o_orderkey,
        row_number() OVER (PARTITION BY p.o_custkey, p.day ORDER BY s.s DESC NULLS LAST, s.o_orderkey) AS rn
      FROM pts p LEFT JOIN ship s ON s.o_custkey = p.o_custkey AND s.s <= p.day AND p.day < s.e)
SELECT o_custkey, day, o_orderkey AS value FROM j WHERE rn = 1""")
def as_of_versions(spark: SparkSession, sf: str) -> DataFrame:
    """For each order day of a customer: the order being shipped that day, the latest started one."""
    spans = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min(F.to_date("l_shipdate")).alias("start"), F.max(F.to_date("l_shipdate")).alias("end"))
    both = materialise(orders(spark, sf).select("o_custkey", "o_orderkey", "day").join(spans, "o_orderkey", "left"), "shipped")
    return W.as_of(both.select("o_custkey", "day"), both.withColumn("value", F.col("o_orderkey")).withColumn("pos", F.col("o_orderkey")), ["o_custkey"])


@registered(f"""WITH {SQL_SHIP}, d AS (SELECT o_custkey, s AS start, max(e) AS "end", count(*) AS rows FROM ship WHERE e > s GROUP BY 1, 2),
r AS (SELECT *, max("end") OVER (PARTITION BY o_custkey ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS overlaps_until FROM d)
SELECT * FROM r WHERE overlaps_until > start OR rows > 1""")
def overlap_violations(spark: SparkSession, sf: str) -> DataFrame:
    return W.overlap_violations(shipping_intervals(spark, sf).drop("value", "pos"), ["o_custkey"])


def order_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Three attributes of a customer, each with overlapping validity."""
    o = orders(spark, sf)
    span = F.when(F.col("o_orderstatus") == "F", 200).when(F.col("o_orderstatus") == "O", 120).otherwise(60)
    name = F.when(F.col("o_orderstatus") == "F", "name").when(F.col("o_orderstatus") == "O", "form").otherwise("mark")
    return o.select("o_custkey", name.alias("attribute"), F.col("day").alias("start"),
                    F.date_add("day", span).alias("end"), F.col("o_orderpriority").alias("value"),
                    F.col("o_orderkey").alias("pos"))


_ATTR = ("name", "form", "mark")
SQL_SLICES = """
WITH iv AS (SELECT o_custkey, o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'name' WHEN 'O' THEN 'form' ELSE 'mark' END AS attribute,
       CAST(o_orderdate AS DATE) AS s,
       CAST(o_orderdate AS DATE) + CASE o_orderstatus WHEN 'F' THEN 200 WHEN 'O' THEN 120 ELSE 60 END AS e,
       o_orderpriority AS value FROM orders),
b AS (SELECT o_custkey, s AS day FROM iv UNION SELECT o_custkey, e FROM iv),
f AS (SELECT o_custkey, min(s) AS first FROM iv WHERE attribute = 'name' GROUP BY 1),
cuts AS (SELECT b.o_custkey, day, lead(day) OVER (PARTITION BY b.o_custkey ORDER BY day) AS nxt
         FROM b JOIN f USING (o_custkey) WHERE day >= first),
""" + ",\n".join(
    f"""{a}_v AS (SELECT o_custkey, day, value FROM (SELECT c.o_custkey, c.day, i.value,
      row_number() OVER (PARTITION BY c.o_custkey, c.day ORDER BY i.s DESC, i.o_orderkey) AS rn
      FROM cuts c JOIN iv i ON i.o_custkey = c.o_custkey AND i.attribute = '{a}' AND i.s <= c.day AND c.day < i.e) WHERE rn = 1)"""
    for a in _ATTR) + """,
v AS (SELECT c.o_custkey, c.day AS start, c.nxt AS fin, n.value AS name, fo.value AS form, m.value AS mark
      FROM cuts c JOIN name_v n USING (o_custkey, day) LEFT JOIN form_v fo USING (o_custkey, day) LEFT JOIN mark_v m USING (o_custkey, day)),
g AS (SELECT *, CASE WHEN lag(fin) OVER w IS NOT DISTINCT FROM start AND lag(name) OVER w IS NOT DISTINCT FROM name
        AND lag(form) OVER w IS NOT DISTINCT FROM form AND lag(mark) OVER w IS NOT DISTINCT FROM mark THEN 0 ELSE 1 END AS new
      FROM v WINDOW w AS (PARTITION BY o_custkey ORDER BY start)),
r AS (SELECT *, sum(new) OVER (PARTITION BY o_custkey ORDER BY start ROWS UNBOUNDED PRECEDING) AS run FROM g)
SELECT o_custkey, min(start) AS start, arg_max(fin, start) AS "end", min(name) AS name, min(form) AS form, min(mark) AS mark
FROM r GROUP BY o_custkey, run"""


@registered(SQL_SLICES)
def version_slices(spark: SparkSession, sf: str) -> DataFrame:
    return W.version_slices(order_intervals(spark, sf), ["o_custkey"], list(_ATTR), "name")


@registered("""
WITH iv AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS start, max(o_orderkey) AS o_orderkey, count(*) - 1 AS replaced FROM orders GROUP BY 1, 2),
x AS (SELECT *, start + 90 AS fin, lead(start) OVER (PARTITION BY o_custkey ORDER BY start) AS nxt FROM iv)
SELECT o_custkey, start, CASE WHEN nxt < fin THEN nxt ELSE fin END AS "end", o_orderkey, coalesce(nxt < fin, false) AS clipped, replaced FROM x""")
def clip_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Each order day opens a 90-day seat of the customer; older seats end where the next starts."""
    seats = orders(spark, sf).select("o_custkey", F.col("day").alias("start"), F.date_add("day", 90).alias("end"),
                                     "o_orderkey", F.col("o_orderkey").alias("pos"))
    return W.clip_overlaps(seats, ["o_custkey"], ["o_orderkey"])


def event_versions(spark: SparkSession, sf: str, until: date | None = None) -> DataFrame:
    """Versions of a user: the last event type of a day holds for that day; equal neighbours merge."""
    e = table(spark, sf, "events")
    if until is not None:
        e = e.filter(F.to_date("ts") < F.lit(until))
    daily = e.groupBy("user_id", F.to_date("ts").alias("start")).agg(
        F.max_by("event_type", F.struct("ts", "event_id")).alias("event_type")
    )
    return W.coalesce_adjacent(daily.withColumn("end", F.date_add("start", 1)), ["user_id"], ["event_type"])


def _sql_versions(name: str, where: str) -> str:
    return f"""
{name}_d AS (SELECT user_id, CAST(ts AS DATE) AS d, event_type, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
   ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE {where}),
{name}_g AS (SELECT user_id, d, event_type, CASE WHEN lag(d + 1) OVER w = d AND lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS new
   FROM {name}_d WHERE rn = 1 WINDOW w AS (PARTITION BY user_id ORDER BY d)),
{name}_r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY d ROWS UNBOUNDED PRECEDING) AS run FROM {name}_g),
{name} AS (SELECT user_id, min(d) AS start, max(d) + 1 AS "end", min(event_type) AS event_type FROM {name}_r GROUP BY user_id, run)"""


SQL_EVENTS = "WITH " + _sql_versions("old", "CAST(ts AS DATE) < DATE '2024-01-20'") + "," + _sql_versions("cur", "true")


@registered(SQL_EVENTS + " SELECT * FROM cur")
def coalesce_islands(spark: SparkSession, sf: str) -> DataFrame:
    return event_versions(spark, sf)


def synced(spark: SparkSession, sf: str) -> DataFrame:
    """First batch until the split day, second batch with everything."""
    stored = event_versions(spark, sf, SPLIT).withColumn("recorded_from", F.lit(SPLIT)).withColumn("batch_id", F.lit(1))
    return H.synchronise(stored, event_versions(spark, sf), "user_id", ["event_type", "start", "end"],
                         F.lit(date(2024, 2, 1)), F.lit(2))


SQL_SYNC = SQL_EVENTS + """,
syn AS (SELECT o.user_id, o.event_type, o.start, o."end", DATE '2024-01-20' AS recorded_from,
    CASE WHEN c.user_id IS NULL THEN DATE '2024-02-01' END AS recorded_to, 1 AS batch_id,
    CASE WHEN c.user_id IS NULL THEN 'close' ELSE 'keep' END AS action
  FROM old o LEFT JOIN cur c ON c.user_id = o.user_id AND c.event_type = o.event_type AND c.start = o.start AND c."end" = o."end"
  UNION ALL
  SELECT c.user_id, c.event_type, c.start, c."end", DATE '2024-02-01', NULL, 2, 'insert' FROM cur c
  WHERE NOT EXISTS (SELECT 1 FROM old o WHERE c.user_id = o.user_id AND c.event_type = o.event_type AND c.start = o.start AND c."end" = o."end"))
"""


@registered(SQL_SYNC + "SELECT * FROM syn")
def history_sync(spark: SparkSession, sf: str) -> DataFrame:
    """Both batches through a stored table in buckets; what each version underwent is read from the table."""
    root, content = work_path(spark, "history"), ["event_type", "start", "end"]
    for day, until, batch in ((SPLIT, SPLIT, "1"), (date(2024, 2, 1), None, "2")):
        T.synchronise(spark, root, "versions", "user_id", content, event_versions(spark, sf, until), F.lit(day), batch, buckets=4)
    action = F.when(F.col("recorded_to").isNotNull(), H.CLOSE).when(F.col("batch_id") == "2", H.INSERT).otherwise(H.KEEP)
    return T.versions(spark, root, "versions").select(
        "user_id", *content, "recorded_from", "recorded_to", F.col("batch_id").cast("int").alias("batch_id"), action.alias("action"))


@registered(SQL_SYNC + """SELECT user_id, event_type, start, "end" FROM syn WHERE recorded_from <= DATE '2024-01-25'
AND (recorded_to IS NULL OR recorded_to > DATE '2024-01-25') AND start <= DATE '2024-01-19' AND DATE '2024-01-19' < "end" """)
def bitemporal_query(spark: SparkSession, sf: str) -> DataFrame:
    """What held on 19 January as known on 25 January."""
    return W.at_time(synced(spark, sf), F.lit(date(2024, 1, 19)), F.lit(date(2024, 1, 25))).select(
        "user_id", "event_type", "start", "end"
    )


@registered(SQL_SYNC + """SELECT user_id, event_type, start, "end" FROM syn WHERE recorded_to IS NULL
AND start <= DATE '2024-01-28' AND DATE '2024-01-28' < "end" """)
def current_versions(spark: SparkSession, sf: str) -> DataFrame:
    now = synced(spark, sf).filter(F.col("recorded_to").isNull())
    return W.at_time(now, F.lit(date(2024, 1, 28)), F.lit(date(2024, 3, 1))).select("user_id", "event_type", "start", "end")


# --- codes over time -------------------------------------------------------------------------------

OLD = date(2000, 1, 1)


def code_history_before(spark: SparkSession, sf: str) -> DataFrame:
    """Open codes known from orders before 2000: code = priority, from its first day."""
    o = orders(spark, sf).filter(F.col("day") < F.lit(OLD))
    first = o.groupBy(subject_id(F.col("o_custkey")).alias("ico"), F.col("o_orderpriority").alias("code")).agg(
        F.min("day").alias("start")
    )
    null = lambda t: F.lit(None).cast(t)
    return first.select(
        "ico", F.lit(2008).alias("version"), "code", F.length("code").alias("level"), F.lit(X.MAIN).alias("kind"),
        F.lit(X.OFFICIAL).alias("source"), F.lit("first load").alias("detail"), F.lit(1).cast("decimal(5,4)").alias("certainty"),
        null("string").alias("flag"), null("array<string>").alias("candidates"), null("string").alias("derived_from"),
        "start", null("date").alias("end"), null("string").alias("close_reason"), F.lit(1).alias("batch_id"),
    )


def code_snapshot(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(staged codes of the snapshot, its scope) from orders since 2000 and all subjects."""
    s = subjects(spark, sf).select("ico", "closed", "snapshot")
    late = orders(spark, sf).filter(F.col("day") >= F.lit(OLD)).groupBy(
        subject_id(F.col("o_custkey")).alias("ico"), F.col("o_orderpriority").alias("code")
    ).agg(F.min("day").alias("updated"))
    staged = late.join(s, "ico").select(
        "ico", "code", F.least(F.coalesce("updated", "snapshot"), F.col("closed")).alias("start"), F.col("closed").alias("end")
    )
    return staged, H.snapshot_scope(s.withColumn("updated", F.lit(None).cast("date")))


SQL_CODES = f"""
WITH {SQL_SUBJECTS},
h AS (SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS ico, o_orderpriority AS code, min(CAST(o_orderdate AS DATE)) AS start
      FROM orders WHERE o_orderdate < DATE '2000-01-01' GROUP BY 1, 2),
st AS (SELECT x.ico, x.code, least(x.u, s.closed) AS start, s.closed AS e
       FROM (SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS ico, o_orderpriority AS code, min(CAST(o_orderdate AS DATE)) AS u
             FROM orders WHERE o_orderdate >= DATE '2000-01-01' GROUP BY 1, 2) x JOIN subj s USING (ico)),
up AS (SELECT h.ico, h.code, h.start,
         CASE WHEN st.ico IS NOT NULL THEN CASE WHEN st.e IS NOT NULL THEN greatest(st.e, h.start) END
              ELSE greatest(coalesce(s.closed, DATE '2001-08-01'), h.start) END AS "end",
         CASE WHEN st.ico IS NOT NULL THEN CASE WHEN st.e IS NOT NULL THEN 'zánik subjektu' END
              WHEN s.closed IS NOT NULL THEN 'zánik subjektu' ELSE 'zdroj kód už neuvádí' END AS close_reason
       FROM h LEFT JOIN st ON st.ico = h.ico AND st.code = h.code LEFT JOIN subj s ON s.ico = h.ico),
ins AS (SELECT ico, code, start, e AS "end", CASE WHEN e IS NOT NULL THEN 'zánik subjektu' END AS close_reason FROM st
        WHERE NOT EXISTS (SELECT 1 FROM up WHERE up.ico = st.ico AND up.code = st.code
                          AND (up."end" IS NULL OR up."end" = st.e OR up.start = st.start))),
nxt AS (SELECT *, CASE WHEN "end" IS NULL THEN 'keep' ELSE 'close' END AS action FROM up UNION ALL SELECT *, 'insert' FROM ins)
"""


def codes_after(spark: SparkSession, sf: str) -> DataFrame:
    staged, scope = code_snapshot(spark, sf)
    return H.apply_codes(code_history_before(spark, sf), staged, scope, 2008, X.MAIN, F.lit("second load"), F.lit(2))


@registered(SQL_CODES + 'SELECT ico, code, start, "end", close_reason, action FROM nxt')
def code_history(spark: SparkSession, sf: str) -> DataFrame:
    return codes_after(spark, sf).select("ico", "code", "start", "end", "close_reason", "action")


@registered(SQL_CODES + """SELECT ico, code, start, CASE WHEN "end" IS NULL THEN greatest(DATE '2028-12-31', start) ELSE "end" END AS "end",
CASE WHEN "end" IS NULL THEN 'konec dvojího kódování' ELSE close_reason END AS close_reason FROM nxt""")
def dual_coding_end(spark: SparkSession, sf: str) -> DataFrame:
    return H.end_dual_coding(codes_after(spark, sf)).select("ico", "code", "start", "end", "close_reason")


@registered(SQL_CODES + """SELECT ico, arg_max(code, strftime(start, '%Y%m%d') || lpad(CAST(length(code) AS VARCHAR), 3, '0') || code) AS code
FROM nxt WHERE start <= DATE '1999-06-30' AND ("end" IS NULL OR DATE '1999-06-30' < "end") GROUP BY ico""")
def code_at_day(spark: SparkSession, sf: str) -> DataFrame:
    return H.code_at(codes_after(spark, sf), F.lit(date(1999, 6, 30)), 2008).select("ico", "code")


@registered("""SELECT o_custkey AS ico, o_orderpriority AS code, CAST(o_orderdate AS DATE) AS start FROM (
SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC NULLS LAST, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def latest_code(spark: SparkSession, sf: str) -> DataFrame:
    from regisight.operators.interface import latest_rows

    return latest_rows(orders(spark, sf), ["o_custkey"], ["day", "o_orderkey"], ["o_orderpriority", "day"]).select(
        F.col("o_custkey").alias("ico"), F.col("o_orderpriority").alias("code"), F.col("day").alias("start")
    )


SQL_AUDIT = """WITH a AS (SELECT o_orderkey AS id, o_orderstatus AS content, CASE WHEN o_orderstatus <> 'O' THEN DATE '2002-01-01' END AS rt,
  o_orderpriority AS p, o_orderstatus AS s FROM orders)
SELECT id, CASE WHEN p = '5-LOW' THEN 'deleted' WHEN p = '4-NOT SPECIFIED' THEN 'content changed'
  WHEN p = '2-HIGH' AND s <> 'O' THEN 'closed version changed' END AS violation FROM a
WHERE p IN ('5-LOW', '4-NOT SPECIFIED') OR (p = '2-HIGH' AND s <> 'O')"""


@registered(SQL_AUDIT)
def append_only_audit(spark: SparkSession, sf: str) -> DataFrame:
    """A next version with deletions, changed content and re-closed rows: all must be reported."""
    o = orders(spark, sf)
    before = o.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("content"), "o_orderpriority",
                      F.when(F.col("o_orderstatus") != "O", F.lit(date(2002, 1, 1))).alias("recorded_to"))
    p = F.col("o_orderpriority")
    after = before.filter(p != "5-LOW").withColumn(
        "content", F.when(p == "4-NOT SPECIFIED", "X").otherwise(F.col("content"))
    ).withColumn("recorded_to", F.when(p.isin("1-URGENT", "2-HIGH"), F.coalesce(
        F.when(p == "2-HIGH", F.lit(date(2003, 1, 1))), F.col("recorded_to"), F.lit(date(2002, 6, 1)))).otherwise(F.col("recorded_to")))
    return H.audit_versions(before, after, "id", ["content"])


# --- persons, addresses, reconciliation ------------------------------------------------------------

SQL_PERSONS = f"""WITH {SQL_SUBJECTS},
p AS (SELECT ico AS person_id, lower(section) AS first_key, lower(name) AS last_key, founded AS born FROM subj WHERE founded IS NOT NULL),
g AS (SELECT first_key, born, count(*) AS members FROM p GROUP BY 1, 2 HAVING min(last_key) <> max(last_key))
"""


def persons(spark: SparkSession, sf: str) -> DataFrame:
    return subjects(spark, sf).select(F.col("ico").alias("person_id"), F.col("section").alias("first"),
                                      F.col("name").alias("last"), F.col("founded").alias("born"))


@registered(SQL_PERSONS + "SELECT p.*, g.members FROM p JOIN g USING (first_key, born)")
def merge_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return H.merge_candidates(persons(spark, sf))


@registered(SQL_PERSONS + """SELECT s.ico AS person_id, s.closed IS NOT NULL OR g.members IS NOT NULL AS candidate,
g.members IS NOT NULL AND s.closed IS NULL AS newly
FROM subj s LEFT JOIN p ON p.person_id = s.ico LEFT JOIN g ON g.first_key = p.first_key AND g.born = p.born""")
def merge_flags(spark: SparkSession, sf: str) -> DataFrame:
    stored = subjects(spark, sf).select(F.col("ico").alias("person_id"), F.col("closed").isNotNull().alias("candidate"))
    return H.flag_merge_candidates(persons(spark, sf), stored)


@registered("""SELECT lower(o_orderpriority) || '|' || lower(o_orderstatus) || '|' || strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS person_key,
arg_max(o_totalprice, CAST(o_custkey AS BIGINT) * 100000000000 - o_orderkey) AS o_totalprice FROM orders GROUP BY 1""")
def latest_person(spark: SparkSession, sf: str) -> DataFrame:
    """Persons = (priority, status, day); the occurrence registered last (customer number as day) wins."""
    o = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("first"), F.col("o_orderstatus").alias("last"), F.to_date("o_orderdate").alias("born"),
        F.date_add(F.lit(date(1900, 1, 1)), F.col("o_custkey").cast("int")).alias("registered"),
        F.col("o_orderkey").alias("pos"), "o_totalprice",
    )
    return H.latest_person(o, ["o_totalprice"])


# --- identities in stored tables: half of the rows come first, all of them after that ----------------

@registered("""SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS ico,
CASE WHEN bool_or(CAST(o_orderdate AS DATE) < DATE '1995-06-01') THEN 'first' ELSE 'second' END AS batch FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1""")
def identity_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Subjects get an identity with the first batch that names them."""
    root, o = work_path(spark, "identities"), orders(spark, sf)
    named = o.select(subject_id(F.col("o_custkey")).alias("ico"), "day")
    for batch, rows in (("first", named.filter(F.col("day") < F.lit(HALF))), ("second", named), ("second", named)):
        T.insert_new(spark, root, "subjects", "ico", rows.select("ico", F.lit(batch).alias("batch")), batch, buckets=4)
    return T.read_part(spark, root, "subjects", T.ROWS)


HALF = date(1995, 6, 1)
SQL_ADDRESS = f"""WITH {SQL_SUBJECTS},
a AS (SELECT CASE WHEN katpo = '110' THEN 'R' || CAST(CAST(ico AS BIGINT) % 100 AS VARCHAR) ELSE 'H' || md5('|||||' || lower(district) || '||CZ|' || lower(forma)) END AS address_key,
  closed IS NOT NULL AS early FROM subj)
"""


@registered(SQL_ADDRESS + """SELECT address_key, md5(address_key) AS address_id, CASE WHEN bool_or(early) THEN 'first' ELSE 'second' END AS batch FROM a GROUP BY 1""")
def address_resolution(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses by registry code where there is one, else by content: each is stored once, with the first batch that has it."""
    none, c = F.lit(None).cast("string"), F.col
    s = subjects(spark, sf).select(
        F.when(c("katpo") == "110", c("ico").cast("bigint") % 100).alias("ruian"), c("closed").isNotNull().alias("early"),
        address_fingerprint(none, none, none, none, none, c("district"), none, F.lit("cz"), c("forma")).alias("fingerprint"))
    root, keyed = work_path(spark, "addresses"), s.withColumn("address_key", address_key()).withColumn("address_id", H.identity("address_key"))
    for batch, rows in (("first", keyed.filter("early")), ("second", keyed)):
        T.insert_new(spark, root, "addresses", "address_id", rows.select("address_key", "address_id", F.lit(batch).alias("batch")), batch, buckets=4)
    return T.read_part(spark, root, "addresses", T.ROWS)


SQL_PERSON_VERSIONS = """WITH o AS (SELECT lower(o_orderpriority) || '|' || lower(o_orderstatus) || '|' || CAST(date_trunc('month', o_orderdate) AS DATE) AS person_key, o_custkey, o_orderkey,
  DATE '1900-01-01' + CAST(o_custkey % 50 AS INTEGER) AS registered, CAST(o_orderdate AS DATE) < DATE '1995-06-01' AS early FROM orders),
b AS (SELECT 1 AS batch, person_key, arg_min(o_custkey, CAST(50 - o_custkey % 50 AS HUGEINT) * 100000000000 + o_orderkey) AS member FROM o WHERE early GROUP BY 2
  UNION ALL SELECT 2, person_key, arg_min(o_custkey, CAST(50 - o_custkey % 50 AS HUGEINT) * 100000000000 + o_orderkey) FROM o GROUP BY 2)
SELECT md5(x.person_key) AS person_id, x.member, x.batch, x.batch = 1 AND EXISTS (SELECT 1 FROM b y WHERE y.batch = 2 AND y.person_key = x.person_key AND y.member <> x.member) AS closed
FROM b x WHERE x.batch = 1 OR NOT EXISTS (SELECT 1 FROM b y WHERE y.batch = 1 AND y.person_key = x.person_key AND y.member = x.member)"""


@registered(SQL_PERSON_VERSIONS, ints=("batch",))
def person_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Persons by their pairing key; the occurrence registered last gives a person's data, the first in source order on
    ties, and a later batch with other data closes the version before."""
    occurrences = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("first"), F.col("o_orderstatus").alias("last"), F.trunc(F.to_date("o_orderdate"), "month").alias("born"),
        F.date_add(F.lit(date(1900, 1, 1)), (F.col("o_custkey") % 50).cast("int")).alias("registered"), F.struct("o_orderkey").alias("pos"),
        F.col("o_custkey").alias("member"), (F.to_date("o_orderdate") < F.lit(HALF)).alias("early"))
    root = work_path(spark, "persons")
    for batch, rows, day in (("1", occurrences.filter("early"), HALF), ("2", occurrences, date(2000, 1, 1))):
        persons = H.latest_person(rows, ["member"]).withColumn("person_id", H.identity("person_key"))
        T.synchronise(spark, root, "persons", "person_id", ["member"], persons, F.lit(day), batch, buckets=4)
    return T.versions(spark, root, "persons").select("person_id", "member", F.col("batch_id").cast("int").alias("batch"), F.col("recorded_to").isNotNull().alias("closed"))


SQL_RECON = f"""WITH {SQL_SUBJECTS},
codes AS (SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS ico, list(DISTINCT substr(o_orderpriority, 1, 1) || o_orderstatus) AS k
          FROM orders WHERE o_orderdate < DATE '1998-01-01' GROUP BY 1),
lastc AS (SELECT ico, code FROM (SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS ico, substr(o_orderpriority, 1, 1) || o_orderstatus AS code,
  row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1),
snap AS (SELECT s.ico, s.closed, s.region, l.code FROM subj s LEFT JOIN lastc l USING (ico) WHERE s.forma <> '101'),
r AS (SELECT s.ico, n.ico IS NOT NULL AS in_snapshot,
  CASE WHEN n.ico IS NOT NULL THEN (s.katpo = '110') = (n.closed IS NOT NULL) END AS state_agrees,
  CASE WHEN n.ico IS NULL THEN NULL WHEN n.code IS NULL OR c.k IS NULL OR n.region = 'R4' THEN 'NELZE'
       WHEN list_contains(c.k, n.code) THEN 'PRESNA'
       WHEN len(list_filter(c.k, lambda x: substr(x, 1, 1) = substr(n.code, 1, 1))) > 0 THEN 'ODDIL' ELSE 'NE' END AS industry_agrees,
  CASE WHEN n.ico IS NOT NULL THEN CASE WHEN s.section = 'A' THEN NULL WHEN s.section = 'B' THEN 'R0' ELSE s.region END = n.region END AS region_agrees
  FROM subj s LEFT JOIN codes c USING (ico) LEFT JOIN snap n ON n.ico = s.ico)
"""


def reconciled(spark: SparkSession, sf: str) -> DataFrame:
    o = orders(spark, sf)
    code = F.concat(F.substring("o_orderpriority", 1, 1), F.col("o_orderstatus"))
    ico = subject_id(F.col("o_custkey")).alias("ico")
    listed = o.filter(F.col("day") < F.lit(date(1998, 1, 1))).groupBy(ico).agg(F.collect_set(code).alias("core_codes"))
    last = o.groupBy(ico).agg(F.max_by(code, F.struct("day", "o_orderkey")).alias("main_code"))
    s = subjects(spark, sf)
    core = s.select("ico", (F.col("katpo") == "110").alias("core_closed"),
                    F.when(F.col("section") == "A", None).when(F.col("section") == "B", "R0").otherwise(F.col("region"))
                    .alias("core_region")).join(listed, "ico", "left")
    snap = s.filter(F.col("forma") != "101").select("ico", "closed", "region", (F.col("region") == "R4").alias("pseudo")).join(
        last, "ico", "left")
    return R.reconcile(core, snap, prefix=1)


@registered(SQL_RECON + "SELECT * FROM r")
def reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    return reconciled(spark, sf)


@registered(SQL_RECON + """SELECT count(*) AS subjects, count(*) FILTER (WHERE in_snapshot) AS in_snapshot,
count(*) FILTER (WHERE NOT in_snapshot) AS not_in_snapshot, count(*) FILTER (WHERE state_agrees) AS state_ok,
count(*) FILTER (WHERE NOT state_agrees) AS state_differs, count(*) FILTER (WHERE industry_agrees = 'PRESNA') AS industry_presna,
count(*) FILTER (WHERE industry_agrees = 'ODDIL') AS industry_oddil, count(*) FILTER (WHERE industry_agrees = 'NE') AS industry_ne,
count(*) FILTER (WHERE industry_agrees = 'NELZE') AS industry_nelze, count(*) FILTER (WHERE region_agrees) AS region_ok,
count(*) FILTER (WHERE NOT region_agrees) AS region_differs,
count(*) FILTER (WHERE in_snapshot AND region_agrees IS NULL) AS region_unknown FROM r""")
def reconciliation_summary(spark: SparkSession, sf: str) -> DataFrame:
    return R.reconcile_summary(reconciled(spark, sf))


# --- current state of the core ---------------------------------------------------------------------

SQL_CORE = f"""WITH {SQL_SUBJECTS},
cur AS (SELECT ico, name, forma, closed, district FROM subj WHERE founded <= DATE '2000-06-30' AND (closed IS NULL OR DATE '2000-06-30' < closed)),
seat AS (SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS ico, o_orderpriority AS town FROM (SELECT *, lead(d) OVER (PARTITION BY o_custkey ORDER BY d) AS nxt FROM (
   SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, max_by(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY 1, 2))
   WHERE d <= DATE '2000-06-30' AND (nxt IS NULL OR DATE '2000-06-30' < nxt))
"""


def core_now(spark: SparkSession, sf: str) -> DataFrame:
    """Subjects in force on one day, with form and seat; a seat holds from an order day to the next one."""
    s = subjects(spark, sf)
    null = lambda t: F.lit(None).cast(t)
    meta = [F.lit(date(2002, 1, 1)).alias("recorded_from"), null("date").alias("recorded_to"), F.lit(1).alias("batch_id")]
    versions = s.select("ico", "name", F.col("forma").alias("form_code"), F.col("founded").alias("start"), F.col("closed").alias("end"), *meta)
    days = orders(spark, sf).select(subject_id(F.col("o_custkey")).alias("ico"), F.col("day").alias("start"), null("date").alias("end"),
                                    F.col("o_orderpriority").alias("town"), F.col("o_orderkey").alias("pos"))
    clipped = W.clip_overlaps(days, ["ico"], ["town"])
    seats = clipped.select("ico", F.lit("SIDLO").alias("kind"), F.col("town").alias("address_id"), "start", "end", *meta)
    addresses = clipped.select(F.col("town").alias("address_id"), "town", F.lit("0").alias("zip"), F.col("town").alias("original")).distinct()
    forms = s.select(F.col("forma").alias("code"), F.concat(F.lit("form "), "forma").alias("name")).distinct()
    return R.current_subjects(versions, seats, addresses, forms, F.lit(date(2000, 6, 30)))


@registered(SQL_CORE + "SELECT ico, name, forma AS form_code, 'form ' || forma AS form_name, town FROM cur LEFT JOIN seat USING (ico)")
def current_subjects(spark: SparkSession, sf: str) -> DataFrame:
    return core_now(spark, sf).select("ico", "name", "form_code", "form_name", "town")


@registered(SQL_CORE + """, rel AS (SELECT s.ico, CASE WHEN s.section = 'A' THEN 'OSOBA' WHEN s.section = 'B' THEN 'SUBJEKT' ELSE 'POJMENOVANY' END AS member_kind,
  s.division, m.ico AS member_ico, s.section, s.region FROM subj s LEFT JOIN subj m ON m.ico = lpad(CAST(CAST(s.ico AS BIGINT) + 1 AS VARCHAR), 8, '0') WHERE s.founded <= DATE '2000-06-30')
SELECT rel.ico, o.name AS subject_name, member_kind, CASE member_kind WHEN 'OSOBA' THEN 'Ing. ' || rel.division || ' ' || rel.region
  WHEN 'SUBJEKT' THEN m.name ELSE 'Foreign ' || rel.division END AS member_display
FROM rel LEFT JOIN cur o ON o.ico = rel.ico LEFT JOIN cur m ON m.ico = rel.member_ico""")
def current_relations(spark: SparkSession, sf: str) -> DataFrame:
    """Each subject has one member: a person, its neighbour by number, or a named foreign entity."""
    s = subjects(spark, sf)
    c = F.col
    null = lambda t: F.lit(None).cast(t)
    meta = [F.lit(date(2002, 1, 1)).alias("recorded_from"), null("date").alias("recorded_to"), F.lit(1).alias("batch_id")]
    relations = s.select(
        "ico", F.when(c("section") == "A", F.xxhash64("ico")).alias("member_person"),
        F.when(c("section") == "B", subject_id(c("ico").cast("bigint") + 1)).alias("member_ico"),
        F.when(~c("section").isin("A", "B"), F.concat(F.lit("Foreign "), "division")).alias("member_name"),
        c("section").alias("role_code"), c("founded").alias("start"), null("date").alias("end"), *meta)
    persons = s.filter(c("section") == "A").select(
        F.xxhash64("ico").alias("person_id"), F.lit("Ing.").alias("title_before"), c("division").alias("first"), c("region").alias("last"),
        null("string").alias("title_after"))
    roles = s.select(c("section").alias("code"), F.lit("member").alias("name")).distinct()
    return R.current_relations(relations, roles, core_now(spark, sf), persons, F.lit(date(2000, 6, 30))).select(
        "ico", "subject_name", "member_kind", "member_display")
