"""Identity core: registry records into versioned tables of subjects, seats, relations and persons."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regisight.functions.text import address_fingerprint, person_key
from regisight.operators import history as H
from regisight.operators import rules as R
from regisight.operators import temporal as W
from regisight.session import materialise
from regisight.sources import buckets as T
from regisight.sources import registry as G
from regisight.sources import tables as B

VERSION_CONTENT = ["name", "form_code", "state", "in_liquidation", "insolvent", "founded", "closed", "tax_id", "file_mark", "capital",
                   "currency", "nace", "updated", "start", "end"]
SEAT_CONTENT = ["kind", "address_id", "start", "end"]
RELATION_CONTENT = ["member_person", "member_ico", "member_name", "member_state", "role_code", "organ", *G.SHARE_FIELDS, "start", "end",
                    "registered", "deleted"]
PERSON = ["first", "last", "title_before", "title_after", "born", "citizenship"]


def address_key() -> Column:
    return F.coalesce(F.concat(F.lit("R"), F.col("ruian").cast("string")), F.concat(F.lit("H"), F.col("fingerprint")))


def import_records(spark: SparkSession, root: str, raw: DataFrame, batch_id: str | None = None, buckets: int = 64) -> dict[str, DataFrame]:
    """raw(base_json, history_json): maps, checks and stores a batch of records. Running it again with the
    same records closes and inserts nothing; running it again with the same batch_id stores nothing at all, also
    when the first run was lost half way. Each table reads and replaces only the buckets of the batch's keys.
    Returns the side outputs: notes, rejected, overlaps."""
    c = F.col
    with B.batch(spark, root, "registry", batch_id=batch_id) as b:
        raw.write.mode("overwrite").parquet(f"{root}/raw/batch={b.batch_id}")  # kept even if mapping fails
        now = F.lit(datetime.now(timezone.utc).replace(tzinfo=None))
        out = G.map_subjects(spark.read.schema(raw.schema).parquet(f"{root}/raw/batch={b.batch_id}"))
        found, broken = R.split_valid(
            materialise(out["versions"], "versions"),
            {"id": c("ico").rlike(R.ID), **R.period_rules(), "tax_id": c("tax_id").rlike("^CZ[0-9]{8,10}$")})
        overlaps = W.overlap_violations(found, ["ico"])
        subjects = found.select("ico").distinct()
        seats = materialise(out["seats"], "seats").withColumn("state", F.coalesce("state", F.lit("CZ"))).withColumn("fingerprint", address_fingerprint(
            c("street"), c("house"), c("registration"), c("orientation"), c("town"), c("town_part"), c("zip"), c("state"), c("original"))
        ).withColumn("address_key", address_key()).withColumn("address_id", H.identity("address_key"))
        relations = materialise(out["relations"], "relations").withColumn("person_key", F.when(
            c("member_kind") == "OSOBA", person_key(c("first"), c("last"), c("born")))).withColumn("member_person", H.identity("person_key"))
        persons = H.latest_person(relations.filter(c("person_key").isNotNull()).withColumn("pos", F.struct("ico", "pos")), PERSON).withColumn(
            "member_person", H.identity("person_key"))
        identities = subjects.unionByName(relations.select(c("member_ico").alias("ico")))
        T.insert_new(spark, root, "addresses", "address_id", seats.drop("ico", "kind", "start", "end"), b.batch_id, buckets)
        T.insert_new(spark, root, "subjects", "ico", identities, b.batch_id, buckets)
        for name, key, content, rows, keys in (
                ("subject_versions", "ico", VERSION_CONTENT, found, subjects), ("subject_seats", "ico", SEAT_CONTENT, seats, subjects),
                ("relations", "ico", RELATION_CONTENT, relations, subjects), ("person_versions", "member_person", PERSON, persons, persons)):
            T.synchronise(spark, root, name, key, content, rows, now, b.batch_id, keys, buckets)
        b.rows = found.count()
    return {"notes": out["notes"], "rejected": out["rejected"], "broken": broken, "overlaps": overlaps}
