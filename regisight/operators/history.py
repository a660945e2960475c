"""Bitemporal maintenance. Every operator returns the next version of a table; nothing is updated in
place, and the audit compares the next version with the previous one before it is published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regisight.functions import fixed as X
from regisight.functions.codes import code_level, end_2025, start_2025, valid_at
from regisight.functions.text import person_key, plain_text, row_hash

KEEP, CLOSE, INSERT = "keep", "close", "insert"


# --- versions by content hash ----------------------------------------------------------------------

def synchronise(current: DataFrame, new: DataFrame, key: str, content: list[str], now: Column,
                batch: Column, batch_keys: DataFrame | None = None) -> DataFrame:
    """current = open rows (key, content, recorded_from, batch_id); new = rows of this batch.

    Hashes that vanished for a key of the batch are closed now, new hashes are inserted, equal ones
    stay; keys outside the batch are not touched. A second run with the same input closes and inserts
    nothing. Joined on (key, hash), so a key with very many rows still spreads."""
    known = current.withColumn("_h", row_hash(content))
    fresh = new.select(key, *content).withColumn("_h", row_hash(content)).dropDuplicates([key, "_h"])
    touched = (batch_keys if batch_keys is not None else new).select(F.col(key).alias("_k")).distinct()
    left = known.join(touched, F.col(key) == F.col("_k"), "left")
    right = fresh.select(F.col(key).alias("_nk"), F.col("_h").alias("_nh"), *[F.col(c).alias(f"_n_{c}") for c in content])
    j = left.join(right, (F.col(key) == F.col("_nk")) & (F.col("_h") == F.col("_nh")), "full_outer")
    is_new, is_old = F.col("_h").isNull(), F.col("_nh").isNull()
    action = F.when(is_new, INSERT).when(is_old & F.col("_k").isNotNull(), CLOSE).otherwise(KEEP)
    return j.select(
        F.coalesce(F.col(key), F.col("_nk")).alias(key),
        *[F.when(is_new, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) for c in content],
        F.when(is_new, now).otherwise(F.col("recorded_from")).alias("recorded_from"),
        F.when(action == CLOSE, now).alias("recorded_to"),
        F.when(is_new, batch).otherwise(F.col("batch_id")).alias("batch_id"),
        action.alias("action"),
    )


def new_identities(existing: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Identities to create, also for members without data of their own."""
    return wanted.select(key).filter(F.col(key).isNotNull()).distinct().join(existing.select(key), key, "left_anti")


def resolve_addresses(addresses: DataFrame, known: DataFrame) -> DataFrame:
    """New immutable addresses: keyed by registry code where known, else by content fingerprint.
    addresses(ruian, fingerprint, ...); known(address_key)."""
    key = F.coalesce(F.concat(F.lit("R"), F.col("ruian").cast("string")), F.concat(F.lit("H"), F.col("fingerprint")))
    keyed = addresses.withColumn("address_key", key).dropDuplicates(["address_key"])
    return keyed.join(known.select("address_key"), "address_key", "left_anti").withColumn("address_id", identity("address_key"))


def identity(key: str) -> Column:
    """128-bit id of a natural key: the same in every batch, without a counter and, at any size, without collisions."""
    return F.md5(F.col(key))


def latest_person(occurrences: DataFrame, attributes: list[str]) -> DataFrame:
    """Attributes of each person from the latest registered occurrence; the first one in source order on ties.
    occurrences(first, last, born, registered, pos, attributes...); pos is any type that sorts in source order."""
    key = person_key(F.col("first"), F.col("last"), F.col("born"))
    latest_first = F.struct(-F.unix_date(F.coalesce("registered", F.lit("0001-01-01").cast("date"))), F.col("pos"))
    return occurrences.groupBy(key.alias("person_key")).agg(
        F.min_by(F.struct(*attributes), latest_first).alias("a")
    ).select("person_key", "a.*")


def merge_candidates(persons: DataFrame) -> DataFrame:
    """Persons sharing first name and birth day while having different surnames, as groups: every member
    once, with the size of its group. Equivalent to the list of pairs without ever building the pairs.
    persons(person_id, first, last, born); rows without a birth day are no candidates."""
    p = persons.filter(F.col("born").isNotNull()).select(
        "person_id", plain_text(F.col("first")).alias("first_key"), plain_text(F.col("last")).alias("last_key"), "born"
    )
    groups = p.groupBy("first_key", "born").agg(
        F.min("last_key").alias("low"), F.max("last_key").alias("high"), F.count(F.lit(1)).alias("members")
    ).filter(F.col("low") != F.col("high")).select("first_key", "born", "members")
    # the pair needs another surname than one's own: true for every member once two surnames exist
    return p.join(groups, ["first_key", "born"])


def flag_merge_candidates(persons: DataFrame, flagged: DataFrame) -> DataFrame:
    """Monotone flag: set for candidates, never unset; newly = flagged by this run."""
    found = merge_candidates(persons).select("person_id").distinct().withColumn("_c", F.lit(True))
    j = flagged.join(found, "person_id", "left")
    now = F.coalesce("_c", F.lit(False))
    return j.select("person_id", (F.col("candidate") | now).alias("candidate"), (now & ~F.col("candidate")).alias("newly"))


# --- codes of subjects over time -------------------------------------------------------------------

CODE_COLUMNS = ["ico", "version", "code", "level", "kind", "source", "detail", "certainty", "flag", "candidates",
                "derived_from", "start", "end", "close_reason", "batch_id"]


def staged_main(snapshot: DataFrame, version: int, column: str) -> DataFrame:
    """Main codes of a snapshot with their validity: from the update (or snapshot) day, not after the
    closing day; 2025 codes not before 2025-01-01."""
    start = F.least(F.coalesce("updated", "snapshot"), F.col("closed"))
    end = F.col("closed")
    if version == 2025:
        start, end = start_2025(start), end_2025(end)
    return snapshot.filter(F.col(column).isNotNull()).select(
        "ico", F.col(column).alias("code"), start.alias("start"), end.alias("end")
    )


def staged_secondary(snapshot: DataFrame, activities: DataFrame, version: int, column: str) -> DataFrame:
    """Secondary codes: all codes of the activity file of one version except the main one."""
    main = staged_main(snapshot.withColumn("_all", F.lit("x")), version, "_all").drop("code")
    own = snapshot.select("ico", F.col(column).alias("_main"))
    codes = activities.filter(F.col("code").isNotNull()).select("ico", "code").distinct()
    return codes.join(main, "ico").join(own, "ico").filter(~F.col("code").eqNullSafe(F.col("_main"))).drop("_main")


def snapshot_scope(snapshot: DataFrame) -> DataFrame:
    """All subjects of a snapshot with the day that closes a code the snapshot no longer lists."""
    return snapshot.select("ico", F.coalesce("closed", "updated", "snapshot").alias("end_day"), F.col("closed").alias("gone"))


def apply_codes(history: DataFrame, staged: DataFrame, scope: DataFrame, version: int, kind: str, detail: Column,
                batch: Column) -> DataFrame:
    """Next version of one (version, kind) slice of the official code history.

    Open codes of subjects in scope close when the source dropped them or the subject closed, never
    before their own start; staged codes are inserted unless the same code is open, ends on the same
    day or starts on the same day. The two sides meet on (ico, code)."""
    c = F.col
    slice_ = history.filter((c("version") == version) & (c("kind") == kind) & (c("source") == X.OFFICIAL))
    s = staged.select(c("ico"), c("code"), c("start").alias("_s"), c("end").alias("_e"), F.lit(True).alias("_listed"))
    j = slice_.join(s, ["ico", "code"], "left").join(scope, "ico", "left")
    listed = F.coalesce("_listed", F.lit(False))
    end_day = F.when(listed, c("_e")).otherwise(c("end_day"))
    closes = c("end").isNull() & (listed | c("end_day").isNotNull()) & end_day.isNotNull()
    reason = F.when(listed | c("gone").isNotNull(), X.REASON_CLOSED).otherwise(F.lit(X.REASON_DROPPED))
    updated = j.select(
        *[x for x in CODE_COLUMNS if x not in ("end", "close_reason")],
        F.when(closes, F.greatest(end_day, c("start"))).otherwise(c("end")).alias("end"),
        F.when(closes, reason).otherwise(c("close_reason")).alias("close_reason"),
        F.when(closes, CLOSE).otherwise(KEEP).alias("action"),
    )
    seen = updated.select(c("ico").alias("_i"), c("code").alias("_c"), c("start").alias("_fs"), c("end").alias("_fe"))
    missing = staged.join(
        seen,
        (c("ico") == c("_i")) & (c("code") == c("_c"))
        & (c("_fe").isNull() | (c("_fe") == c("end")) | (c("_fs") == c("start"))),
        "left_anti",
    )
    inserted = missing.select(
        "ico", F.lit(version).alias("version"), "code", code_level(c("code")).alias("level"), F.lit(kind).alias("kind"),
        F.lit(X.OFFICIAL).alias("source"), detail.alias("detail"), F.lit(1).cast("decimal(5,4)").alias("certainty"),
        F.lit(None).cast("string").alias("flag"), F.lit(None).cast("array<string>").alias("candidates"),
        F.lit(None).cast("string").alias("derived_from"), "start", "end",
        F.when(c("end").isNotNull(), X.REASON_CLOSED).alias("close_reason"), batch.alias("batch_id"),
        F.lit(INSERT).alias("action"),
    )
    return updated.select(*CODE_COLUMNS, "action").unionByName(inserted.select(*CODE_COLUMNS, "action"))


def staged_from_record(records: DataFrame, version: int, end_dual: bool = False) -> tuple[DataFrame, DataFrame]:
    """Main and secondary codes of registry records(ico, main, codes, updated, closed), staged for
    apply_codes. After the end of dual coding nothing of the old version is staged."""
    start, end = F.least("updated", "closed"), F.col("closed")
    if version == 2025:
        start = F.when(start < F.lit(X.START_2025), F.lit(X.START_2025)).otherwise(start)
        end = end_2025(end)
    rows = records.filter(F.lit(not end_dual))
    main = rows.filter(F.col("main").isNotNull()).select("ico", F.col("main").alias("code"), start.alias("start"), end.alias("end"))
    rest = F.array_except(F.col("codes"), F.array_compact(F.array("main")))
    secondary = rows.select("ico", F.explode(rest).alias("code"), start.alias("start"), end.alias("end"))
    return main, secondary


def end_dual_coding(history: DataFrame) -> DataFrame:
    """Closes every open official 2008 code at the last day of dual coding."""
    hit = (F.col("source") == X.OFFICIAL) & (F.col("version") == 2008) & F.col("end").isNull()
    return history.withColumn("close_reason", F.when(hit, X.REASON_END_2008).otherwise(F.col("close_reason"))).withColumn(
        "end", F.when(hit, F.greatest(F.lit(X.END_DUAL_CODING), F.col("start"))).otherwise(F.col("end"))
    )


def dual_coding_ended(snapshot: DataFrame) -> Column:
    """Scalar: the snapshot lies after the last day, or lists no 2008 code at all."""
    facts = snapshot.agg(((F.max("snapshot") > F.lit(X.END_DUAL_CODING)) | (F.count("nace") == 0)).alias("ended"))
    return facts.select("ended").scalar()


def code_at(history: DataFrame, day: Column, version: int = 2025, kind: str = X.MAIN) -> DataFrame:
    """Code of each subject valid at a day, official before derived; for derived codes the deepest level."""
    rows = history.filter((F.col("version") == version) & (F.col("kind") == kind) & F.col("code").isNotNull()
                          & valid_at(F.col("start"), F.col("end"), day))
    order = F.struct((F.col("source") == X.OFFICIAL).cast("int"), F.coalesce("start", F.lit("0001-01-01").cast("date")),
                     "level", "code")
    return rows.groupBy("ico").agg(F.max_by(F.struct("code", "level", "source", "certainty", "start", "end"), order).alias("c")).select(
        "ico", "c.*"
    )


# --- audits before a table version is published ---------------------------------------------------

def audit_versions(previous: DataFrame, following: DataFrame, key: str, content: list[str]) -> DataFrame:
    """Forbidden differences of a bitemporal table: deleted rows, changed content, a second closing.
    Allowed: new rows, and filling recorded_to of an open row."""
    a = previous.select(key, F.struct(*content).alias("_a"), F.col("recorded_to").alias("_at"), F.lit(True).alias("_in_a"))
    b = following.select(key, F.struct(*content).alias("_b"), F.col("recorded_to").alias("_bt"), F.lit(True).alias("_in_b"))
    j = a.join(b, key, "left")
    problem = (
        F.when(F.col("_in_b").isNull(), "deleted")
        .when(~F.col("_a").eqNullSafe(F.col("_b")), "content changed")
        .when(F.col("_at").isNotNull() & ~F.col("_at").eqNullSafe(F.col("_bt")), "closed version changed")
    )
    return j.select(key, problem.alias("violation")).filter(F.col("violation").isNotNull())


def audit_codes(previous: DataFrame, following: DataFrame, key: list[str]) -> DataFrame:
    """Forbidden differences of the official code history. Allowed: closing an open code, adding a
    missing reason, shifting a 2025 code to 2025-01-01. Derived codes may be replaced."""
    own = [x for x in ("version", "code", "level", "kind", "source", "certainty")]
    official = previous.filter(F.col("source") == X.OFFICIAL)
    b = following.select(*key, F.struct(*own).alias("_b"), F.col("start").alias("_bs"), F.col("end").alias("_be"),
                         F.col("close_reason").alias("_br"), F.lit(True).alias("_in"))
    j = official.join(b, key, "left")
    c = F.col
    same = F.struct(*own).eqNullSafe(c("_b")) & c("start").eqNullSafe(c("_bs"))
    end_same, reason_same = c("end").eqNullSafe(c("_be")), c("close_reason").eqNullSafe(c("_br"))
    closes = same & c("end").isNull() & c("_be").isNotNull()
    explains = same & end_same & (reason_same | c("close_reason").isNull())
    shifts = (
        F.struct(*own).eqNullSafe(c("_b")) & (c("version") == 2025) & (c("start") < F.lit(X.START_2025))
        & (c("_bs") == F.lit(X.START_2025)) & c("_be").eqNullSafe(end_2025(c("end"))) & reason_same
    )
    allowed = F.coalesce(closes | explains | shifts, F.lit(False))
    return j.select(*key, F.when(c("_in").isNull(), "deleted").when(~allowed, "changed").alias("violation")).filter(
        c("violation").isNotNull()
    )
