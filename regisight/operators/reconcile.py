"""Identity core against the latest snapshot, and the current-state views of the core."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regisight.functions.codes import valid_at


def reconcile(core: DataFrame, snapshot: DataFrame, prefix: int = 2) -> DataFrame:
    """core(ico, core_closed, core_codes, core_region) against snapshot(ico, closed, main_code, region,
    pseudo). Agreement of state, industry and region; NULL where it cannot be compared."""
    s = snapshot.select("ico", F.col("closed").isNotNull().alias("snap_closed"), F.col("main_code").alias("snap_code"),
                        F.col("region").alias("snap_region"), F.coalesce("pseudo", F.lit(False)).alias("_pseudo"),
                        F.lit(True).alias("_in"))
    j = core.join(s, "ico", "left")
    inside = F.col("_in").isNotNull()
    c = F.col
    same_branch = F.exists("core_codes", lambda k: F.substring(k, 1, prefix) == F.substring(c("snap_code"), 1, prefix))
    industry = (
        F.when(~inside, None)
        .when(c("snap_code").isNull() | c("core_codes").isNull() | c("_pseudo"), "NELZE")
        .when(F.array_contains("core_codes", c("snap_code")), "PRESNA")
        .when(same_branch, "ODDIL")
        .otherwise("NE")
    )
    return j.select(
        "ico", inside.alias("in_snapshot"),
        F.when(inside, c("core_closed") == c("snap_closed")).alias("state_agrees"),
        industry.alias("industry_agrees"),
        F.when(inside, c("core_region") == c("snap_region")).alias("region_agrees"),
    )


def reconcile_summary(checked: DataFrame) -> DataFrame:
    c = F.col
    return checked.agg(
        F.count(F.lit(1)).alias("subjects"),
        F.count_if("in_snapshot").alias("in_snapshot"), F.count_if(~c("in_snapshot")).alias("not_in_snapshot"),
        F.count_if("state_agrees").alias("state_ok"), F.count_if(~c("state_agrees")).alias("state_differs"),
        *[F.count_if(c("industry_agrees") == v).alias(f"industry_{v.lower()}") for v in ("PRESNA", "ODDIL", "NE", "NELZE")],
        F.count_if("region_agrees").alias("region_ok"), F.count_if(~c("region_agrees")).alias("region_differs"),
        F.count_if(c("in_snapshot") & c("region_agrees").isNull()).alias("region_unknown"),
    )


def _now(df: DataFrame, day: Column) -> DataFrame:
    return df.filter(F.col("recorded_to").isNull() & valid_at(F.col("start"), F.col("end"), day))


def current_subjects(versions: DataFrame, seats: DataFrame, addresses: DataFrame, forms: DataFrame, day: Column) -> DataFrame:
    """Subject with its current version, legal form and seat."""
    seat = _now(seats.filter(F.col("kind") == "SIDLO"), day).select("ico", "address_id")
    return (
        _now(versions, day).drop("start", "end", "recorded_from", "recorded_to", "batch_id")
        .join(forms.select(F.col("code").alias("form_code"), F.col("name").alias("form_name")), "form_code", "left")
        .join(seat, "ico", "left")
        .join(addresses.select("address_id", "town", "zip", F.col("original").alias("seat_text")), "address_id", "left")
    )


def current_persons(persons: DataFrame, day: Column) -> DataFrame:
    return _now(persons, day).drop("start", "end", "recorded_from", "recorded_to", "batch_id")


def current_relations(relations: DataFrame, roles: DataFrame, subjects: DataFrame, persons: DataFrame, day: Column) -> DataFrame:
    """Relation with the display name of its member: a person, a subject or a named foreign entity."""
    person = persons.select(
        F.col("person_id").alias("member_person"),
        F.concat_ws(" ", "title_before", "first", "last", "title_after").alias("_person"),
    )
    member = subjects.select(F.col("ico").alias("member_ico"), F.col("name").alias("_member"))
    owner = subjects.select("ico", F.col("name").alias("subject_name"))
    kind = (
        F.when(F.col("member_person").isNotNull(), "OSOBA").when(F.col("member_ico").isNotNull(), "SUBJEKT")
        .otherwise("POJMENOVANY")
    )
    shown = F.coalesce(F.nullif("_person", F.lit("")), F.col("_member"), F.col("member_name"))
    return (
        _now(relations, day).join(roles.select(F.col("code").alias("role_code"), F.col("name").alias("role_name")), "role_code")
        .join(owner, "ico", "left").join(person, "member_person", "left").join(member, "member_ico", "left")
        .withColumn("member_kind", kind).withColumn("member_display", shown).drop("_person", "_member")
    )
