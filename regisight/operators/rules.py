"""Row rules: one pass counts violations, a side output keeps the rejected rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID = "^[0-9]{8}$"


def violation_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows per violated rule. As with a CHECK constraint, a rule that is NULL holds."""
    counts = df.agg(*[F.count_if(~F.coalesce(r, F.lit(True))).alias(n) for n, r in rules.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules])
    return counts.select(F.inline(rows))


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with the names of the violated rules)."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(r, F.lit(True)), F.lit(n)) for n, r in rules.items()]))
    marked = df.withColumn("violated", broken)
    return marked.filter(F.size("violated") == 0).drop("violated"), marked.filter(F.size("violated") > 0)


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once; NULLs count as equal."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def period_rules(start: str = "start", end: str = "end") -> dict[str, Column]:
    return {"from_not_after_to": F.col(start) <= F.col(end)}


def version_rules() -> dict[str, Column]:
    """Versions of a subject."""
    c = F.col
    return {
        "id": c("ico").rlike(ID), **period_rules(), "recorded_order": c("recorded_from") <= c("recorded_to"),
        "closed_after_founded": c("founded") <= c("closed"), "tax_id": c("tax_id").rlike("^CZ[0-9]{8,10}$"),
        "currency": c("currency").rlike("^[A-Z]{3}$"),
    }


def relation_rules() -> dict[str, Column]:
    """Relations: exactly one kind of member, a named one with its state, percents in range, no self-membership."""
    c = F.col
    kinds = sum((F.when(c(k).isNotNull(), 1).otherwise(0) for k in ("member_person", "member_ico", "member_name")), F.lit(0))
    return {
        "one_member": kinds == 1, "name_with_state": c("member_name").isNull() == c("member_state").isNull(),
        "state": c("member_state").rlike("^[A-Z]{2}$"), "currency": c("deposit_currency").rlike("^[A-Z]{3}$"),
        "registered_order": c("registered") <= c("deleted"),
        "share": c("share_percent").between(0, 100), "paid": c("paid_percent").between(0, 100),
        "not_itself": c("member_ico") != c("ico"), **period_rules(),
    }


def address_rules() -> dict[str, Column]:
    c = F.col
    return {"state": c("state").rlike("^[A-Z]{2}$"), "one_number": c("house").isNull() | c("registration").isNull()}


def code_rules() -> dict[str, Column]:
    """Codes of subjects: known version and kind, certainty in range, a derived row has a code or a flag."""
    c = F.col
    return {
        "version": c("version").isin(2008, 2025), "level": c("level").between(1, 5), "certainty": c("certainty").between(0, 1),
        "code_or_flag": c("code").isNotNull() | c("flag").isNotNull(), **period_rules(),
    }
