"""Model estimates by size class: counts, allocation of value added, publication groups, consistency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regisight.functions import fixed as X
from regisight.functions.codes import person_type, size_class

BASIC, PROPORTIONAL = "basic", "proportional"
SMALLEST = X.SIZE_CLASSES[0]


def class_order(c: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in X.SIZE_CLASSES]), c)


def class_counts(subjects: DataFrame, by: list[str], weight: Column | None = None) -> DataFrame:
    """Subjects per class in two variants: unknown size to the smallest class, or in proportion to the
    known structure of natural / legal persons. One row per key and class, all five classes. Rows may
    be counts already, with their number as weight."""
    c = F.col
    counted = subjects.groupBy(*by, person_type(c("forma")).alias("person"), size_class(c("katpo")).alias("cls")).agg(
        F.sum(F.lit(1) if weight is None else weight).alias("n"))
    wide = counted.groupBy(*by, "person").agg(
        F.coalesce(F.sum(F.when(c("cls").isNull(), c("n"))), F.lit(0)).alias("unknown"),
        F.coalesce(F.sum(F.when(c("cls").isNotNull(), c("n"))), F.lit(0)).alias("known"),
        *[F.coalesce(F.sum(F.when(c("cls") == k, c("n"))), F.lit(0)).alias(k) for k in X.SIZE_CLASSES],
    )
    rows = F.array(*[F.struct(F.lit(k).alias("cls"), c(f"`{k}`").alias("own")) for k in X.SIZE_CLASSES])
    long = wide.select(*by, "person", "unknown", "known", F.inline(rows))
    to_smallest = F.when(c("cls") == SMALLEST, c("unknown")).otherwise(0)
    spread = F.when(c("known") == 0, to_smallest).otherwise(c("unknown") * c("own").cast("double") / c("known"))
    return long.groupBy(*by, "cls").agg(
        F.sum(c("own") + to_smallest).cast("double").alias(BASIC), F.sum(c("own") + spread).alias(PROPORTIONAL))


def allocate(counts: DataFrame, inputs: DataFrame, survey: DataFrame, by: list[str], nace: str) -> DataFrame:
    """Value added of a territory split over its classes: weight = active subjects x value added per
    enterprise of the class; turnover by the state ratio of the class. Both variants side by side.

    counts(by, cls, basic, proportional), inputs(by, active_share, gva), survey(nace, cls, ent, av, tur)."""
    j = counts.join(inputs, by).join(survey, [nace, "cls"])
    w = Window.partitionBy(*by)  # five classes
    for v in (BASIC, PROPORTIONAL):
        j = j.withColumn(f"w_{v}", F.col(v) * F.col("active_share") * F.col("av") / F.col("ent"))
    for v in (BASIC, PROPORTIONAL):
        j = j.withColumn(f"gva_{v}", F.col("gva") * F.col(f"w_{v}") / F.sum(f"w_{v}").over(w)).withColumn(
            f"tur_{v}", F.col(f"gva_{v}") * F.col("tur") / F.col("av"))
    return j.drop("w_basic", "w_proportional")


def concentration(allocated: DataFrame, by: list[str]) -> DataFrame:
    """Share of classes with 10+ and 50+ persons on value added and turnover, as a band of the variants."""
    c = F.col

    def share(measure: str, classes: tuple[str, ...]) -> Column:
        return 100 * F.sum(F.when(c("cls").isin(*classes), c(measure)).otherwise(0.0)) / F.sum(measure)

    out = []
    for label, classes in (("10", X.SIZE_CLASSES[1:]), ("50", X.SIZE_CLASSES[3:])):
        for m in ("gva", "tur"):
            a, b = share(f"{m}_{BASIC}", classes), share(f"{m}_{PROPORTIONAL}", classes)
            out += [F.round(F.least(a, b), 1).alias(f"{m}_{label}_lo"), F.round(F.greatest(a, b), 1).alias(f"{m}_{label}_hi")]
    return allocated.groupBy(*by).agg(*out)


def publication_groups(counts: DataFrame, by: list[str], threshold: int = X.MIN_CELL) -> DataFrame:
    """Classes below the threshold (in the smaller variant) merge upward, an unfinished rest merges
    down. The five classes of a key are folded as one sorted array. Result: (by, cls, grp)."""
    c = F.col
    per_key = counts.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(
        class_order(c("cls")).cast("int").alias("o"), "cls", F.least(BASIC, PROPORTIONAL).alias("n")))).alias("classes"))
    start = F.struct(F.lit(0).alias("grp"), F.lit(0.0).cast("double").alias("open"),
                     F.array().cast("array<struct<cls:string,grp:int>>").alias("out"))

    def step(acc, k):
        total = acc["open"] + k["n"]
        full = total >= threshold
        placed = F.array_append(acc["out"], F.struct(k["cls"].alias("cls"), acc["grp"].alias("grp")))
        return F.struct(F.when(full, acc["grp"] + 1).otherwise(acc["grp"]).alias("grp"),
                        F.when(full, 0.0).otherwise(total).alias("open"), placed.alias("out"))

    def finish(acc):
        # an open last group joins the one before it
        last = F.when((acc["open"] > 0) | (F.element_at(acc["out"], -1)["grp"] == acc["grp"]), acc["grp"])
        return F.transform(acc["out"], lambda x: F.struct(
            x["cls"].alias("cls"), F.when((x["grp"] == last) & (x["grp"] > 0), x["grp"] - 1).otherwise(x["grp"]).alias("grp")))

    return per_key.select(*by, F.inline(F.aggregate("classes", start, step, finish)))


def estimate_table(allocated: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """Published bands per group of classes: value added, its share, turnover."""
    c = F.col
    g = allocated.join(groups, [*by, "cls"]).groupBy(*by, "grp").agg(
        F.concat_ws("+", F.transform(F.array_sort(F.collect_list(F.struct(class_order(c("cls")).alias("o"), "cls"))), lambda s: s["cls"]))
        .alias("classes"),
        *[F.sum(f"{m}_{v}").alias(f"{m}_{v}") for m in ("gva", "tur") for v in (BASIC, PROPORTIONAL)],
        F.max("gva").alias("gva"))
    out = []
    for name, m, digits in (("gva", "gva", 0), ("turnover", "tur", 0)):
        a, b = c(f"{m}_{BASIC}"), c(f"{m}_{PROPORTIONAL}")
        out += [F.round(F.least(a, b), digits).alias(f"{name}_lo"), F.round(F.greatest(a, b), digits).alias(f"{name}_hi")]
    sa, sb = 100 * c(f"gva_{BASIC}") / c("gva"), 100 * c(f"gva_{PROPORTIONAL}") / c("gva")
    out += [F.round(F.least(sa, sb), 1).alias("share_lo"), F.round(F.greatest(sa, sb), 1).alias("share_hi")]
    return g.select(*by, "classes", *out)


def survey_level(accounts: DataFrame, survey_total: DataFrame, rate: Column) -> DataFrame:
    """Territory value added converted to the level of the business survey: times (survey total of the
    state in local currency / national accounts of the state).
    accounts(section, territory, gva), survey_total(section, av)."""
    state = accounts.filter(F.col("territory") == "CZ").select("section", F.col("gva").alias("gva_state"))
    j = accounts.join(state, "section").join(survey_total, "section")
    factor = F.col("av") * rate / F.col("gva_state")
    return j.select("section", "territory", F.col("gva").alias("gva_accounts"), F.round(factor, 4).alias("factor"),
                    (F.col("gva") * factor).alias("gva"))


def consistency(allocated_state: DataFrame, survey: DataFrame, rate: Column) -> DataFrame:
    """The model on the whole state against survey facts, per section: turnover inside the band and both
    bounds within the tolerance. allocated_state(section, cls, gva_*, tur_*), survey(section, cls, av, tur)."""
    m = allocated_state.groupBy("section").agg(F.sum(f"tur_{BASIC}").alias("a"), F.sum(f"tur_{PROPORTIONAL}").alias("b"))
    fact = survey.groupBy("section").agg((F.sum("tur") * rate).alias("fact"))
    c = F.col
    lo, hi = F.round(F.least("a", "b"), 0), F.round(F.greatest("a", "b"), 0)
    off = F.greatest(F.abs(100 * (lo / c("fact") - 1)), F.abs(100 * (hi / c("fact") - 1)))
    return m.join(fact, "section").select(
        "section", lo.alias("model_lo"), hi.alias("model_hi"), F.round("fact", 0).alias("fact"), F.round(off, 2).alias("deviation"),
        ((lo <= c("fact")) & (c("fact") <= hi) & (off <= X.MODEL_TOLERANCE_PCT)).alias("met"))


def class_consistency(allocated_state: DataFrame, survey: DataFrame) -> DataFrame:
    """Model share of each class on value added beside the survey fact; distance of the fact from the band."""
    w = Window.partitionBy("section")
    c = F.col
    a, b = 100 * c(f"gva_{BASIC}") / c("gva"), 100 * c(f"gva_{PROPORTIONAL}") / c("gva")
    facts = survey.select("section", "cls", F.round(100 * c("av") / F.sum("av").over(w), 1).alias("fact"))
    lo, hi = F.round(F.least(a, b), 1), F.round(F.greatest(a, b), 1)
    j = allocated_state.select("section", "cls", lo.alias("model_lo"), hi.alias("model_hi")).join(facts, ["section", "cls"])
    gap = F.when(c("fact").between(c("model_lo"), c("model_hi")), 0.0).otherwise(
        F.least(F.abs(c("model_lo") - c("fact")), F.abs(c("model_hi") - c("fact"))))
    return j.withColumn("gap", F.round(gap, 1))


def survey_facts(survey: DataFrame, rate: Column) -> DataFrame:
    """State facts by section and class: enterprises, turnover per enterprise, its range over divisions,
    margin. survey(section, division, cls, ent, emp, av, tur, gos); division NULL = the section row."""
    c = F.col
    whole = survey.filter(c("division").isNull())
    parts = survey.filter(c("division").isNotNull() & (c("ent") > 0)).withColumn("per", c("tur") / c("ent") * rate).groupBy(
        "section", "cls").agg(F.round(F.min("per"), 2).alias("per_enterprise_lo"), F.round(F.max("per"), 2).alias("per_enterprise_hi"))
    return whole.join(parts, ["section", "cls"], "left").select(
        "section", "cls", F.round("ent", 0).alias("enterprises"), F.round("emp", 0).alias("persons"),
        F.when(c("ent") > 0, F.round(c("tur") / c("ent") * rate, 2)).alias("per_enterprise"), "per_enterprise_lo", "per_enterprise_hi",
        F.when(c("tur") > 0, F.round(100 * c("gos") / c("tur"), 1)).alias("margin"))
