"""Published series: wages, regional accounts, business demography, and their derived ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regisight.functions import fixed as X
from regisight.functions.numbers import pct, ratio

STATE = "CZ"


def last_years(df: DataFrame, by: list[str], years: int = X.SHOWN_YEARS, year: str = "year") -> DataFrame:
    """The last N distinct years available per key. Distinct years are few, so the cut-off is an
    aggregation: the N-th largest of the set of years."""
    cut = df.select(*by, year).distinct().groupBy(*by).agg(
        F.sort_array(F.collect_set(year), False).alias("_y")  # one entry per calendar year
    ).select(*by, F.coalesce(F.get("_y", F.lit(years - 1)), F.element_at("_y", -1)).alias("_from"))
    return df.join(cut, by).filter(F.col(year) >= F.col("_from")).drop("_from")


def latest_common_year(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    """Latest year present in both sources per key."""
    return a.select(*by, "year").distinct().join(b.select(*by, "year").distinct(), [*by, "year"]).groupBy(*by).agg(
        F.max("year").alias("year"))


def wage_table(wages: DataFrame, years: int = X.SHOWN_YEARS) -> DataFrame:
    """wages(territory, nace, year, employees, wage, preliminary), nace '0' = all industries.

    Per territory, industry and shown year: employees and wage beside the state and beside all
    industries of the territory. Only published numbers and their ratios."""
    shown = last_years(wages.filter(F.col("nace") != "0"), ["nace"], years)
    state = wages.filter(F.col("territory") == STATE).select(
        "nace", "year", F.col("employees").alias("e_state"), F.col("wage").alias("w_state"))
    everything = wages.filter(F.col("nace") == "0").select(
        "territory", "year", F.col("employees").alias("e_all"), F.col("wage").alias("w_all"))
    j = shown.join(state, ["nace", "year"], "left").join(everything, ["territory", "year"], "left")
    c = F.col
    inside = c("territory") != STATE
    return j.select(
        "territory", "nace", "year", F.round("employees", 1).alias("employees"),
        F.when(inside, pct(c("employees"), c("e_state"), 2)).alias("employees_share_state"),
        pct(c("employees"), c("e_all"), 2).alias("employees_share_territory"), F.round("wage", 0).alias("wage"),
        F.when(inside, pct(c("wage"), c("w_state"), 1)).alias("wage_index_state"),
        pct(c("wage"), c("w_all"), 1).alias("wage_index_territory"), "preliminary",
    )


def newer_levels(wages: DataFrame, newer: DataFrame) -> DataFrame:
    """Years of the quarterly survey after the last yearly one, on the levels it publishes. Nothing is
    interpolated and the two series are not joined."""
    last = wages.agg(F.max("year").alias("y")).select("y").scalar()
    return newer.filter(F.col("year") > last).select(
        "territory", "nace", "year", F.round("employees", 1).alias("employees"), F.round("wage", 0).alias("wage"), "preliminary")


def accounts_table(accounts: DataFrame, years: int = X.SHOWN_YEARS) -> DataFrame:
    """accounts(indicator, geo, nace, year, value), nace TOTAL = all; indicators HPH_CP, HPH_PYP, ZAM_EMP, ZAM_SELF.

    Value added, its shares, real growth, chained volume index (first shown year = 100, a missing link
    leaves it unchanged), employment, self-employed share, productivity and its index."""
    wide = accounts.groupBy("geo", "nace", "year").pivot("indicator", ["HPH_CP", "HPH_PYP", "ZAM_EMP", "ZAM_SELF"]).agg(
        F.max("value"))
    by_year = Window.partitionBy("geo", "nace").orderBy("year")  # one row per year
    c = F.col
    before = F.when(F.lag("year").over(by_year) == c("year") - 1, F.lag("HPH_CP").over(by_year))
    linked = wide.withColumn("link", F.when((c("HPH_PYP") != 0) & (before != 0), c("HPH_PYP") / before))
    shown = last_years(linked.filter((c("nace") != "TOTAL") & c("HPH_CP").isNotNull()), ["nace"], years)
    first = F.row_number().over(by_year) == 1
    step = F.when(first, 0.0).otherwise(F.coalesce(F.ln("link"), F.lit(0.0)))
    indexed = shown.withColumn("_step", step).withColumn(
        "volume_index", F.round(100 * F.exp(F.sum("_step").over(by_year.rowsBetween(Window.unboundedPreceding, 0))), 1))
    total = wide.filter(c("nace") == "TOTAL").select("geo", "year", c("HPH_CP").alias("gva_all"))
    state = wide.filter(c("geo") == STATE).select("nace", "year", c("HPH_CP").alias("gva_state"), c("ZAM_EMP").alias("emp_state"))
    j = indexed.join(total, ["geo", "year"], "left").join(state, ["nace", "year"], "left")
    inside = c("geo") != STATE
    productivity = F.when((c("HPH_CP") != 0) & (c("ZAM_EMP") != 0), c("HPH_CP") / c("ZAM_EMP"))
    productivity_state = F.when((c("gva_state") != 0) & (c("emp_state") != 0), c("gva_state") / c("emp_state"))
    return j.select(
        "geo", "nace", "year", F.round("HPH_CP", 0).alias("gva"), pct(c("HPH_CP"), c("gva_all"), 2).alias("gva_share_territory"),
        F.when(inside, pct(c("HPH_CP"), c("gva_state"), 2)).alias("gva_share_state"),
        F.round(100 * (c("link") - 1), 1).alias("growth"), "volume_index", F.round("ZAM_EMP", 2).alias("employed"),
        pct(c("ZAM_SELF"), c("ZAM_EMP"), 1).alias("self_employed_share"), F.round(productivity, 0).alias("productivity"),
        F.when(inside, F.round(100 * productivity / productivity_state, 1)).alias("productivity_index_state"),
    )


def compensation_table(accounts: DataFrame, prefix: int) -> DataFrame:
    """Compensation of employees over value added on the cohesion-region level; a smaller territory
    reads the region its code starts with."""
    wide = accounts.groupBy("geo", "nace", "year").pivot("indicator", ["NAHRADY", "HPH_CP"]).agg(F.max("value"))
    regional = wide.filter((F.length("geo") == prefix) | (F.col("geo") == STATE))
    total = regional.filter(F.col("nace") == "TOTAL").select(
        "geo", "year", pct(F.col("NAHRADY"), F.col("HPH_CP"), 1).alias("share_all"))
    own = regional.filter(F.col("nace") != "TOTAL")
    return own.join(total, ["geo", "year"], "left").select(
        "geo", "nace", "year", F.round("NAHRADY", 0).alias("compensation"), F.round("HPH_CP", 0).alias("gva"),
        pct(F.col("NAHRADY"), F.col("HPH_CP"), 1).alias("share"), "share_all")


def section_groups(industries: DataFrame, mapping: DataFrame) -> DataFrame:
    """industries(industry, section), mapping(section, a10, section_rev2) -> group per industry, or the
    reason why there is none: sections spanning several groups."""
    j = industries.join(mapping, "section", "left")
    return j.groupBy("industry").agg(
        F.count_distinct("a10").alias("groups"), F.min("a10").alias("_a"), F.max("a10").alias("_b")
    ).select(
        "industry", F.when(F.col("groups") == 1, F.col("_a")).alias("a10"),
        F.when(F.col("groups") > 1, "spans several groups").when(F.col("groups") == 0, "no group").alias("reason"))


def demography_table(births: DataFrame, years: int = X.SHOWN_YEARS) -> DataFrame:
    """births(industry, year, indicator, value) -> births, deaths and active units side by side for the last
    complete years, with rates in percent of the active units."""
    wide = births.groupBy("industry", "year").pivot("indicator", ["active", "born", "died"]).agg(F.max("value"))
    complete = wide.filter(F.col("active").isNotNull() & F.col("born").isNotNull() & F.col("died").isNotNull())
    c = F.col
    return last_years(complete, ["industry"], years).select(
        "industry", "year", c("active").cast("bigint").alias("active"), c("born").cast("bigint").alias("born"),
        c("died").cast("bigint").alias("died"), ratio(c("born"), c("active"), 2, 100).alias("birth_rate"),
        ratio(c("died"), c("active"), 2, 100).alias("death_rate"))


def deepest_territory(levels: list[tuple[str, Column, Column]]) -> Column:
    """struct(territory, level, name) of the first filled level, given from the deepest to the state."""
    return F.coalesce(*[
        F.when(code.isNotNull() & (code != ""), F.struct(
            code.alias("territory"), F.lit(level).alias("level"), F.coalesce(F.nullif(name, F.lit("")), code).alias("name")))
        for level, code, name in levels
    ])
