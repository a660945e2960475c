"""Indicators of every industry in every territory."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regisight.functions import fixed as X
from regisight.functions.numbers import pct
from regisight.operators import territory as T
from regisight.plans.sizing import small_side


def with_state_value(cells: DataFrame, by: list[str], column: str, name: str) -> DataFrame:
    """Attaches the state row's value to every territory of the same key. A key has one row per
    territory, so its window holds at most as many rows as the territory code list."""
    w = Window.partitionBy(*by)
    return cells.withColumn(name, F.max(F.when(F.col("level") == T.STATE, F.col(column))).over(w))


def basic_indicators(counts: DataFrame, all_counts: DataFrame, population: DataFrame, by: list[str]) -> DataFrame:
    """counts(by, level, territory, parent, n), all_counts(level, territory, n_all),
    population(level, territory, inhabitants) -> shares, location quotient, density, ranks.

    The two territory tables have one row per territory; they are broadcast when measured small."""
    cells = (
        counts.join(small_side(all_counts.select("level", "territory", "n_all")), ["level", "territory"], "left")
        .join(small_side(population.select("level", "territory", "inhabitants")), ["level", "territory"], "left")
    )
    cells = with_state_value(cells, by, "n", "n_state")
    cells = with_state_value(cells, by, "n_all", "n_all_state")
    own = F.col("n").cast("double") / F.nullif(F.col("n_all"), F.lit(0))
    state = F.col("n_state").cast("double") / F.nullif(F.col("n_all_state"), F.lit(0))
    peers = Window.partitionBy(*by, "level", "parent")
    density = F.lit(1000.0) * F.col("n") / F.nullif(F.col("inhabitants"), F.lit(0))
    ranked = cells.withColumn("density_exact", density)
    by_count = peers.orderBy(F.desc("n"))
    by_density = peers.orderBy(F.desc_nulls_last("density_exact"))
    return ranked.select(
        *by, "level", "territory", "parent", "n", "n_all", "inhabitants",
        pct(F.col("n"), F.col("n_state"), 2).alias("share_of_state"),
        pct(F.col("n"), F.col("n_all"), 2).alias("share_of_territory"),
        F.when(state != 0, F.round(own / state, 2)).alias("lq"),
        F.round("density_exact", 2).alias("density"),
        F.when(F.col("level") != T.STATE, F.rank().over(by_count)).alias("rank_count"),
        F.when((F.col("level") != T.STATE) & F.col("density_exact").isNotNull(), F.rank().over(by_density))
        .alias("rank_density"),
    )


def activity_share(published: DataFrame, by: list[str]) -> DataFrame:
    """published(by, active, registered) -> share of subjects with established activity."""
    return published.select(*by, pct(F.col("active"), F.col("registered"), 1).alias("activity_share"))


def reliability(counts: DataFrame, only_section: DataFrame, by: list[str]) -> DataFrame:
    """Subjects known only to the section against the industry count; above the limit = warning."""
    joined = counts.join(only_section, ["section", "level", "territory"], "left").withColumn(
        "n_only_section", F.coalesce("n_only_section", F.lit(0))
    )
    share = pct(F.col("n_only_section"), F.col("n"), 1)
    return joined.select(*by, "level", "territory", "n", "n_only_section", share.alias("share_only_section"),
                         F.coalesce(share > X.UNRELIABLE_SHARE, F.lit(False)).alias("unreliable"))


def scope_check(cells: DataFrame, minimum: int = X.MIN_SCOPE) -> DataFrame:
    """Requests below the minimum scope are refused and get the broader cells as options.

    cells(section, industry, level, territory, parent, n): one row per industry (division or the
    section itself) and territory. Broader = the same territory with the section, the parent
    territory with the industry, the parent territory with the section."""
    sections = cells.filter(F.col("industry") == F.col("section")).select(
        "section", "level", "territory", F.col("n").alias("n_section")
    )
    regions = cells.filter(F.col("level") == T.REGION).select(
        "industry", F.col("territory").alias("parent"), F.col("n").alias("n_parent")
    )
    region_sections = sections.filter(F.col("level") == T.REGION).select(
        "section", F.col("territory").alias("parent"), F.col("n_section").alias("n_parent_section")
    )
    j = (
        cells.join(sections, ["section", "level", "territory"], "left")
        .join(regions, ["industry", "parent"], "left")
        .join(region_sections, ["section", "parent"], "left")
    )
    lower = F.col("industry") != F.col("section")
    district = F.col("level") == T.DISTRICT

    def option(kept, industry, territory, n):
        return F.when(kept & n.isNotNull(), F.struct(
            industry.alias("industry"), territory.alias("territory"), n.alias("n")))

    options = F.filter(
        F.array(
            option(district, F.col("industry"), F.col("parent"), F.col("n_parent")),
            option(lower, F.col("section"), F.col("territory"), F.col("n_section")),
            option(lower & district, F.col("section"), F.col("parent"), F.col("n_parent_section")),
        ),
        lambda o: o.isNotNull(),
    )
    refused = F.col("n") < minimum
    return j.select("industry", "section", "level", "territory", "n", refused.alias("refused"),
                    F.when(refused, options).alias("options"))
