"""Territories: membership, resolution of requests, counts for all territories at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE, REGION, DISTRICT = "CR", "KRAJ", "OKRES"
STATE_CODE = "CZ"


def memberships(district: Column, region: Column) -> Column:
    """The three territories a district belongs to, as an array of (level, territory, parent)."""

    def member(level: str, code: Column, parent: Column) -> Column:
        return F.struct(F.lit(level).alias("level"), code.alias("territory"), parent.alias("parent"))

    return F.array(
        member(STATE, F.lit(STATE_CODE), F.lit(None).cast("string")),
        member(REGION, region, F.lit(STATE_CODE)),
        member(DISTRICT, district, region),
    )


def roll_up(district_counts: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    """District-level sums -> one row per (by, level, territory). The input is already
    aggregated per district, so the tripled rows are few."""
    spread = district_counts.select(
        *by, *measures, F.inline(memberships(F.col("district"), F.col("region")))
    ).filter(F.col("territory").isNotNull())
    return spread.groupBy(*by, "level", "territory", "parent").agg(*[F.sum(m).alias(m) for m in measures])


def count_by_territory(subjects: DataFrame, by: list[str], measure: str = "n") -> DataFrame:
    """Subjects per (by, territory) on all three levels; one pass over the subjects."""
    counts = subjects.groupBy(*by, "district", "region").agg(F.count(F.lit(1)).alias(measure))
    return roll_up(counts, by, [measure])


def places(territories: DataFrame) -> DataFrame:
    """Every territory once: (level, territory, parent)."""
    return territories.select(F.inline(memberships(F.col("district"), F.col("region")))).distinct()


def fill_zero(counts: DataFrame, place_list: DataFrame, by: list[str], measure: str = "n") -> DataFrame:
    """Adds the missing (by, territory) cells with 0. The cells of a key become one small map (a code list
    of territories long) that is read for every listed territory; no join and no second pass."""
    listed = place_list.agg(F.collect_list(F.struct("level", "territory", "parent")).alias("p")).select("p").scalar()
    per_key = counts.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct(
        F.concat_ws(":", "level", "territory").alias("k"), F.col(measure).alias("v")))).alias("_cells"))
    found = F.col("_cells")[F.concat_ws(":", "level", "territory")]
    return per_key.select(*by, "_cells", F.inline(listed)).select(
        *by, "level", "territory", "parent", F.coalesce(found, F.lit(0)).cast("bigint").alias(measure))


def resolve_requests(requests: DataFrame, territories: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requested territory texts -> (resolved, rejected).

    requests(request_id, text); territories(district, district_name, region, region_name).
    A state alias, a region code or name, a district code or a unique district name; a region
    wins over a district of the same name. The code lists are small and broadcast-safe: one row
    per region and district."""
    region_names = territories.select("region", "region_name").distinct()

    def entry(key: Column, rank: int, level: str, code: Column) -> DataFrame:
        source = region_names if level == REGION else territories
        return source.select(key.alias("key"), F.lit(rank).alias("rank"), F.lit(level).alias("level"),
                             code.alias("territory"))

    names = (
        entry(F.upper("region"), 1, REGION, F.col("region"))
        .unionByName(entry(F.upper("region_name"), 1, REGION, F.col("region")))
        .unionByName(entry(F.upper("district"), 2, DISTRICT, F.col("district")))
        .unionByName(entry(F.upper("district_name"), 2, DISTRICT, F.col("district")))
        .distinct()
    )
    # one row per key: the best rank, and how many codes share it
    ranked = names.groupBy("key", "rank").agg(
        F.count(F.lit(1)).alias("hits"), F.min("level").alias("level"), F.min("territory").alias("territory")
    )
    best = ranked.groupBy("key").agg(F.min_by(F.struct("hits", "level", "territory"), "rank").alias("b")).select(
        "key", "b.*"
    )
    asked = requests.withColumn("key", F.upper(F.btrim("text")))
    is_state = F.col("key").isin("CZ", "ČR", "CR", "ČESKO")
    found = asked.join(best, "key", "left").select(
        *requests.columns,
        F.when(is_state, STATE).when(F.col("hits") == 1, F.col("level")).alias("level"),
        F.when(is_state, STATE_CODE).when(F.col("hits") == 1, F.col("territory")).alias("territory"),
        F.when(~is_state & F.col("hits").isNull(), "unknown").when(~is_state & (F.col("hits") > 1), "ambiguous")
        .alias("reason"),
    )
    return found.filter(F.col("reason").isNull()).drop("reason"), found.filter(F.col("reason").isNotNull()).select(
        *requests.columns, "reason"
    )
