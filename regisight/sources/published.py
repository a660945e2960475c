"""Published aggregates in long CSV form: own column names per dimension, blank values dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regisight.operators.series import deepest_territory

# --- fixed values: yearly / quarterly wage selections -----------------------------
WAGE_SELECTIONS = {"MZDCRRT2": "rocni", "MZDCRRT1": "rocni", "MZDRT2": "ctvrtletni", "MZDRT5": "ctvrtletni"}
# --- fixed values: kept wage indicators and their codes ---------------------------
WAGE_INDICATORS = {
    "Průměrný evidenční počet zaměstnanců přepočtený (tis. osob)": "ZAM_PREP",
    "Průměrný evidenční počet zaměstnanců na fyzické osoby (tis. osob)": "ZAM_FYZ",
    "Průměrná hrubá měsíční mzda na přepočtené počty zaměstnanců (Kč)": "MZDA_PREP",
    "Průměrná hrubá měsíční mzda na fyzické osoby (Kč)": "MZDA_FYZ",
}


def read_long(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; dots in names stay."""
    df = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def _c(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def _valued(df: DataFrame) -> DataFrame:
    return df.filter(F.col("Hodnota").isNotNull() & (F.col("Hodnota") != ""))


def _code(names: dict[str, str], column: Column) -> Column:
    """Indicator code of an indicator name, from the definition of the data set."""
    return F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[column]


def aggregates(df: DataFrame, definition: dict) -> DataFrame:
    """definition: {"selection", "indicators": {name: code}, "territory"|"industry"|"time": {"code", "name"}}."""
    d = definition
    part = lambda k: _c(df, f"{d[k]['code']}.Polozka")
    return _valued(df).select(
        F.lit(d["selection"]).alias("selection"), _code(d["indicators"], F.col("Ukazatel")).alias("indicator"),
        F.col("Ukazatel").alias("indicator_name"), part("territory").alias("territory"),
        _c(df, d["territory"]["name"]).alias("territory_name"), part("industry").alias("nace"),
        _c(df, d["industry"]["name"]).alias("nace_name"), part("time").alias("period"), F.col("Hodnota").cast("double").alias("value"))


def _hierarchy(df: DataFrame, dim: str) -> Column:
    """Deepest filled level of a hierarchical territory: district, region, cohesion region, state."""
    suffix = {"OKRES": "-Okres", "KRAJ": "-Kraj", "REGION": "-Region", "STAT": "-Stát"}
    levels = []
    for level, end in suffix.items():
        named = [c for c in df.columns if c.endswith(end)]
        levels.append((level, _c(df, f"{dim}.{level}.Polozka"), F.coalesce(*[F.nullif(_c(df, n), F.lit("")) for n in named]) if named
                       else F.lit(None).cast("string")))
    return deepest_territory(levels)


def population(df: DataFrame, indicators: dict[str, str]) -> DataFrame:
    """Inhabitants of both sexes per territory and year."""
    rows = _valued(df).filter(_c(df, "POHL2.Polozka") == "0").withColumn("_t", _hierarchy(df, "Uz0123h2"))
    return rows.select("_t.*", _c(df, "CasR.Polozka").cast("int").alias("year"),
                       _code(indicators, F.col("Ukazatel")).alias("indicator"), F.col("Hodnota").cast("double").alias("value"))


def births_closures(df: DataFrame, indicators: dict[str, str]) -> DataFrame:
    """Quarterly births and closures per territory and legal-form group."""
    quarter = _c(df, "CasQ.Polozka")
    rows = _valued(df).filter(quarter.isNotNull() & (quarter != "")).withColumn("_t", _hierarchy(df, "UZ023H2U"))
    return rows.select("_t.*", _c(df, "FORMA0.Polozka").alias("form"), quarter.alias("period"),
                       _code(indicators, F.col("Ukazatel")).alias("indicator"), F.col("Hodnota").cast("double").alias("value"))


def demography(df: DataFrame, indicators: dict[str, str]) -> DataFrame:
    status = _c(df, "OBS_STATUS")
    return _valued(df).select(
        _c(df, "CZNACERES.Polozka").alias("industry"), _c(df, "FORMA.Polozka").alias("form"), _c(df, "CasR.Polozka").cast("int").alias("year"),
        _code(indicators, F.col("Ukazatel")).alias("indicator"), F.col("Hodnota").cast("double").alias("value"),
        (status.isNotNull() & (status != "")).alias("preliminary"))


def wages(df: DataFrame, selection: str) -> DataFrame:
    """Kept wage indicators of the state and the regions; cohesion regions dropped; no industry = '0'."""
    filled = lambda n: F.nullif(_c(df, n), F.lit(""))
    region, state = filled("Uz2.Polozka"), filled("Uz0.Polozka")
    h_region, h_kraj, h_state = (filled(f"Uz0123vm.{x}.Polozka") for x in ("REGION", "KRAJ", "STAT"))
    place = F.coalesce(region, state, h_kraj, h_state)
    level = F.when(region.isNotNull() | (state.isNull() & h_kraj.isNotNull()), "KRAJ").otherwise("STAT")
    cohesion = region.isNull() & state.isNull() & h_region.isNotNull() & h_kraj.isNull()
    status = _c(df, "OBS_STATUS")
    return _valued(df).filter(F.col("Ukazatel").isin(*WAGE_INDICATORS) & ~cohesion).select(
        F.lit(selection).alias("selection"), F.lit(WAGE_SELECTIONS[selection]).alias("survey"), place.alias("territory"),
        level.alias("level"), F.coalesce(filled("CZNACEMZDY.Polozka"), F.lit("0")).alias("nace"), _c(df, "CasR.Polozka").cast("int").alias("year"),
        _code(WAGE_INDICATORS, F.col("Ukazatel")).alias("indicator"), F.col("Hodnota").cast("double").alias("value"),
        (status.isNotNull() & (status != "")).alias("preliminary"))
