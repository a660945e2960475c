"""Code lists: plain, legal forms, regions, districts with their link to regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regisight.sources.tables import LoadRefused


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """CSV with BOM, lower-case names, empty as NULL; an empty list is refused."""
    df = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    df = df.toDF(*[c.lstrip("﻿").strip().lower() for c in df.columns])
    if df.isEmpty():
        raise LoadRefused(f"empty code list: {path}")
    return df


def _validity(df: DataFrame) -> list:
    return [F.to_date("admplod").alias("valid_from"), F.to_date("admnepo").alias("valid_to")]


def plain_list(items: DataFrame) -> DataFrame:
    return items.select(F.col("chodnota").alias("code"), F.col("text").alias("name"), *_validity(items))


def legal_forms(items: DataFrame, list_id: int) -> DataFrame:
    return items.select(F.lit(list_id).alias("list_id"), F.col("chodnota").alias("code"), F.col("text").alias("name"),
                        F.col("zkrtext").alias("short_name"), *_validity(items))


def regions(items: DataFrame) -> DataFrame:
    return items.select(
        F.col("cznuts").alias("code"), F.col("text").alias("name"), F.col("zkrkraj").alias("short_name"),
        F.col("chodnota").cast("int").alias("office_code"), F.col("kod_ruian").cast("int").alias("ruian"), *_validity(items))


def districts(items: DataFrame, links: DataFrame) -> DataFrame:
    """Districts with their region from the official link table 109 -> 108; every district needs one."""
    odd = links.filter((F.col("kodcis1") != "109") | (F.col("kodcis2") != "108"))
    if not odd.isEmpty():
        raise LoadRefused("unexpected link between code lists")
    linked = items.join(links.select(F.col("chodnota1").alias("chodnota"), F.col("chodnota2").alias("region")), "chodnota", "left")
    missing = [r.chodnota for r in linked.filter(F.col("region").isNull()).select("chodnota").take(10)]
    if missing:
        raise LoadRefused(f"districts without a region: {missing}")
    return linked.select(F.col("chodnota").alias("code"), F.col("text").alias("name"), "region", *_validity(items))


def classification(items: DataFrame) -> DataFrame:
    """(code, level, parent) of a classification export."""
    return items.select(F.col("chodnota").alias("code"), F.col("uroven").cast("int").alias("level"),
                        F.nullif("nadvaz", F.lit("")).alias("parent"))
