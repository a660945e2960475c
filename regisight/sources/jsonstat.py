"""JSON-stat: a flat value index over the row-major product of dimension categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HEAD = ("id array<string>, dimension map<string, struct<category: struct<index: map<string,int>>>>, "
        "status map<string,string>, updated string")

# --- fixed values: data set -> (dimension that names the indicator, its values) ----
ACCOUNT_SETS = {
    "nama_10r_3gva": ("unit", {"CP_MNAC": "HPH_CP", "PYP_MNAC": "HPH_PYP"}),
    "nama_10r_3empers": ("wstatus", {"EMP": "ZAM_EMP", "SAL": "ZAM_SAL", "SELF": "ZAM_SELF"}),
    "nama_10r_2coe": ("currency", {"MIO_NAC": "NAHRADY"}),
}


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("wholetext", True).text(path)


def decode(documents: DataFrame, column: str = "value") -> DataFrame:
    """One row per value: coordinates (dimension -> category), value, status, updated.

    Values come as a sparse object or a dense list. The category of dimension k is
    floor(index / product of the later sizes) mod its size."""
    text = F.col(column)
    values_text = F.get_json_object(text, "$.value")
    sparse = F.from_json(values_text, "map<string,double>")
    dense = F.from_json(values_text, "array<double>")
    listed = F.transform(dense, lambda v, i: F.struct(i.cast("bigint").alias("i"), v.alias("v")))
    mapped = F.transform(F.map_entries(sparse), lambda e: F.struct(e["key"].cast("bigint").alias("i"), e["value"].alias("v")))
    # status may be an object or absent
    head = documents.select(F.from_json(text, HEAD).alias("h"), F.when(values_text.startswith("["), listed).otherwise(mapped).alias("vs"))

    def ordered(dim: Column) -> Column:
        entries = F.map_entries(F.col("h.dimension")[dim]["category"]["index"])
        return F.transform(F.array_sort(F.transform(entries, lambda e: F.struct(e["value"].alias("p"), e["key"].alias("k")))), lambda s: s["k"])

    dims = head.select("vs", F.col("h.status").alias("status"), F.col("h.updated").alias("updated"), F.col("h.id").alias("ids"),
                       F.transform("h.id", ordered).alias("cats"))
    sizes = F.transform("cats", lambda c: F.size(c).cast("bigint"))
    strides = F.transform("cats", lambda c, k: F.aggregate(
        F.slice(F.col("sizes"), k + 2, F.size("sizes")), F.lit(1).cast("bigint"), lambda a, s: a * s))
    flat = dims.withColumn("sizes", sizes).withColumn("strides", strides).select(
        "ids", "cats", "sizes", "strides", "status", "updated", F.inline("vs")).filter(F.col("v").isNotNull())
    picked = F.transform("ids", lambda d, k: F.get(
        F.get("cats", k), (F.floor(F.col("i") / F.get("strides", k)) % F.get("sizes", k)).cast("int")))
    return flat.select(F.map_from_arrays("ids", picked).alias("at"), F.col("v").alias("value"),
                       F.coalesce(F.col("status")[F.col("i").cast("string")], F.lit("")).alias("status"), "updated")


def accounts(decoded: DataFrame, data_set: str) -> DataFrame:
    """Regional accounts rows: geo with its level, industry, year, indicator."""
    dim, names = ACCOUNT_SETS[data_set]
    code = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("at")[dim]]
    geo = F.col("at")["geo"]
    level = F.when(geo == "CZ", "STAT").when(F.length(geo) == 4, "REGION").otherwise("KRAJ")
    return decoded.select(F.lit(data_set).alias("data_set"), geo.alias("geo"), level.alias("level"), F.col("at")["nace_r2"].alias("nace"),
                          F.col("at")["time"].cast("int").alias("year"), code.alias("indicator"), "value", "status", "updated")


def business_survey(decoded: DataFrame) -> DataFrame:
    at = F.col("at")
    return decoded.select(F.lit("sbs_sc_ovw").alias("data_set"), at["nace_r2"].alias("nace"), at["size_emp"].alias("size"),
                          at["time"].cast("int").alias("year"), at["indic_sbs"].alias("indicator"), "value", "status", "updated")


def exchange_rate(decoded: DataFrame) -> DataFrame:
    return decoded.select(F.lit("ert_bil_eur_a").alias("data_set"), F.lit("-").alias("nace"), F.lit("-").alias("size"),
                          F.col("at")["time"].cast("int").alias("year"), F.lit("KURZ_CZK_EUR").alias("indicator"), "value", "status", "updated")
