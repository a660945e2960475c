"""Snapshot ingest: contract -> load -> reconcile -> quality metrics -> gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regisight.operators import quality as Q
from regisight.sources import snapshot_csv as S
from regisight.sources import tables as B


def quality_view(subjects: DataFrame) -> DataFrame:
    """Columns of the stored subject snapshot under the names the quality metrics use."""
    return subjects.select(
        "snapshot", "ico", F.col("firma").alias("name"), F.col("ddatvzn").alias("founded"), F.col("ddatzan").alias("closed"), "forma",
        F.col("okreslau").alias("district"), "nace", "nace2025", "katpo", F.col("kodadm").alias("address_code"))


def ingest_snapshot(spark: SparkSession, root: str, files: dict[str, tuple[str, str]], lists: dict[str, DataFrame],
                    limit: float = Q.X.MISSING_LIMIT) -> DataFrame:
    """files: {"subjects": (csv, metadata), "activities": (csv, metadata)}; lists: nace(code, pseudo),
    districts, sizes, forms (code). Both files must be of one day. Returns the stored quality metrics;
    raises when the gate is exceeded (the metrics stay stored for inspection)."""
    with B.batch(spark, root, "snapshot", str(sorted(files))) as b:
        day, n, new = S.load_snapshot(spark, S.SUBJECTS, *files["subjects"], root, b.batch_id)
        day2, m, new2 = S.load_snapshot(spark, S.ACTIVITIES, *files["activities"], root, b.batch_id)
        if day != day2:
            raise B.LoadRefused(f"subjects are of {day}, activities of {day2}")
        b.rows = (n if new else 0) + (m if new2 else 0)
        snap = S.snapshots(spark, S.SUBJECTS, root).filter(F.col("snapshot") == F.lit(day).cast("date"))  # prunes to one partition
        metrics = Q.quality_metrics(quality_view(snap), lists["nace"], lists["districts"], lists["sizes"], lists["forms"])
        B.replace_by_key(metrics, root, "quality", ["snapshot"], b.batch_id)
    stored = B.read_keyed(spark, root, "quality").filter(F.col("snapshot") == F.lit(day).cast("date"))
    Q.quality_gate(stored, limit)
    return stored
