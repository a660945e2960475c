"""From a snapshot to the industry interface: code history, matrix, rules, derived codes, interface."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regisight.functions import fixed as X
from regisight.operators import crosswalk as C
from regisight.operators import history as H
from regisight.operators import interface as N
from regisight.session import materialise
from regisight.sources import tables as B

# --- fixed values: version -> (main-code column, classification id of its activities) -----
VERSIONS = {2008: ("nace", "80004"), 2025: ("nace2025", "80143")}


def next_history(history: DataFrame, snapshot: DataFrame, activities: DataFrame, batch_id: int) -> DataFrame:
    """Official part of the next history: both versions, main and secondary codes. After the end of dual
    coding the 2008 codes are closed instead."""
    spark = history.sparkSession
    official = history.filter(F.col("source") == X.OFFICIAL)
    scope = H.snapshot_scope(snapshot)
    detail = F.lit("snapshot")
    ended = snapshot.select(H.dual_coding_ended(snapshot).alias("e")).first()
    parts = []
    for version, (column, list_id) in VERSIONS.items():
        if version == 2008 and ended is not None and ended.e:
            parts.append(H.end_dual_coding(official.filter(F.col("version") == version)).withColumn("action", F.lit(H.KEEP)))
            continue
        codes = activities.filter(F.col("kodcis") == list_id).select("ico", F.col("hodn").alias("code"))
        for kind, staged in ((X.MAIN, H.staged_main(snapshot, version, column)),
                             (X.SECONDARY, H.staged_secondary(snapshot, codes, version, column))):
            parts.append(H.apply_codes(official, staged, scope, version, kind, detail, F.lit(batch_id)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def classify(spark: SparkSession, root: str, history: DataFrame, snapshot: DataFrame, activities: DataFrame, old_codes: DataFrame,
             new_codes: DataFrame, links: DataFrame, batch_id: int) -> DataFrame:
    """Publishes code history, matrix, rules and the interface; returns the interface.
    snapshot(ico, snapshot, updated, closed, nace, nace2025); activities(ico, kodcis, hodn)."""
    with B.batch(spark, root, "codes") as b:
        official = materialise(next_history(history, snapshot, activities, batch_id).select(*H.CODE_COLUMNS), "official")
        problems = H.audit_codes(history.withColumn("_row", _row_key()), official.withColumn("_row", _row_key()), ["_row"])
        if not problems.isEmpty():
            raise B.LoadRefused(f"code history changed in a forbidden way: {problems.take(3)}")
        matrix = B.publish(C.transition_matrix(official, old_codes, new_codes), root, "matrix", b.batch_id)
        rules = B.publish(C.derivation_rules(old_codes, new_codes, links, matrix), root, "rules", b.batch_id, ["code_2008", "level"])
        everything = official.unionByName(C.derived_codes(official, rules).select(*H.CODE_COLUMNS))
        stored = B.publish(everything, root, "code_history", b.batch_id, None, ["version", "kind"])
        interface = N.company_interface(stored, old_codes, new_codes).repartition("division").sortWithinPartitions("division", "ico")
        out = B.publish(interface, root, "interface", b.batch_id, ["ico"])
        b.rows = out.count()
    return out


def _row_key():
    """Identity of an official code row: subject, version, kind, code and its start; a start shifted to
    2025-01-01 keeps its identity."""
    start = F.when(F.col("version") == 2025, F.greatest(F.col("start"), F.lit(X.START_2025))).otherwise(F.col("start"))
    return F.concat_ws("|", "ico", "version", "kind", "code", F.coalesce(start.cast("string"), F.lit("?")))
