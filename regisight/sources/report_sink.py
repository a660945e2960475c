"""Report outputs: published tables, findings, and internal variables kept on a path of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


ROWS_PER_FILE = 500_000


def write_report(report_cells: DataFrame, findings: DataFrame, cells: DataFrame, relations: DataFrame, public: str, internal: str,
                 rows_per_file: int = ROWS_PER_FILE) -> None:
    """JSON for readers under the public path, by industry and in order of reports; variables and relations as Parquet
    under the internal path. The two paths must not contain one another.

    Rows are dealt by ranges of (industry, report), so an industry lies in few neighbouring tasks: the number of files
    follows the rows and the industries, not tasks x reports."""
    a, b = public.rstrip("/") + "/", internal.rstrip("/") + "/"
    if a.startswith(b) or b.startswith(a):
        raise ValueError("internal variables must not lie inside the public output")
    for df, name in ((report_cells, "tables"), (findings, "findings")):
        by_report = df.withColumn("industry", F.coalesce(F.split_part(F.col("report_id").cast("string"), F.lit("@"), F.lit(1)), F.lit("?")))
        dealt = by_report.repartitionByRange("industry", "report_id").sortWithinPartitions("industry", "report_id")
        dealt.write.option("maxRecordsPerFile", rows_per_file).partitionBy("industry").json(f"{public}/{name}")
    for df, name in ((cells, "cells"), (relations, "relations")):
        df.repartitionByRange("report_id").sortWithinPartitions("report_id").write.option("maxRecordsPerFile", rows_per_file).parquet(f"{internal}/{name}")
