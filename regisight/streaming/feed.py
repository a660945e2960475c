"""Registry records as a file stream: each arriving batch of files goes through the same import as a
batch run, so re-delivered records change nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regisight.plans.core import import_records

RECORD = "base_json string, history_json string"


def import_arrivals(spark: SparkSession, incoming: str, root: str, checkpoint: str | None = None, name: str = "feed"):
    """Processes everything that has arrived and stops. incoming holds JSON lines with the raw base and
    history responses as text; files are taken exactly once per checkpoint, which lies in the root unless named.
    A micro-batch that comes again, after a failure between its import and the checkpoint, has the same batch id
    and stores nothing twice."""

    def one(batch: DataFrame, epoch: int) -> None:
        if not batch.isEmpty():
            import_records(spark, root, batch, f"{name}-{epoch}")

    stream = spark.readStream.schema(RECORD).json(incoming)
    query = stream.writeStream.foreachBatch(one).option(
        "checkpointLocation", checkpoint or f"{root}/_{name}").trigger(availableNow=True).start()
    query.awaitTermination()
    return query
