"""Stored tables without a table format: batches, manifests, versions, replacement by key.

Everything is plain Parquet in one shared folder. A table version is written whole under its own path
and becomes current only with its manifest row, so a failed or repeated run never shows half a table."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "table_name string, version string, rows bigint, fingerprint string, batch_id string, at timestamp, load string"
BATCHES = "batch_id string, source string, note string, state string, rows bigint, at timestamp"


class LoadRefused(ValueError):
    """The load contradicts what is already stored, or its own source."""


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _append(spark: SparkSession, path: str, rows: tuple | list[tuple], schema: str) -> None:
    """One file: its rows appear together or not at all."""
    spark.createDataFrame(rows if isinstance(rows, list) else [rows], schema).coalesce(1).write.mode("append").parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/_manifest"
    if not _exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(path)


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-independent content fingerprint: rows and two sums of row hashes under different seeds; one row."""
    return df.agg(*fingerprint_columns(df.columns))


def fingerprint_columns(columns: list[str]) -> list[Column]:
    """rows, hash, hash2: aggregates, so they can be observed while the rows are written."""
    return [F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(content_hash(columns, seed)), F.lit(0)).cast("string").alias(name) for name, seed in (("hash", 1), ("hash2", 2))]]


def content_hash(columns: list[str], seed: int = 1) -> Column:
    """Each column goes in with a mark of whether it is NULL, so a value that moves between two empty columns changes it."""
    marked = [x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(seed), *marked).cast("decimal(38,0)")


@contextmanager
def batch(spark: SparkSession, root: str, source: str, note: str = "", batch_id: str | None = None):
    """One load = one batch: a running row at its start, an OK or error row at its end. Yields an object
    with batch_id, a new one or the one given; set .rows before leaving."""

    class Batch:
        rows = 0

    b = Batch()
    b.batch_id = batch_id or uuid.uuid4().hex
    path = f"{root}/_batches"
    _append(spark, path, (b.batch_id, source, note, "running", None, _now()), BATCHES)
    try:
        yield b
    except Exception as e:
        _append(spark, path, (b.batch_id, source, f"{type(e).__name__}: {e}", "error", None, _now()), BATCHES)
        raise
    _append(spark, path, (b.batch_id, source, note, "OK", b.rows, _now()), BATCHES)


def batches(spark: SparkSession, root: str) -> DataFrame:
    """Latest state of every batch."""
    order = F.struct("at", (F.col("state") != "running").cast("int"))
    return spark.read.schema(BATCHES).parquet(f"{root}/_batches").groupBy("batch_id").agg(
        F.max_by(F.struct("source", "note", "state", "rows", "at"), order).alias("b")).select("batch_id", "b.*")


def publish(df: DataFrame, root: str, name: str, batch_id: str, unique: list[str] | None = None,
            partition: list[str] | None = None) -> DataFrame:
    """Writes the next whole version of a table and makes it current; duplicates of the unique key refuse it."""
    spark = df.sparkSession
    version = f"{_now():%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    path = f"{root}/{name}/v={version}"
    writer = df.write.partitionBy(*partition) if partition else df.write
    writer.parquet(path)
    stored = spark.read.parquet(path)
    if unique and not stored.groupBy(*unique).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        raise LoadRefused(f"{name}: duplicates of {unique}")
    _append(spark, f"{root}/_manifest", (name, version, stored.count(), None, batch_id, _now(), None), MANIFEST)
    return stored


def current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current version of a table."""
    last = manifest(spark, root).filter(F.col("table_name") == name).agg(F.max_by("version", "at").alias("v")).first()
    if last is None or last.v is None:
        raise LoadRefused(f"{name}: no published version")
    return spark.read.parquet(f"{root}/{name}/v={last.v}")


KEYED = "at timestamp, batch_id string, part string, path string, rows bigint"


def replace_by_key(df: DataFrame, root: str, name: str, keys: list[str], batch_id: str) -> int:
    """Replaces what the table holds for the key values (selection, data set, year) that occur in df and leaves the others; how many
    values were replaced. Each value's rows are written under a folder of this attempt, files sized by Spark also where one
    value has most rows; one log file then points all values to their new folders at once."""
    spark = df.sparkSession
    path = f"{root}/{name}/data/{batch_id}-{uuid.uuid4().hex[:8]}"
    part = F.md5(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}))
    df.withColumn("_part", part).hint("rebalance", F.col("_part")).write.partitionBy("_part").parquet(path)
    if df.isEmpty():
        return 0
    at = _now()
    new = [(at, batch_id, r["_part"], f"{path}/_part={r['_part']}", r["count"]) for r in spark.read.parquet(path).groupBy("_part").count().collect()]
    _append(spark, f"{root}/{name}/_log", new, KEYED)
    return len(new)


def read_keyed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows last stored for every key value."""
    path = f"{root}/{name}/_log"
    if not _exists(spark, path):
        raise LoadRefused(f"{name}: nothing is stored")
    now = spark.read.schema(KEYED).parquet(path).groupBy("part").agg(F.max_by("path", "at").alias("path")).collect()  # one row a key value
    return spark.read.parquet(*sorted(r.path for r in now))


def latest_snapshot(spark: SparkSession, root: str, name: str) -> str | None:
    """Day of the latest loaded snapshot of a file."""
    row = manifest(spark, root).filter(F.col("table_name") == name).agg(F.max("version").alias("v")).first()
    return row.v if row else None
