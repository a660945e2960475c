"""Register snapshots from CSV: contract, reading, reconciliation, idempotent load."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from regisight.functions import fixed as X
from regisight.sources import tables as B
from regisight.sources.tables import LoadRefused


@dataclass(frozen=True)
class FileContract:
    """Columns of a snapshot file, the date ones among them, and whether its text may hold line ends."""

    name: str
    columns: tuple[str, ...]
    dates: tuple[str, ...]
    quoted_text: bool


SUBJECTS = FileContract("res_data", X.SUBJECT_COLUMNS, X.SUBJECT_DATES, True)
ACTIVITIES = FileContract("res_pf_nace", X.ACTIVITY_COLUMNS, X.ACTIVITY_DATES, False)


def check_structure(spark: SparkSession, contract: FileContract, metadata_path: str, csv_path: str | None = None) -> None:
    """Refuses before any load when the metadata or the header differ from the contract."""
    meta = spark.read.schema(
        "tableSchema struct<columns array<struct<name string, datatype string>>>"
    ).option("multiLine", True).json(metadata_path).first()
    columns = list(meta.tableSchema.columns) if meta and meta.tableSchema else []
    names = tuple(c.name for c in columns)
    if names != contract.columns:
        raise LoadRefused(f"{contract.name}: metadata list other columns: {names}")
    dates = {c.name for c in columns if c.datatype == "date"}
    if dates != set(contract.dates):
        raise LoadRefused(f"{contract.name}: metadata list other date columns: {sorted(dates)}")
    if csv_path is not None and (header := first_line(spark, csv_path)[0]) != contract.columns:
        raise LoadRefused(f"{contract.name}: header differs from the contract: {header}")


def first_line(spark: SparkSession, path: str) -> tuple[tuple[str, ...], str]:
    """The header's columns, and what ends the lines of the file: CRLF or LF."""
    first = spark.read.option("lineSep", "\n").text(path).first()
    text = first.value if first else ""
    return tuple(text.removesuffix("\r").lstrip("\ufeff").replace('"', "").split(",")) if text else (), "\r\n" if text.endswith("\r") else "\n"


def read_snapshot(spark: SparkSession, contract: FileContract, path: str, line_end: str = "\r\n", corrupt: str | None = None) -> DataFrame:
    """All columns as text, empty and "" as NULL; a wrong header raises. Quoted line ends need multiLine,
    which reads a file in one task; files without quoted text are split. Either way the CSV is read once
    and lives on as Parquet by snapshot. corrupt names a column for rows that don't have the columns of the header."""
    schema = StructType([StructField(c, StringType()) for c in (*contract.columns, *([corrupt] if corrupt else []))])
    reader = (
        spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("quote", '"')
        .option("escape", '"').option("encoding", "UTF-8"))
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    if contract.quoted_text:
        reader = reader.option("multiLine", True).option("lineSep", line_end)
    return reader.csv(path)


def typed(raw: DataFrame, contract: FileContract) -> DataFrame:
    """Only the declared dates change type, what is no date becomes NULL; names become lower case."""
    return raw.select(*[
        (F.col(c).try_cast("date") if c in contract.dates else F.col(c)).alias(c.lower()) for c in contract.columns])


def malformed_dates(contract: FileContract) -> Column:
    """Whether a declared date of the row is none."""
    return reduce(lambda a, b: a | b, [F.col(c).isNotNull() & F.col(c).try_cast("date").isNull() for c in contract.dates])


def load_snapshot(spark: SparkSession, contract: FileContract, path: str, metadata_path: str, root: str, batch_id: str) -> tuple[str, int, bool]:
    """(snapshot day, rows, newly loaded). A day already loaded with the same content is skipped, with
    other content refused: snapshots are never rewritten.

    The file is parsed once, while it is written under a folder of its own load; its rows, days, broken rows and
    fingerprint are observed by that write. Only a load whose stored rows equal the observed ones, of one day and without
    broken rows, is registered; what is not registered is never read."""
    check_structure(spark, contract, metadata_path, path)
    raw = read_snapshot(spark, contract, path, first_line(spark, path)[1], "_corrupt")
    seen = Observation()
    day, names = F.col("DATPLAT"), list(contract.columns)
    facts = [F.min(day).alias("first"), F.max(day).alias("last"), F.count_if(day.isNull()).alias("undated"), F.count_if(F.col("_corrupt").isNotNull()).alias("broken"), F.count_if(malformed_dates(contract)).alias("malformed")]
    load = f"{batch_id}-{uuid.uuid4().hex[:8]}"
    target = f"{root}/{contract.name}/load={load}"
    typed(raw.observe(seen, *B.fingerprint_columns(names), *facts), contract).write.parquet(target)
    f = seen.get
    if f["broken"]:
        raise LoadRefused(f"{contract.name}: {f['broken']} rows without the columns of the header")
    if f["malformed"]:
        raise LoadRefused(f"{contract.name}: {f['malformed']} rows with malformed dates")
    if f["rows"] == 0 or f["undated"] or f["first"] != f["last"]:
        raise LoadRefused(f"{contract.name}: validity days in one file: {f['first']} to {f['last']}, {f['undated']} rows without, {f['rows']} rows")
    mark = f"{f['rows']}:{f['hash']}:{f['hash2']}"
    known = B.manifest(spark, root).filter((F.col("table_name") == contract.name) & (F.col("version") == f["first"])).first()
    if known is not None:
        if known.fingerprint != mark:
            raise LoadRefused(f"{contract.name} {f['first']}: stored with other content; snapshots are not rewritten")
        return f["first"], f["rows"], False
    written = spark.read.parquet(target).count()
    if written != f["rows"]:
        raise LoadRefused(f"{contract.name}: {written} rows written, {f['rows']} read")
    B._append(spark, f"{root}/_manifest", (contract.name, f["first"], written, mark, batch_id, B._now(), load), B.MANIFEST)
    return f["first"], written, True


def snapshots(spark: SparkSession, contract: FileContract, root: str) -> DataFrame:
    """All registered snapshots, with their day as column snapshot. The day is told from the folder of the load, so a
    filter on it prunes folders."""
    loads = B.manifest(spark, root).filter(F.col("table_name") == contract.name).select("version", "load").collect()  # one row a day
    if not loads:
        raise LoadRefused(f"{contract.name}: no snapshot is loaded")
    day = F.lit(None).cast("date")
    for r in loads:
        day = F.when(F.col("load") == r.load, F.lit(r.version).cast("date")).otherwise(day)
    base = f"{root}/{contract.name}"
    stored = spark.read.option("basePath", base).schema(_stored_schema(contract)).parquet(*[f"{base}/load={r.load}" for r in loads])
    return stored.withColumn("snapshot", day).drop("load")


def _stored_schema(contract: FileContract) -> str:
    return ", ".join([f"{c.lower()} {'date' if c in contract.dates else 'string'}" for c in contract.columns] + ["load string"])
