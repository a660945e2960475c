"""Stored tables in buckets of their key's hash: a batch reads, audits and replaces only the buckets its keys fall in.

A table has parts. In a replaced part (open versions) the newest files of a bucket are the bucket; in a growing part
(closed versions, identities) files are only added, until `compact` puts one in the place of many. Files are written
under a folder of their own attempt and become visible with the rows of the table's log that name them, written as
one file: a failed, lost or repeated attempt shows nothing. The log remembers batch ids, so a batch that comes
again changes nothing, not even when it is delivered by another run. One writer a table is expected; a second one is
noticed and refused.

A bucket that holds a very common key is written as several files by the hash of the row's content, and its rows
meet new ones on (key, content hash), so such a key spreads over tasks."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regisight.operators import history as H
from regisight.session import materialise
from regisight.sources.tables import LoadRefused, _append, _now

LOG = "seq bigint, batch_id string, at timestamp, part string, bucket int, replaces boolean, path string, rows bigint"
OPEN, CLOSED, ROWS, SIZE = "open", "closed", "rows", "size"
MAX_BUCKETS = 65_536  # what a log's current state on the driver is bounded by
FILE_ROWS = 1_000_000
MANY_FILES = 16


@dataclass
class State:
    """The log's current state: number of buckets, last sequence, and the files of each part and bucket."""

    buckets: int
    log: tuple[str, ...] = ()
    seq: int = 0
    known: bool = False
    files: dict[tuple[str, int], list[str]] = field(default_factory=dict)
    rows: dict[tuple[str, int], int] = field(default_factory=dict)


def state(spark: SparkSession, root: str, name: str, buckets: int, batch_id: str | None = None) -> State:
    """Read in one aggregation of the log; `known` tells whether the batch is already in it."""
    if not 0 < buckets <= MAX_BUCKETS:
        raise ValueError(f"1 to {MAX_BUCKETS} buckets")
    path, listed = f"{root}/{name}/_log", _listed(spark, root, name)
    if not listed:
        return State(buckets)
    c = F.col
    entries = F.collect_list(F.struct("seq", "path", "rows"))
    last = F.coalesce(F.max(F.when(c("replaces"), c("seq"))), F.lit(0).cast("bigint"))
    log = spark.read.schema(LOG).parquet(path).groupBy("part", "bucket").agg(
        entries.alias("e"), last.alias("last"), F.max("seq").alias("seq"), F.max(c("batch_id") == F.lit(batch_id or "")).alias("known"))
    out = State(buckets, listed)
    for r in log.select("part", "bucket", F.filter("e", lambda x: x["seq"] >= c("last")).alias("e"), "seq", "known").collect():
        out.seq, out.known = max(out.seq, r.seq), out.known or bool(r.known)
        if r.part == SIZE:
            out.buckets = r.bucket
        else:
            full = sorted((x.seq, x.path, x.rows) for x in r.e if x.rows)
            out.files[r.part, r.bucket], out.rows[r.part, r.bucket] = [p for _, p, _ in full], sum(n for *_, n in full)
    return out


def _listed(spark: SparkSession, root: str, name: str) -> tuple[str, ...]:
    """Names of the log's files, one for each batch."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/_log")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return tuple(sorted(f.getPath().getName() for f in fs.listStatus(path) if f.getPath().getName().startswith("part-"))) if fs.exists(path) else ()


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, files: list[str], like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(*files) if files else like.limit(0)


def read_part(spark: SparkSession, root: str, name: str, part: str, touched: list[int] | None = None, st: State | None = None, like: DataFrame | None = None) -> DataFrame:
    """The rows of a part, of some buckets or of all."""
    st = st or state(spark, root, name, 1)
    files = [f for (p, b), fs in sorted(st.files.items()) if p == part and (touched is None or b in set(touched)) for f in fs]
    if like is not None:
        return _read(spark, files, like)
    if not files:
        raise LoadRefused(f"{name}: no rows in {part}")
    return spark.read.parquet(*files)


def versions(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Open and closed versions of a table."""
    st = state(spark, root, name, 1)
    parts = [read_part(spark, root, name, p, None, st) for p in (OPEN, CLOSED) if any(k[0] == p and fs for k, fs in st.files.items())]
    if not parts:
        raise LoadRefused(f"{name}: no rows")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _write(out: DataFrame, path: str, per_bucket: dict[int, int], content: Column, file_rows: int) -> dict[tuple[str, int], int]:
    """Writes (part, bucket, rows ..) to one folder for each part and bucket; how many rows each holds."""
    lanes = {b: -(-n // file_rows) for b, n in per_bucket.items() if n > file_rows}
    lane = F.lit(0).cast("bigint")
    for b, n in lanes.items():
        lane = F.when(F.col("bucket") == b, F.pmod(F.xxhash64(content, F.lit(n)), F.lit(n))).otherwise(lane)
    files = max(1, min(len(per_bucket) + sum(lanes.values()), 20_000))
    out.repartition(files, "bucket", lane).write.partitionBy("part", "bucket").parquet(path)
    stored = out.sparkSession.read.schema("part string, bucket int").parquet(path)
    return {(r.part, r.bucket): r["count"] for r in stored.groupBy("part", "bucket").count().collect()}


def _commit(spark: SparkSession, root: str, name: str, st: State, batch_id: str, entries: list[tuple[str, int, bool, str, int]]) -> None:
    """One file with all rows of the batch; refused if another batch came first."""
    if _listed(spark, root, name) != st.log:
        raise LoadRefused(f"{name}: another batch was stored meanwhile")
    seq, at = st.seq + 1, _now()
    rows = [(seq, batch_id, at, SIZE, st.buckets, True, None, 0)] + [(seq, batch_id, at, *e) for e in entries]
    _append(spark, f"{root}/{name}/_log", rows, LOG)


def _counts(rows: DataFrame, keys: DataFrame, key: str, buckets: int) -> dict[int, int]:
    """Rows of the batch in each bucket that its rows or keys touch."""
    each = rows.select(bucket_of(key, buckets).alias("bucket"), F.lit(1).alias("n")).unionByName(keys.select(bucket_of(key, buckets).alias("bucket"), F.lit(0).alias("n")))
    return {r.bucket: r.n for r in each.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}  # MAX_BUCKETS rows at most


def synchronise(spark: SparkSession, root: str, name: str, key: str, content: list[str], rows: DataFrame, now: Column, batch_id: str,
                keys: DataFrame | None = None, buckets: int = 64, file_rows: int = FILE_ROWS) -> dict[str, int]:
    """Stores a batch of rows as versions: what vanished for a key of the batch is closed, what is new is opened, equal
    content stays. Buckets without a key of the batch keep their files. The stored files are audited against the versions
    before them, and only then become visible. Returns what was closed, opened and kept, and the touched buckets."""
    st = state(spark, root, name, buckets, batch_id)
    if st.known:
        return {"buckets": 0, "kept": 0, "closed": 0, "opened": 0}
    rows = materialise(rows.select(key, *content), "batch")  # read for its counts and again for its versions
    keys = keys if keys is not None else rows
    shape = rows.select(key, *content, now.alias("recorded_from"), F.lit(None).cast(_type(now, rows)).alias("recorded_to"), F.lit(batch_id).alias("batch_id"))
    touched = _counts(rows, keys, key, st.buckets)
    before = read_part(spark, root, name, OPEN, list(touched), st, shape)
    nxt = H.synchronise(before.drop("recorded_to"), rows, key, content, now, F.lit(batch_id), keys)
    out = nxt.select(F.when(F.col("action") == H.CLOSE, CLOSED).otherwise(OPEN).alias("part"), bucket_of(key, st.buckets).alias("bucket"), *shape.columns)
    path = f"{root}/{name}/data/{batch_id}-{uuid.uuid4().hex[:8]}"
    sizes = {b: n + st.rows.get((OPEN, b), 0) for b, n in touched.items()}
    count = _write(out, path, sizes, F.struct(*content), file_rows) if touched else {}
    if count:
        following = spark.read.schema(shape.schema).parquet(*[f"{path}/part={p}/bucket={b}" for p, b in count])
        audit(before, following, key, content, name)
    entries = [(OPEN, b, True, f"{path}/part={OPEN}/bucket={b}", count.get((OPEN, b), 0)) for b in touched]
    entries += [(CLOSED, b, False, f"{path}/part={CLOSED}/bucket={b}", n) for (p, b), n in count.items() if p == CLOSED]
    _commit(spark, root, name, st, batch_id, entries)
    closed = sum(n for (p, _), n in count.items() if p == CLOSED)
    opened = sum(n for (p, _), n in count.items() if p == OPEN)
    kept = sum(st.rows.get((OPEN, b), 0) for b in touched) - closed
    return {"buckets": len(touched), "kept": kept, "closed": closed, "opened": opened - kept}


def _type(now: Column, like: DataFrame) -> str:
    return like.limit(0).select(now.alias("now")).schema["now"].dataType.simpleString()


def audit(before: DataFrame, following: DataFrame, key: str, content: list[str], name: str) -> None:
    """Every open version of the touched buckets must go on or be closed, with the content it had."""
    row_id = F.md5(F.to_json(F.struct(F.col(key).alias("_key"), *content, "recorded_from"), {"ignoreNullFields": "false"}))
    problems = H.audit_versions(before.withColumn("_id", row_id), following.withColumn("_id", row_id), "_id", content)
    if found := problems.take(3):
        raise LoadRefused(f"{name}: {found}")


def insert_new(spark: SparkSession, root: str, name: str, key: str, rows: DataFrame, batch_id: str, buckets: int = 64, file_rows: int = FILE_ROWS) -> int:
    """Adds the rows whose key the table does not hold; null keys and repeated keys of the batch are no new rows. Known keys
    are looked up by a semi join, for which Spark may put a Bloom filter of the batch's keys before the scan; what is
    stored is never rewritten."""
    st = state(spark, root, name, buckets, batch_id)
    if st.known:
        return 0
    wanted = materialise(rows.filter(F.col(f"`{key}`").isNotNull()).dropDuplicates([key]), "batch")
    touched = _counts(wanted, wanted, key, st.buckets)
    stored = read_part(spark, root, name, ROWS, list(touched), st, rows.select(key))
    known = stored.join(wanted.select(key), key, "left_semi").distinct()
    fresh = wanted.join(known, key, "left_anti").select(F.lit(ROWS).alias("part"), bucket_of(key, st.buckets).alias("bucket"), "*")
    path = f"{root}/{name}/data/{batch_id}-{uuid.uuid4().hex[:8]}"
    count = _write(fresh, path, touched, F.col(f"`{key}`"), file_rows) if touched else {}
    _commit(spark, root, name, st, batch_id, [(p, b, False, f"{path}/part={p}/bucket={b}", n) for (p, b), n in count.items()])
    return sum(count.values())


def compact(spark: SparkSession, root: str, name: str, part: str, many: int = MANY_FILES, file_rows: int = FILE_ROWS) -> list[int]:
    """Rewrites the buckets of a growing part that are spread over many folders as one folder each; same rows."""
    st = state(spark, root, name, 1)
    full = [b for (p, b), fs in st.files.items() if p == part and len(fs) >= many]
    if not full:
        return []
    batch_id = f"compact-{uuid.uuid4().hex}"
    path = f"{root}/{name}/data/{batch_id}"
    stored = None
    for b in full:
        one = spark.read.parquet(*st.files[part, b]).select(F.lit(part).alias("part"), F.lit(b).alias("bucket"), "*")
        stored = one if stored is None else stored.unionByName(one)
    count = _write(stored, path, {b: st.rows[part, b] for b in full}, F.struct(*[c for c in stored.columns if c not in ("part", "bucket")]), file_rows)
    if any(count.get((part, b)) != st.rows[part, b] for b in full):
        raise LoadRefused(f"{name}: {part} lost rows in compaction")
    _commit(spark, root, name, st, batch_id, [(part, b, True, f"{path}/part={part}/bucket={b}", count[part, b]) for b in full])
    return sorted(full)
