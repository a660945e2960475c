"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regisight.session import materialise

MAX_ID = 9223372036854775807
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of bounded rows and bytes, so that long texts don't pile up in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def give_back() -> None:
    """Memory that Arrow, numpy and Python have freed goes back to the system; allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # only the GNU library has it
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that gives back at the end of each task what it has freed: an executor keeps its Python
    workers, several for each core, for the tasks of later stages, so what each keeps of its largest task would add up."""

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (iid, tkey, doc_id, text): a null id sorts after all others, a null text is empty. tkey tells
    rows apart that share an id with different texts. Other columns are left out, so their names can't clash."""
    id_, text = F.col(f"`{id_col}`").cast("long"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.coalesce(id_, F.lit(MAX_ID)).alias("iid"), F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF)).alias("tkey"), id_.alias("doc_id"), text.alias("text"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column one after another, and the offsets of its rows; null is empty."""
    a = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(a.buffers()[1], dtype=np.int64)[a.offset : a.offset + len(a) + 1]
    data = a.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    start = offsets[0] if len(offsets) else 0
    return buf[start : offsets[-1]] if len(offsets) else buf, offsets - start


def texts(column: pa.Array) -> Iterator[str]:
    return (x or "" for x in column.to_pylist())


def rows(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of undirected edges (a, b) of longs: component is the smallest node reachable.
    Each round hooks every node to the smallest label next to it and then follows labels once more, so
    chains halve; every round is written to the shared folder, which cuts the lineage."""
    both = materialise(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), name)
    label = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")), name)
    while True:
        near = both.join(label.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        hooked = label.join(near, "node").select("node", F.least("component", "near").alias("c"), F.col("component").alias("old"))
        jump = hooked.select(F.col("node").alias("c"), F.col("c").alias("further"))
        new = materialise(hooked.join(jump, "c", "left").select("node", F.least("c", F.coalesce("further", "c")).alias("component"), "old"), name)
        changed = not new.filter("component <> old").isEmpty()
        label = new.select("node", "component")
        if not changed:
            return label
