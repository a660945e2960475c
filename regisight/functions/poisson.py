"""Range of ordinary variation of a count around its expected value, from a stored grid of quantiles."""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regisight.plans.sizing import small_side
from regisight.session import materialise

BINS_PER_TASK = 4096
_lgamma = np.vectorize(math.lgamma, otypes=[float])


def _at_most(k: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(X <= k) and P(X = k), terms added from k downward until they no longer count."""
    own = np.exp(k * np.log(mean) - mean - _lgamma(k + 1.0))
    term, total, j = own.copy(), own.copy(), k.astype(float)
    while True:
        term = term * j / mean
        j = np.maximum(j - 1, 0)
        total = total + term
        if not (((term > 1e-18 * total) | (j > mean)) & (j > 0)).any():
            return total, own


def breaks(k: np.ndarray, p: float) -> np.ndarray:
    """The mean at which P(X <= k) falls to p: up to it the p-quantile is at most k. Newton steps from the cube-root
    approximation of the gamma quantile, each at most halving or doubling."""
    a, z = k + 1.0, NormalDist().inv_cdf(1 - p)
    mean = np.maximum(a * (1 - 1 / (9 * a) + z / (3 * np.sqrt(a))) ** 3, 1e-6 * a)
    for _ in range(60):
        total, own = _at_most(k, mean)
        moved = np.clip(mean + (total - p) / np.maximum(own, 1e-300), mean / 2, mean * 2)
        done = np.abs(moved - mean) <= 1e-13 * moved
        mean = moved
        if done.all():
            break
    return mean


def poisson_grid(spark: SparkSession, top: float, probabilities: dict[str, float]) -> DataFrame:
    """One row for each unit of the mean up to top: for each probability the quantile at the unit's start, and the means
    within the unit at which it grows by one."""
    names = list(probabilities)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in b.column(0).to_pylist():
                bins = np.arange(start, start + BINS_PER_TASK)
                reach = 6 * math.sqrt(bins[-1] + 1) + 20
                k = np.arange(max(0, int(bins[0] - reach)), int(bins[-1] + 1 + reach))
                columns = []
                for p in probabilities.values():
                    at = breaks(k, p)
                    cut = np.searchsorted(at, np.append(bins, bins[-1] + 1).astype(float), "left")
                    inside = [at[x:y].tolist() for x, y in zip(cut[:-1], cut[1:], strict=True)]
                    columns.append(pa.StructArray.from_arrays([pa.array(k[0] + cut[:-1], pa.int64()), pa.array(inside, pa.list_(pa.float64()))], names=["base", "breaks"]))
                yield pa.RecordBatch.from_arrays([pa.array(bins, pa.int64()), *columns], names=["bin", *names])

    starts = spark.range(0, int(top) + 1, BINS_PER_TASK, max(1, int(top) // BINS_PER_TASK + 1))
    return starts.mapInArrow(build, "bin bigint, " + ", ".join(f"`{n}` struct<base bigint, breaks array<double>>" for n in names))


def with_poisson_quantiles(df: DataFrame, mean: str, probabilities: dict[str, float]) -> DataFrame:
    """Adds the Poisson quantiles of the column `mean`; NULL and negative means have none. The grid reaches to the largest
    mean and is met once, on the unit the mean lies in."""
    rows = materialise(df, "expected")
    value = F.col(f"`{mean}`").cast("double")
    top = rows.agg(F.max(value)).first()[0]
    if top is None or top < 0:
        return rows.select("*", *[F.lit(None).cast("bigint").alias(n) for n in probabilities])
    grid = materialise(poisson_grid(df.sparkSession, top, probabilities), "quantiles").withColumnsRenamed({n: f"_{n}" for n in probabilities})
    met = rows.withColumn("_mean", value).join(small_side(grid.withColumnRenamed("bin", "_bin")), F.floor("_mean") == F.col("_bin"), "left")
    grown = {n: F.col(f"_{n}.base") + F.size(F.filter(f"_{n}.breaks", lambda x: x < F.col("_mean"))) for n in probabilities}
    return met.select(*[F.col(f"`{c}`") for c in df.columns], *[q.cast("bigint").alias(n) for n, q in grown.items()])
