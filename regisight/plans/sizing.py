"""Broadcast only what is measured to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT = 64 * 1024 * 1024


def small_side(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Broadcast hint when the optimizer's upper size estimate stays within the limit; otherwise the
    plain DataFrame, which joins by shuffle (AQE may still switch when the measured size allows)."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return df
    size = int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= limit else df
