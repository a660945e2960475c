"""Registered queries over the given tables and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def registered(sql: str | None = None, ints: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Registers a query under its own name, with the SQL that must give the same rows; ints are the
    columns Spark returns as 32-bit integers where the SQL gives 64-bit ones."""

    def keep(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            casts = ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in ints)
            ORACLE[fn.__name__] = f"SELECT * REPLACE ({casts}) FROM ({sql})" if casts else sql
        return fn

    return keep


def load_all() -> None:
    from regisight.catalog import classification, economy, feeds, notable, protection, regional, scalars, snapshot, stored, temporal  # noqa: F401
