"""Validity intervals: as-of lookup, slicing, coalescing, clipping, overlaps.

Validity is grained by day, as in the register. Inputs of the ordered operators are first reduced to
one row per key and day by an aggregation with map-side combine, so a window of one key never holds
more rows than the calendar has days, however many source rows that key owns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regisight.functions.codes import valid_at

# Days are numbered from 0001-01-01; the number after every day the date type has (to 9999-12-31) stands for "never".
_SHIFT = 719162
_NEVER = 4 ** 11


def _day_number(day: Column) -> Column:
    return F.unix_date(day).cast("bigint") + _SHIFT


def _end_number(end: Column | str) -> Column:
    """Day number of an exclusive end; an open one (NULL) is after every day."""
    return F.coalesce(_day_number(F.col(end)), F.lit(_NEVER).cast("bigint"))


def as_of(points: DataFrame, intervals: DataFrame, keys: list[str], day: str = "day",
          attributes: list[str] | None = None, carried: list[str] | None = None, following: str | None = None) -> DataFrame:
    """Value valid at each point: of the intervals covering it, the one with the latest start; on equal
    starts the smallest pos.

    points(keys, day[, carried]); intervals(keys, start, end, value, pos[, attribute]); end NULL = open.
    Result: one row per distinct point with its carried columns and column value, or one column per
    attribute; `following` names a column for the next point of the key.

    Starts and points of a key form one timeline, which one pass reads in order. It carries a stack of the
    open intervals of each attribute: a start drops those below it that end no later, a point drops those that
    have ended, and the top holds. Every interval enters and leaves once, and no point meets more than the top. Rows are
    first reduced to one per key and point, and per key, attribute, start and end, with map-side combine, so the
    rows of a very common key are bounded by the calendar, and so is its stack."""
    names = attributes or ["value"]
    one = intervals if attributes else intervals.withColumn("attribute", F.lit("value"))
    shown = [day, *(carried or [])]
    asked = points.select(*keys, F.struct(*shown).alias("_point"), _day_number(F.col(day)).alias("_t"), F.lit(1).alias("_p"))
    proper, start = _start_columns(names)
    starts = one.filter(proper).select(*keys, *start)
    return _held(asked.unionByName(starts, allowMissingColumns=True), keys, names, following).select(
        *keys, *[F.col("_point")[c].alias(c) for c in shown], *names, *([following] if following else []))


def _start_columns(names: list[str]) -> tuple[Column, list[Column]]:
    """Whether an interval can hold at all, and what the timeline takes of it."""
    c = F.col
    index = F.array_position(F.array(*[F.lit(a) for a in names]), c("attribute")).cast("int") - 1
    proper = c("start").isNotNull() & (c("end").isNull() | (c("end") > c("start"))) & (index >= 0)
    return proper, [_day_number(c("start")).alias("_t"), F.lit(0).alias("_p"), index.alias("_a"), _end_number("end").alias("_e"), c("pos"), c("value")]


def _held(line: DataFrame, keys: list[str], names: list[str], following: str | None) -> DataFrame:
    """Points of a timeline (keys, _t, _p, _a, _e, pos, value[, _point]) with the value of each attribute; without _point the
    point is its day number _t."""
    shown = "_point" if "_point" in line.columns else "_t"
    reduced = line.groupBy(*keys, "_t", "_p", "_a", "_e", *(["_point"] if shown == "_point" else [])).agg(
        F.max(F.struct((-F.col("pos")).alias("rank"), "value")).alias("_best"))
    flat = reduced.select(*keys, "_t", "_p", "_a", "_e", F.col("_best.value").alias("_v"), F.col("_best.rank").alias("_r"), *(["_point"] if shown == "_point" else []))
    ordered = flat.repartition(*keys).sortWithinPartitions(*keys, "_t", "_p", "_r").drop("_r")
    kinds = {f.name: f.dataType.simpleString() for f in flat.schema.fields}
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keys] + [f"{shown} {kinds[shown]}"] + [f"_v{i} {kinds['_v']}" for i in range(len(names))] + ["_next bigint"])
    passed = ordered.mapInArrow(_held_values(len(keys), len(names), shown), schema)
    out = [*keys, shown, *[F.col(f"_v{i}").alias(a) for i, a in enumerate(names)]]
    return passed.select(*out, *([F.date_from_unix_date((F.col("_next") - _SHIFT).cast("int")).alias(following)] if following else []))


def _new_keys(columns: list[pa.Array]) -> list[bool]:
    """Whether the key of each row but the first differs from the one before; nulls are equal."""
    new = np.zeros(max(0, len(columns[0]) - 1), dtype=bool)
    for c in columns:
        a, b = c[:-1], c[1:]
        if pa.types.is_nested(c.type):
            new |= np.array([x != y for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], dtype=bool)
        else:
            new |= pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
            new |= a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False)
    return new.tolist()


def _held_values(n_keys: int, n_names: int, shown: str):
    """The ordered pass over batches of (keys, t, p, attribute, end, value[, point]), sorted by key and time, starts
    before points and the best of equal starts last. A point learns of the next one of its key only later, so the last
    row of a batch is held back. Numbers come out of the batch as a whole; a point looks at the stacks only where the
    end of a held value is reached."""

    def rows_of(b: pa.RecordBatch, at: list[int], held: list[tuple], following: list[int | None]) -> pa.RecordBatch:
        places = pa.array(at, pa.int64())
        own = [c.take(places) for c in (*b.columns[:n_keys], b.column(shown))]
        kind = b.schema.field(n_keys + 4).type
        values = [pa.array(v, kind) for v in zip(*held, strict=True)]
        names = [*b.schema.names[:n_keys], shown, *[f"_v{i}" for i in range(n_names)], "_next"]
        return pa.RecordBatch.from_arrays([*own, *values, pa.array(following, pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, point_before = None, False
        ends: list[list[int]] = [[] for _ in range(n_names)]
        stacks: list[list] = [[] for _ in range(n_names)]
        top, soonest = [None] * n_names, _NEVER + 1
        waiting: tuple[pa.RecordBatch, int, tuple] | None = None
        for b in batches:
            if not len(b):
                continue
            keys = b.columns[:n_keys]
            times, points, attributes, until = (c.fill_null(-1).to_numpy().tolist() for c in b.columns[n_keys : n_keys + 4])
            values = b.column(n_keys + 4).to_pylist()
            first = tuple(c[0].as_py() for c in keys)
            new = [first != key, *_new_keys(keys)]
            key = tuple(c[-1].as_py() for c in keys)
            at, held, following, after_waiting = [], [], [], None
            for i, t in enumerate(times):
                if new[i]:
                    ends, stacks, top, soonest, point_before = [[] for _ in range(n_names)], [[] for _ in range(n_names)], [None] * n_names, _NEVER + 1, False
                if not points[i]:
                    k, e = attributes[i], until[i]
                    own = ends[k]
                    while own and own[-1] <= e:
                        own.pop()
                        stacks[k].pop()
                    own.append(e)
                    stacks[k].append(values[i])
                    top[k] = values[i]
                    soonest = min(soonest, e)
                    continue
                if point_before:
                    after = t if t >= 0 else None
                    if following:
                        following[-1] = after
                    else:
                        after_waiting = after
                if soonest <= t:
                    soonest = _NEVER + 1
                    for k, own in enumerate(ends):
                        while own and own[-1] <= t:
                            own.pop()
                            stacks[k].pop()
                        if own:
                            top[k] = stacks[k][-1]
                            soonest = min(soonest, own[-1])
                        else:
                            top[k] = None
                at.append(i)
                held.append(tuple(top))
                following.append(None)
                point_before = True
            if at:
                if waiting:
                    yield rows_of(waiting[0], [waiting[1]], [waiting[2]], [after_waiting])
                if len(at) > 1:
                    yield rows_of(b, at[:-1], held[:-1], following[:-1])
                waiting = b, at[-1], held[-1]
        if waiting:
            yield rows_of(waiting[0], [waiting[1]], [waiting[2]], [None])

    return run


def version_slices(intervals: DataFrame, keys: list[str], attributes: list[str], lead_attribute: str,
                   closing: DataFrame | None = None) -> DataFrame:
    """Cuts the life of each key at every start and end of its attributes (and at its closing day);
    each slice carries the values valid at its start.

    Slices without a value of lead_attribute, as all before its first start, are left out; equal
    neighbours are merged. Result: keys, start, end, attributes[, gone]."""
    proper, start = _start_columns(attributes)
    kinds = {f.name: f.dataType for f in intervals.schema.fields}
    none = {"_a": F.lit(None).cast("int"), "_e": F.lit(None).cast("bigint"), **{c: F.lit(None).cast(kinds[c]) for c in ("pos", "value")}}

    def point(day: str) -> Column:
        return F.struct(_day_number(F.col(day)).alias("_t"), F.lit(1).alias("_p"), *[v.alias(c) for c, v in none.items()])

    # an interval gives its start and its two days in one go, so what it comes from is computed once
    line = intervals.select(*keys, F.explode(F.array(
        F.when(proper, F.struct(*start)), F.when(F.col("start").isNotNull(), point("start")), F.when(F.col("end").isNotNull(), point("end")))).alias("_row")
    ).filter(F.col("_row").isNotNull()).select(*keys, "_row.*")
    if closing is not None:
        line = line.unionByName(closing.filter(F.col("closed").isNotNull()).select(*keys, point("closed").alias("_row")).select(*keys, "_row.*"))
    day = F.date_from_unix_date((F.col("_t") - _SHIFT).cast("int"))
    valued = _held(line, keys, attributes, "end").filter(F.col(lead_attribute).isNotNull()).select(*keys, day.alias("start"), *attributes, "end")
    content = list(attributes)
    if closing is not None:
        valued = valued.join(closing.select(*keys, "closed").hint("merge"), keys, "left").withColumn(
            "gone", F.coalesce(F.col("start") >= F.col("closed"), F.lit(False))
        ).drop("closed")
        content.append("gone")
    return coalesce_adjacent(valued, keys, content)


def coalesce_adjacent(slices: DataFrame, keys: list[str], content: list[str]) -> DataFrame:
    """Merges neighbours with end == next start and equal content; a gap breaks the run.
    One row per key and start is expected."""
    w = Window.partitionBy(*keys).orderBy("start")
    same = F.lag("end").over(w).eqNullSafe(F.col("start"))
    for c in content:
        same = same & F.lag(c).over(w).eqNullSafe(F.col(c))
    first = F.row_number().over(w) == 1
    marked = slices.withColumn("_new", F.when(first | ~same, 1).otherwise(0))
    runs = marked.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*keys, "_run").agg(
        F.min("start").alias("start"), F.max_by(F.struct("end"), "start")["end"].alias("end"),
        *[F.min_by(F.struct(c), "start")[c].alias(c) for c in content],
    ).drop("_run")


def clip_overlaps(intervals: DataFrame, keys: list[str], carried: list[str]) -> DataFrame:
    """An older interval ends where the next one starts; of equal starts the last (largest pos) stays.
    clipped marks shortened rows, replaced counts rows dropped for an equal start."""
    proper = intervals.filter(F.col("end").isNull() | (F.col("end") > F.col("start")))
    daily = proper.groupBy(*keys, "start").agg(
        F.max_by(F.struct("end", *carried), "pos").alias("_row"), (F.count(F.lit(1)) - 1).alias("replaced")
    ).select(*keys, "start", "_row.*", "replaced")
    nxt = F.lead("start").over(Window.partitionBy(*keys).orderBy("start"))
    clipped = F.coalesce(nxt.isNotNull() & (F.col("end").isNull() | (F.col("end") > nxt)), F.lit(False))
    return daily.select(*keys, "start", F.when(clipped, nxt).otherwise(F.col("end")).alias("end"), *carried,
                        clipped.alias("clipped"), "replaced")


def overlap_violations(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Starts at which an earlier interval of the same key is still valid, or which several share.
    Empty intervals do not count. Result: keys, start, end (latest), rows, overlaps_until."""
    open_end = F.lit("9999-12-31").cast("date")
    proper = intervals.filter(F.col("end").isNull() | F.col("start").isNull() | (F.col("end") > F.col("start")))
    daily = proper.groupBy(*keys, F.coalesce("start", F.lit("0001-01-01").cast("date")).alias("start")).agg(
        F.max(F.coalesce("end", open_end)).alias("end"), F.max(_end_number("end")).alias("_e"), F.count(F.lit(1)).alias("rows")
    )
    before = Window.partitionBy(*keys).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reach = daily.withColumn("overlaps_until", F.max("end").over(before)).withColumn("_reach", F.max("_e").over(before))
    return reach.filter((F.col("_reach") > _day_number(F.col("start"))) | (F.col("rows") > 1)).drop("_e", "_reach")


def at_time(versions: DataFrame, valid: Column, recorded: Column) -> DataFrame:
    """Rows valid at one day as recorded at one time."""
    return versions.filter(
        (F.col("recorded_from") <= recorded)
        & (F.col("recorded_to").isNull() | (F.col("recorded_to") > recorded))
        & valid_at(F.col("start"), F.col("end"), valid)
    )
