"""Exact removal of repeated byte strings with sharded suffix arrays.

A string of `length` bytes is a window. Among the GRAM-byte strings inside a window the one with the smallest
hash (leftmost if tied) is its anchor; equal windows have equal anchors at equal offsets. So:

1. The anchors of all windows are hashed, and hashes that occur once in the corpus are dropped: their windows
   can't repeat. An equal window also shares GRAM bytes next to the anchor, left or right, so an occurrence with
   neither side's hash in common with another one goes too. Hashes only select candidates; they decide nothing.
2. The candidate stretches of a shard of documents are sorted into a suffix array, by Larsson-Sadakane
   refinement in numpy: groups of equal prefixes are split by the group numbers further on, doubling the depth.
   Kasai's rule (a common prefix shrinks by one at most when both suffixes lose their first byte) gives the
   common prefix of every suffix with the first of its group; from `length` bytes on the window is repeated.
3. Windows that are first in their shard go on as fragments (the bytes around an anchor) to the tasks that
   merge the shards: by anchor hash, each looking its windows up in the merged order by binary search.

A shard passes on each content once at most, so a passage in a third of all documents reaches a merging task as
often as there are shards, not documents. Nothing is collected on the driver and no pairs are made.

Defined results: matches never cross documents; a null text is empty and gives (0, 0, 0, digest of nothing);
rows that repeat an id are ordered by a hash of their text, and full repeats of a row are the same position, so
they get equal results; a null id comes after all others; an empty table gives an empty table; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regisight.llm.common import MAX_ID, keyed, mix, utf8

LENGTH, GRAM = 100, 32
BLOCK = 1 << 16
SHARD_BYTES = 4 << 20
LANES, SURE, LANE_BIT = 4096, 1 << 16, 40
_LOW = np.uint64((1 << 20) - 1)


def gram_hashes(buf: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of each gram-byte string (a power of two), by doubling."""
    h = buf.astype(np.uint64) + np.uint64(1)
    step = 1
    while step < gram:
        h = h[:-step] * np.uint64(0x9E3779B97F4A7C15 + 2 * step) + h[step:]
        h ^= h >> np.uint64(29)
        step *= 2
    return mix(h)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def anchors(buf: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, last window, sides) of each run of windows with the same anchor hash, for texts that
    lie one after another; no window crosses texts. Worked off in blocks, which changes nothing as an anchor
    depends on its window alone (a run may come in two parts). sides: 8 bits each of the hashes of the bytes left
    and right of the anchor; 0 if the run has anchors at several places, as in a text that repeats itself."""
    n = len(buf) - length + 1
    cut = np.zeros(max(n, 0), dtype=bool)
    for edge in (offsets[:-1], np.maximum(offsets[1:] - length + 1, offsets[:-1])):
        cut[edge[edge < n]] = True
    out = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for lo in range(0, max(0, n), BLOCK):
        halo = min(lo, gram)
        h = gram_hashes(buf[lo - halo : lo + BLOCK + length - 1 + gram], gram)
        core = h[halo : halo + min(BLOCK, n - lo) + length - gram]
        key = (core & ~_LOW) | np.arange(len(core), dtype=np.uint64)
        at = (sliding_min(key, length - gram + 1) & _LOW).astype(np.int64)
        new = cut[lo : lo + len(at)].copy()
        new[0] = True
        new[1:] |= core[at[1:]] != core[at[:-1]]
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(at)]]) - 1
        place = at[first] + halo
        left, right = h[np.maximum(place - gram, 0)] >> np.uint64(56), h[np.minimum(place + gram, len(h) - 1)] >> np.uint64(56)
        sides = np.maximum((left << np.uint64(8) | right).astype(np.int64), 1)
        out.append((core[at[first]], first + lo, last + lo, np.where(at[first] == at[last], sides, 0)))
    h, first, last, sides = (np.concatenate(x) for x in zip(*out, strict=True))
    inside = first + length <= offsets[np.searchsorted(offsets, first, "right")] if len(first) else np.zeros(0, dtype=bool)
    return h[inside], first[inside], last[inside], sides[inside]


def suffix_groups(text: np.ndarray, depth: int) -> np.ndarray:
    """Group number of every suffix by its first `depth` bytes: equal numbers mean equal prefixes, and numbers
    rise in suffix order (a group's number is its first slot in the suffix array). Larsson-Sadakane: only groups
    of two or more are sorted again, by the group numbers `step` bytes on, which doubles the depth."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.ndarray(n, dtype=">u8", buffer=padded, strides=(1,)).astype(np.uint64)
    at, slot = np.argsort(key), np.arange(n)
    key = key[at]
    group = np.full(n + depth, -1, dtype=np.int64)
    have = 8
    while True:
        new = np.ones(len(at) + 1, dtype=bool)
        new[1:-1] = key[1:] != key[:-1]
        group[at] = np.maximum.accumulate(np.where(new[:-1], slot, 0))
        if have >= depth:
            return group[:n]
        several = ~(new[:-1] & new[1:])
        at, slot = at[several], slot[several]
        if not len(at):
            return group[:n]
        step = min(have, depth - have)
        key = (group[at] << 32) | (group[at + step] + 1)
        by = np.argsort(key)
        at, key = at[by], key[by]
        have += step


def common_prefix(text: np.ndarray, at: np.ndarray, first: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix, `most` at most, of the suffixes at `at` (ascending) and `first`. Kasai: if the
    pair before is this pair less one byte on the left, at least its prefix less one is common, so one byte is
    compared; only the heads of such runs are compared in full."""
    padded = np.concatenate([text, np.zeros(most, np.uint8)])
    lcp = np.zeros(len(at), dtype=np.int64)
    follows = np.zeros(len(at), dtype=bool)
    follows[1:] = (at[1:] == at[:-1] + 1) & (first[1:] == first[:-1] + 1)
    live = np.flatnonzero(~follows)
    for k in range(most):
        live = live[padded[at[live] + k] == padded[first[live] + k]]
        if not len(live):
            break
        lcp[live] = k + 1
    run = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
    one_more = padded[at + most - 1] == padded[first + most - 1]
    # along a run the prefix stays `most` as long as each new last byte agrees and the head had it
    broken = np.where(follows & ~one_more, np.arange(len(at)), -1)
    last_broken = np.maximum.accumulate(broken)
    whole = (lcp[run] == most) & (last_broken <= run)
    lcp[follows & whole] = most
    rest = np.flatnonzero(follows & ~whole)
    for k in range(most):
        rest = rest[padded[at[rest] + k] == padded[first[rest] + k]]
        if not len(rest):
            break
        lcp[rest] = k + 1
    return lcp


def repeated(text: np.ndarray, starts: np.ndarray, rank: np.ndarray, length: int) -> np.ndarray:
    """Whether the window at each of `starts` (ascending) equals a window of smaller rank; rank orders the
    occurrences, equal ranks being the same position."""
    g = suffix_groups(text, length)[starts]
    some = np.flatnonzero(np.bincount(g)[g] > 1)
    out = np.zeros(len(starts), dtype=bool)
    if not len(some):
        return out
    g, at, rank = g[some], starts[some], rank[some]
    by = np.lexsort((rank, g))
    lead = by[np.concatenate([[True], g[by][1:] != g[by][:-1]])]  # the first occurrence of each group, groups in suffix order
    mine = lead[np.searchsorted(g[lead], g)]  # binary search in that order
    k = np.flatnonzero(rank[mine] < rank)
    out[some[k]] = common_prefix(text, at[k], at[mine[k]], length) >= length
    return out


def runs(marked: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive marked positions."""
    p = at[marked]
    if not len(p):
        return p, p
    cut = np.flatnonzero(p[1:] != p[:-1] + 1)
    return p[np.concatenate([[0], cut + 1])], p[np.concatenate([cut, [len(p) - 1]])]


def ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All positions of inclusive ranges, one after another."""
    n = last - first + 1
    return np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else first


def first_seen(h: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each (h, value) is the first such pair, and whether it comes more than once."""
    by = np.lexsort((value, h))
    new = np.ones(len(by) + 1, dtype=bool)
    new[1:-1] = (h[by[1:]] != h[by[:-1]]) | (value[by[1:]] != value[by[:-1]])
    first, several = np.empty(len(by), dtype=bool), np.empty(len(by), dtype=bool)
    first[by], several[by] = new[:-1], ~(new[:-1] & new[1:])
    return first, several


def _anchor_rows(length: int):
    """at: the first window of a run of windows within its text, times 2^20, plus the number of further ones.
    Rows whose hash and side repeat within the batch are sure candidates (SURE set in sides); those that bring no new
    side of their hash stand for nothing that another row doesn't, and get a lane of their own (in sides above SURE, and
    in the hash, so that rows of one hash and lane are those of one h): so a hash in any share
    of all documents comes to one lane as often as there are batches and sides, not documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, at = utf8(b.column(2))
            h, first, last, sides = anchors(buf, at, length)
            row = np.searchsorted(at, first, "right") - 1
            take = pa.array(row)
            vague = np.where(sides == 0, 256, 0)
            (new_l, more_l), (new_r, more_r) = (first_seen(h, side + vague) for side in (sides >> 8, sides & 255))
            lane = np.where(new_l | new_r, 0, 1 + row % LANES)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64) ^ (lane << LANE_BIT)), b.column(0).take(take), b.column(1).take(take),
                                              pa.array(((first - at[row]) << 20) + last - first), pa.array((sides | np.where(more_l | more_r, SURE, 0) | lane << 17).astype(np.int32))],
                                             names=["h", "iid", "tkey", "at", "sides"])

    return run


#: A fragment: anchor hash, document, first window and bytes; or (h null) marks: ranges of window starts in body.
MARKS = "h long, iid long, tkey long, at long, body binary"
_MARKS = pa.schema([("h", pa.int64()), ("iid", pa.int64()), ("tkey", pa.int64()), ("at", pa.int64()), ("body", pa.binary())])


def packed(first: np.ndarray, last: np.ndarray) -> bytes:
    return np.stack([first, last], 1).astype(np.int64).tobytes()


def _shard_rows(length: int):
    """Marks of windows repeated within a shard (h null), and fragments with windows that are first in it."""

    def shard(docs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        out: list[list] = [[] for _ in _MARKS]

        def add(*values) -> None:
            for o, v in zip(out, values, strict=True):
                o.append(v)

        docs.sort(key=lambda d: d[:2])
        stretches, starts, ranks, info, size = [], [], [], [], 0
        position, previous = 0, None
        for iid, tkey, buf, h, at in docs:
            by = np.argsort(at)
            h, first = h[by], at[by] >> 20
            last = first + (at[by] & ((1 << 20) - 1))
            if (iid, tkey) != previous:
                position += 0 if previous is None else before
            previous, before = (iid, tkey), len(buf)
            lo, hi = runs(np.ones(int((last - first + 1).sum()), dtype=bool), ranges(first, last))
            shift = np.zeros(len(buf), dtype=np.int64)  # place in the shard's text of each byte
            for p, q in zip(lo.tolist(), hi.tolist()):
                stretches.append(buf[p : q + length])
                shift[p : q + length] = size - p
                size += q + length - p
            p = ranges(first, last)
            starts.append(p + shift[p])
            ranks.append(p + position)
            info.append((iid, tkey, buf, h, first, last, p))
        if not size:
            return rows_of(out)
        starts_, ranks_ = np.concatenate(starts), np.concatenate(ranks)
        by = np.argsort(starts_, kind="stable")
        marked = np.empty(len(by), dtype=bool)
        marked[by] = repeated(np.concatenate(stretches), starts_[by], ranks_[by], length)
        done = 0
        for iid, tkey, buf, h, first, last, p in info:
            m = marked[done : done + len(p)]
            done += len(p)
            lo, hi = runs(m, p)
            if len(lo):
                add(None, iid, tkey, 0, packed(lo, hi))
            end = np.cumsum(last - first + 1)
            free = np.concatenate([[0], np.cumsum(~m)])
            n_free = free[end] - free[end - (last - first + 1)]
            for k in np.flatnonzero(n_free).tolist():
                f, e = int(first[k]), int(last[k])
                add(int(h[k]), iid, tkey, f, buf[f : e + length].tobytes())
        return rows_of(out)

    def rows_of(out: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, _MARKS, strict=True)], schema=_MARKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, size = [], 0
        for b in batches:
            buf, at = utf8(b.column(2))
            cut = b.column(3).offsets.to_numpy()
            hs, ats = (b.column(3).values.field(f).to_numpy() for f in ("h", "at"))
            for k, (iid, tkey) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                docs.append((iid, tkey, buf[at[k] : at[k + 1]].copy(), hs[cut[k] : cut[k + 1]], ats[cut[k] : cut[k + 1]]))
                size += int(at[k + 1] - at[k])
                if size >= SHARD_BYTES:
                    yield shard(docs)
                    docs, size = [], 0
        if docs:
            yield shard(docs)

    return run


def _merge_rows(length: int):
    """Marks of fragment windows that equal an earlier window of another shard; rows come sorted by h."""

    def merge(rows: list[tuple]) -> pa.RecordBatch:
        out: list[list] = [[] for _ in _MARKS]
        rows.sort(key=lambda r: (r[1], r[2], r[3]))
        def mark(row: tuple, lo: np.ndarray, hi: np.ndarray) -> None:
            for o, v in zip(out, (None, row[1], row[2], 0, packed(lo, hi)), strict=True):
                o.append(v)

        # of fragments that are equal as a whole, only the first takes part; the others repeat it
        seen: dict[bytes, tuple] = {}
        for r in rows:
            q = seen.setdefault(r[4], r)
            if q[1:4] != r[1:4]:
                mark(r, np.array([r[3]]), np.array([r[3] + len(r[4]) - length]))
        rows = list(seen.values())
        # rank: documents in order, positions within; equal (iid, tkey) are the same document
        span = max(r[3] + len(r[4]) for r in rows) + 1
        ids = np.cumsum([0, *(r[1:3] != q[1:3] for q, r in zip(rows, rows[1:]))])
        size = np.array([len(r[4]) for r in rows])
        begin = np.concatenate([[0], np.cumsum(size)[:-1]])
        first = np.array([r[3] for r in rows])
        n = size - length + 1
        rank = ranges(first, first + n - 1) + np.repeat(ids * span, n)
        marked = repeated(np.frombuffer(b"".join(r[4] for r in rows), dtype=np.uint8), ranges(begin, begin + n - 1), rank, length)
        end = np.cumsum(n)
        for k in np.unique(np.searchsorted(end, np.flatnonzero(marked), "right")).tolist():
            lo, hi = runs(marked[end[k] - n[k] : end[k]], np.arange(n[k]) + first[k])
            mark(rows[k], lo, hi)
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, _MARKS, strict=True)], schema=_MARKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for b in batches:
            local = b.filter(pc.is_null(b.column(0)))
            if len(local):
                yield local
            b = b.filter(pc.is_valid(b.column(0)))
            for h, iid, tkey, first, fragment in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                if size >= SHARD_BYTES and rows[-1][0] != h:
                    yield merge(rows)
                    rows, size = [], 0
                rows.append((h, iid, tkey, first, fragment))
                size += len(fragment)
        if rows:
            yield merge(rows)

    return run


def marked_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs: keyed rows. (iid, tkey, first, last): ranges of window starts that repeat an earlier window."""
    text = docs.select("iid", "tkey", "text")
    found = text.mapInArrow(_anchor_rows(length), "h long, iid long, tkey long, at long, sides int")
    same = lambda *more: Window.partitionBy("h", *more)  # noqa: E731  all within the partitions by h, which holds the lane
    sure, both = F.col("sides").bitwiseAND(F.lit(SURE)) != 0, F.col("sides").bitwiseAND(F.lit(SURE - 1))
    lane = F.shiftright("sides", 17).cast("long")
    often = found.withColumn("n", F.count(F.lit(1)).over(same())).withColumn("single", F.min(both != 0).over(same())).filter(sure | (F.col("n") > 1) | ~F.col("single"))
    left, right = F.shiftright(both, 8), F.col("sides").bitwiseAND(F.lit(0xFF))
    sided = often.withColumn("l", left).withColumn("r", right).withColumn("nl", F.count(F.lit(1)).over(same("l"))).withColumn("nr", F.count(F.lit(1)).over(same("r")))
    often = sided.filter(sure | ~F.col("single") | (F.col("nl") > 1) | (F.col("nr") > 1))
    wanted = often.groupBy("iid", "tkey").agg(F.collect_list(F.struct(F.col("h").bitwiseXOR(F.shiftleft(lane, LANE_BIT)).alias("h"), "at")).alias("wanted"))
    local = text.join(wanted, ["iid", "tkey"]).select("iid", "tkey", "text", "wanted").mapInArrow(_shard_rows(length), MARKS)
    # marks of shards (h null) pass through the merging tasks, spread by document
    dealt = local.withColumn("to", F.coalesce("h", F.xxhash64("iid", "tkey"))).repartition(F.col("to")).sortWithinPartitions("h").drop("to")
    return dealt.mapInArrow(_merge_rows(length), MARKS).select("iid", "tkey", "body")


def _covered(marks: list[bytes] | None, length: int) -> tuple[list[tuple[int, int]], int]:
    """Maximal removed runs [begin, end) and their bytes."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((a, b + length) for a, b in np.frombuffer(b"".join(marks or ()), dtype=np.int64).reshape(-1, 2).tolist()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out, sum(b - a for a, b in out)


def _kept_rows(length: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, at = utf8(b.column(2))
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for k, marks in enumerate(b.column(3).to_pylist()):
                whole = buf[at[k] : at[k + 1]].tobytes()
                spans, removed = _covered(marks, length)
                edges = [0, *(x for s in spans for x in s), len(whole)]
                rest = b"".join(whole[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True))
                n_bytes.append(len(whole))
                n_removed.append(removed)
                n_spans.append(len(spans))
                kept.append(hashlib.sha256(rest).hexdigest() if digest else rest)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
                                              pa.array(kept, pa.string() if digest else pa.binary())], names=["iid", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, digest: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans and kept, the remaining bytes (with digest: their SHA-256)."""
    rows = keyed(docs, id_col, text_col).select("iid", "tkey", "text")
    if rows.groupBy("iid").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").isEmpty():
        # ids tell all rows apart and the key, which only orders rows of one id, need not be moved; 0, but no constant that would change how keys are dealt
        rows = rows.withColumn("tkey", F.col("iid").bitwiseAND(F.lit(0).cast("long")))
    marks = marked_windows(rows, length).groupBy("iid", "tkey").agg(F.collect_list("body").alias("marks"))
    joined = rows.join(marks, ["iid", "tkey"], "left").select("iid", "tkey", "text", "marks")
    out = joined.mapInArrow(_kept_rows(length, digest), f"iid long, n_bytes long, n_removed long, n_spans long, kept {'string' if digest else 'binary'}")
    return out.select(F.nullif("iid", F.lit(MAX_ID)).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")
