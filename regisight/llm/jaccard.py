"""Near duplicates by word n-gram sets: an exact Jaccard self-join with filters under several token orders.

A document's set are its distinct shingles of WORDS words (64-bit hashes). If two sets reach the similarity t,
then under any order of all shingles the first n - ceil(t n) + 1 of one and of the other have one in common.
Each order puts frequent shingles last (a bounded list of heavy ones from a sketch of the whole corpus, which
decides only the order) and the others by a hash of its own. The first order's prefixes are joined by Spark;
the pairs are then intersected with the other orders' prefixes, and only for those that meet under all are sets fetched.
Prefixes are dealt in packed form to buckets of shingles; a bucket keeps the groups of documents that share one,
each distinct group once. Frequent shingles skip the buckets. Equal groups of different buckets are one before their
members become rows, and groups with the same smallest document are united where that makes few more pairs. Before any set is fetched, pairs
must pass a parity bitmap: bits that differ are a lower bound of the shingles that differ, so no pair is lost.

The join makes no pairs within a group of copies: equal sets are one node, and each shingle first links its
documents with its smallest one only, then in a few rounds with the next smallest. Links are closed to components, after which only
documents of different components that share a prefix shingle remain: these meet in cells of similar size, large
groups in several blocks, where bitmaps are compared in numpy and only the pairs they allow come out, each
from one of its cells. So every
pair that could link two components is looked at, none is capped, and copies in one component make no pairs.

Defined results: a null or empty text, or one without words, has an empty set, 0 shingles and is linked with
nothing; fewer words than WORDS make one shingle of the whole sequence; a shared or null
id links nothing, such rows are told apart by their texts; null ids come after all others, so a component is null only
where no member has an id; an empty table gives an empty table. keep_representatives links rows by their texts alone and keeps other columns.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regisight.llm.common import MAX_ID, components, keyed, lean, materialise, mix, utf8
from regisight.plans.sizing import small_side

WORDS, PERCENT = 5, 75
ORDERS = (0x2545F4914F6CDD1D, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
FRONTS = [f"front{q}" for q in range(1, len(ORDERS))]
HEAVY_LOCAL, HEAVY_LIST, HEAVY_LEAST, HEAVY_LEVEL = 4096, 65536, 4, 9
BUCKET_TOKENS, PARTS = 1_000_000, 8
PIECE = 1 << 18
STARS, BLOCK, FIRST = 3, 1024, 16
SPARE = 1.8
SMALL = 8 << 20

_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_PLACE = mix(np.arange(1 << 12, dtype=np.uint64) + np.uint64(1 << 40)) | np.uint64(1)


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    low = _LOWER[buf]
    space = _SPACE[low]
    start = ~space
    start[1:] &= space[:-1]
    edge = offsets[:-1][(offsets[:-1] < offsets[1:])]
    start[edge] = ~space[edge]
    at = np.flatnonzero(start)
    if not len(at):
        return [np.zeros(0, np.uint64)] * (len(offsets) - 1)
    cut = np.zeros(len(buf), dtype=bool)
    cut[at] = True
    place = np.arange(len(buf)) - np.maximum.accumulate(np.where(cut, np.arange(len(buf)), 0))
    most = int(place[~space].max(initial=0))
    weight = _PLACE if most < len(_PLACE) else mix(np.arange(most + 1, dtype=np.uint64) + np.uint64(1 << 40)) | np.uint64(1)
    value = np.where(space, np.uint64(0), _BYTE[low] * weight[np.where(space, 0, place)])
    w = mix(np.add.reduceat(value, at))
    first = np.searchsorted(at, offsets)
    k = np.uint64(0x9E3779B97F4A7C15)
    s = np.zeros(len(w), dtype=np.uint64)
    for i in range(min(words, len(w))):
        s[: len(w) - i] = s[: len(w) - i] * k + w[i:]
    s = mix(s)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(s[a : b - words + 1]))
        elif b > a:
            short = np.uint64(b - a)
            for x in w[a:b]:
                short = mix(np.array([short ^ x]))[0]
            out.append(np.array([short]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def prefix(s: np.ndarray, order: int, heavy: np.ndarray, level: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first shingles of a set under one order; heavy ones (sorted) come later the higher their level."""
    key = mix(s ^ np.uint64(order)) >> np.uint64(6)
    if len(heavy):
        k = np.minimum(np.searchsorted(heavy, s), len(heavy) - 1)
        key |= np.where(heavy[k] == s, level[k], np.uint64(0)) << np.uint64(58)
    p = prefix_length(len(s), percent)
    return s if p >= len(s) else s[np.argpartition(key, p - 1)[:p]]


def _blocks(b: pa.RecordBatch, column: int, words: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sets) of pieces of a batch of about PIECE bytes of text, which bounds the arrays made of a piece."""
    buf, at = utf8(b.column(column))
    lo = 0
    while lo < len(b):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + PIECE, "right")) - 1)
        yield lo, shingle_sets(buf[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], words)
        lo = hi


def _heavy_rows(words: int):
    """Shingles that are frequent within a batch; token null: number of shingles in the batch."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [s for _, part in _blocks(b, 0, words) for s in part]
            tokens, counts = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            some = np.flatnonzero(counts >= HEAVY_LEAST)
            some = some[np.argsort(-counts[some], kind="stable")[:HEAVY_LOCAL]]
            yield pa.RecordBatch.from_arrays([pa.array([None, *tokens[some].view(np.int64).tolist()], pa.int64()), pa.array([int(counts.sum()), *counts[some].tolist()], pa.int64())],
                                             names=["token", "c"])

    return run


def parity(s: np.ndarray, percent: int = PERCENT) -> bytes:
    """Bitmap of 2^k bits (64 at least): each the parity of the shingles that fall on it. The width follows the lower end
    of the set's step of sizes, so that folding to the lowest of a cell leaves unrelated sets SPARE times as many bits apart as similar ones can be."""
    ratio = 100 / min(percent, 99)
    low = ratio ** math.floor(math.log(max(1, len(s))) / math.log(ratio))
    size = max(64, 1 << math.ceil(math.log2(2 * SPARE * ratio * (ratio - 1) * low)))
    bits = np.bincount((mix(s ^ np.uint64(5)) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def may_link(a: bytes, b: bytes, na: int, nb: int, percent: int) -> bool:
    """Whether two bitmaps allow the similarity; the larger one is folded, which keeps the bound. With similarity
    t the sets differ in at most (1 - t) / (1 + t) of the sum of their sizes."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum()) * (100 + percent) <= (100 - percent) * (na + nb)


def _set_rows(words: int, percent: int):
    """n, a 128-bit signature of the set and its bitmap."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, sig, sig2, bits = [], [], [], []
            for _, part in _blocks(b, 1, words):
                for s in part:
                    n.append(len(s))
                    sig.append(int(np.bitwise_xor.reduce(mix(s ^ np.uint64(77))).view(np.int64)) if len(s) else 0)
                    sig2.append(int(np.add.reduce(mix(s ^ np.uint64(99))).view(np.int64)) if len(s) else 0)
                    bits.append(parity(s, percent))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(sig, pa.int64()), pa.array(sig2, pa.int64()), pa.array(bits, pa.binary())],
                                             names=["iid", "n", "sig", "sig2", "bits"])

    return run


def _prefix_rows(words: int, percent: int, sent, buckets: int):
    """Prefixes of a batch's distinct sets, packed by bucket: 40 bits of each shingle and its document; frequent
    shingles in whole, under a negative bucket."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy, level = sent.value
        hot = heavy[level >= HEAVY_LEVEL]
        for b in batches:
            ids = b.column(0).to_numpy()
            tokens, owner, known = [], [], set()
            for lo, part in _blocks(b, 1, words):
                for k, s in enumerate(part):
                    if len(s) and (whole := s.tobytes()) not in known:
                        known.add(whole)
                        p = prefix(s, ORDERS[0], heavy, level, percent)
                        tokens.append(p)
                        owner.append(np.full(len(p), ids[lo + k]))
            if not tokens:
                continue
            tok, own = np.concatenate(tokens), np.concatenate(owner)
            at = np.minimum(np.searchsorted(hot, tok), max(0, len(hot) - 1))
            is_hot = hot[at] == tok if len(hot) else np.zeros(len(tok), dtype=bool)
            out = [(-1 - int(ids[0] % 1_000_003), tok[is_hot].tobytes(), own[is_hot].tobytes())] if is_hot.any() else []
            tok, own = tok[~is_hot], own[~is_hot]
            bucket = ((tok & np.uint64(0xFFFFFF)) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            tok, own, bucket = tok[by], own[by], bucket[by]
            edge = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]]) if len(bucket) else np.zeros(1, np.int64)
            for a, e in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                short = np.ascontiguousarray(tok[a:e].astype(">u8").view(np.uint8).reshape(-1, 8)[:, :5])
                out.append((int(bucket[a]), short.tobytes(), own[a:e].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], names=["bucket", "tokens", "ids"])

    return run


@lean
def _group_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gid, ids) of the distinct groups of documents that share a shingle, ids sorted; rows come sorted by bucket.
    Frequent shingles have a negative gid and a row for each batch that holds them."""

    def out(gid: np.ndarray, size: np.ndarray, iid: np.ndarray) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(iid, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(gid, pa.int64()), lists], names=["gid", "ids"])

    def frequent(tok: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
        by = np.lexsort((own, tok))
        gid, size = np.unique(tok, return_counts=True)
        return out(gid, size, own[by])

    def groups(bucket: int, tokens: list[bytes], ids: list[bytes]) -> Iterator[pa.RecordBatch]:
        """A bucket's groups, a part of its shingles at a time."""
        short, every = np.frombuffer(b"".join(tokens), np.uint8).reshape(-1, 5), np.frombuffer(b"".join(ids), np.int64)
        tokens.clear()
        ids.clear()
        known: set[bytes] = set()
        for part in range(PARTS):
            at = np.flatnonzero(short[:, 0] % PARTS == part)
            wide = np.zeros((len(at), 8), dtype=np.uint8)
            wide[:, 3:] = short[at]
            tok, own = wide.view(">u8")[:, 0].astype(np.int64), every[at]
            by = np.lexsort((own, tok))
            tok, own = tok[by], own[by]
            edge = np.concatenate([[0], np.flatnonzero(tok[1:] != tok[:-1]) + 1, [len(tok)]])
            several = np.flatnonzero(edge[1:] - edge[:-1] > 1)
            first, keep = len(known), []
            for k, a, e in zip(several.tolist(), edge[several].tolist(), edge[several + 1].tolist(), strict=True):
                if (members := own[a:e].tobytes()) not in known:
                    known.add(members)
                    keep.append(k)
            if keep:
                size = edge[np.add(keep, 1)] - edge[keep]
                yield out((bucket << 32) + first + np.arange(len(keep)), size, own[np.repeat(edge[keep] - np.cumsum(size) + size, size) + np.arange(size.sum())])

    now, tokens, ids = None, [], []
    for b in batches:
        for bucket, t, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            if bucket < 0:
                yield frequent(np.frombuffer(t, np.int64) | np.int64(-(1 << 63)), np.frombuffer(i, np.int64))
                continue
            if bucket != now and tokens:
                yield from groups(now, tokens, ids)
            now = bucket
            tokens.append(t)
            ids.append(i)
    if tokens:
        yield from groups(now, tokens, ids)


def _possible(percent: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, c, na, nb, x, y = (b.column(k).to_pylist() for k in range(6))
            take = pa.array([k for k in range(len(b)) if may_link(x[k], y[k], na[k], nb[k], percent)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take)], names=["a", "b"])

    return run


def _whole_sets(words: int, percent: int, sent):
    """Sets and, cut to 32 bits, their prefixes under the other orders."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy, level = sent.value
        for b in batches:
            sets = [s for _, part in _blocks(b, 1, words) for s in part]
            fronts = [[np.unique(prefix(s, o, heavy, level, percent).astype(np.uint32)).tobytes() for s in sets] for o in ORDERS[1:]]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.tobytes() for s in sets], pa.binary()), *(pa.array(f, pa.binary()) for f in fronts)],
                                             names=["iid", "tokens", *FRONTS])

    return run


def _common(x: pa.Scalar, y: pa.Scalar, kind: type) -> int:
    """How many values two sorted lists of distinct values share."""
    return len(np.intersect1d(np.frombuffer(x.as_buffer(), kind), np.frombuffer(y.as_buffer(), kind), True))


@lean
def _shared_fronts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose prefixes meet under every other order as well."""
    for b in batches:
        take = pa.array([k for k, fronts in enumerate(zip(*(b.column(q) for q in range(2, 2 + 2 * len(FRONTS))), strict=True))
                         if all(_common(fronts[q], fronts[q + len(FRONTS)], np.uint32) for q in range(len(FRONTS)))], pa.int64())
        yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take)], names=["a", "b"])


def _compared(percent: int):
    """Pairs that pass the exact comparison."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for k, (x, y) in enumerate(zip(b.column(2), b.column(3), strict=True)):
                both = _common(x, y, np.uint64)
                if 100 * both >= percent * ((len(x.as_buffer()) + len(y.as_buffer())) // 8 - both):
                    good.append(k)
            take = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take)], names=["a", "b"])

    return run


def _cell_rows(percent: int):
    """Pairs of different components in a cell that the bitmaps allow; rows come sorted by cell. Pairs that meet in
    several cells come out of one: of two sizes' steps the lower, of a block with itself the diagonal, and of
    all groups that hold both the smallest. A group is passed over if the lists of both documents' smallest groups hold
    a smaller one in common, so the smallest of all is never passed over, however long the lists are."""

    def pairs(cell: tuple, rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        ids, n, c, step, own, bits, first = zip(*rows, strict=True)
        gid, base, i, j = cell
        least = min(map(len, bits))
        x = np.zeros((len(bits), least), dtype=np.uint8)
        for k, b in enumerate(bits):
            x[k] = np.bitwise_xor.reduce(np.frombuffer(b, np.uint8).reshape(-1, least), axis=0)
        x = x.view(np.uint64)
        ids_, n_, c_, step_, own_ = (np.array(v) for v in (ids, n, c, step, own))
        lists = [frozenset(f) for f in first]
        out_a, out_b = [], []
        for k in range(len(ids) - 1):
            m = n_[k + 1 :]
            ok = (c_[k + 1 :] != c_[k]) & (np.minimum(step_[k + 1 :], step_[k]) == base) & (100 * np.minimum(m, n_[k]) >= percent * np.maximum(m, n_[k]))
            if i != j:
                ok &= own_[k + 1 :] != own_[k]
            some = np.flatnonzero(ok)
            apart = np.bitwise_count(x[k + 1 + some] ^ x[k]).sum(axis=1, dtype=np.int64)
            for q in some[apart * (100 + percent) <= (100 - percent) * (m[some] + n_[k])].tolist():
                common = lists[k] & lists[k + 1 + q]
                if not common or min(common) >= gid:
                    out_a.append(min(ids[k], ids[k + 1 + q]))
                    out_b.append(max(ids[k], ids[k + 1 + q]))
        return np.array(out_a, np.int64), np.array(out_b, np.int64)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for gid, base, i, j, *row in zip(*(batch.column(k).to_pylist() for k in range(11)), strict=True):
                if (cell := (gid, base, i, j)) != now and rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in pairs(now, rows)], names=["a", "b"])
                    rows = []
                now = cell
                rows.append(row)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in pairs(now, rows)], names=["a", "b"])

    return run


def _cells(members: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """(a, b) of all pairs of members (gid, x, n, m, c) of one group and different components that the bitmaps allow.
    A group is dealt to cells: similar sizes differ by less than one step of log(1 / t), and a large group is cut into
    blocks of about BLOCK documents, each pair of blocks meeting in one cell. Documents whose whole group is in one
    component are left out before."""
    open_ = members.groupBy("gid").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("gid")
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    cells = F.explode(F.flatten(F.transform(F.array(F.col("step"), F.col("step") - 1), lambda base: F.transform(
        F.sequence(F.lit(0), blocks - 1), lambda other: F.struct(base.alias("base"), F.least("own", other).alias("i"), F.greatest("own", other).alias("j"))))))
    sized = members.join(open_, "gid", "left_semi").withColumns({"step": step, "own": F.pmod(F.xxhash64("x"), blocks).cast("int")})
    cell = ["gid", "base", "i", "j"]
    placed = sized.select("x", "n", "c", "step", "own", "gid", cells.alias("cell")).select("x", "n", "c", "step", "own", "gid", "cell.base", "cell.i", "cell.j")
    # a cell without its own, lower step holds pairs of the step above only, which meet in a cell of theirs
    full = placed.join(placed.groupBy(*cell).agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("step").alias("least")).filter("lo < hi and least = base").select(*cell), cell, "left_semi")
    first = members.groupBy("x").agg(F.slice(F.array_sort(F.collect_set("gid")), 1, FIRST).alias("first"))  # a document's groups: as many as its prefix is long
    about = bits.join(first, "x").groupBy("x").agg(F.first("bits").alias("bits"), F.first("first").alias("first"))  # equal ids stand for equal sets
    described = full.join(about, "x").select(*cell, "x", "n", "c", "step", "own", "bits", "first")
    return described.repartition(*map(F.col, cell)).sortWithinPartitions(*cell).mapInArrow(_cell_rows(percent), "a long, b long")


def _distinct_groups(grouped: DataFrame) -> DataFrame:
    """(gid, iid) of what _group_rows gives: buckets may hold the same group, of which one stays before its members become rows."""
    cold = grouped.filter("gid >= 0").groupBy("ids").agg(F.min("gid").alias("gid"))
    return grouped.filter("gid < 0").unionByName(cold).select("gid", F.explode("ids").alias("iid"))


def _merged_groups(members: DataFrame) -> DataFrame:
    """(gid, x, n) of groups that hold every pair of members (gid, x, n) of one group: groups with the same members are
    one, and groups with the same smallest member are united, unless the union has more than twice as many pairs as all of them."""
    print_ = members.groupBy("gid").agg(F.bit_xor(F.xxhash64("x")).alias("h"), F.bit_xor(F.xxhash64("x", F.lit(1))).alias("h2"), F.count(F.lit(1)).alias("m"), F.min("x").alias("lead"))
    kept = materialise(print_.filter("m > 1").groupBy("h", "h2", "m").agg(F.min("gid").alias("gid"), F.min("lead").alias("lead")).select("gid", "lead", "m"), "kept")
    placed = materialise(members.join(kept.select("gid", "lead"), "gid"), "placed")
    apart = kept.groupBy("lead").agg(F.sum(F.col("m").cast("double") * F.col("m")).alias("pairs"), F.min("gid").alias("into"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    united = placed.select("lead", "x").distinct().groupBy("lead").agg(F.count(F.lit(1)).cast("double").alias("u"))
    into = apart.join(united, "lead").filter("u * u <= 2 * pairs").select("lead", "into")
    return placed.join(into, "lead", "left").select(F.coalesce("into", "gid").alias("gid"), "x", "n").distinct()


def _linked_ids(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """near_duplicates of rows whose ids, if they are equal, stand for equal texts."""
    rows = keyed(docs, id_col, text_col)
    spark = docs.sparkSession
    sketch = materialise(rows.select("text").mapInArrow(_heavy_rows(words), "token long, c long").groupBy("token").agg(F.sum("c").alias("c")), "sketch")
    total = sketch.filter("token is null").agg(F.sum("c")).first()[0] or 0
    heavy = sketch.filter("token is not null").orderBy(F.desc("c"), "token").limit(HEAVY_LIST).collect()  # a list of fixed length; it decides the order only
    heavy.sort(key=lambda r: r[0] % (1 << 64))
    token = np.array([r[0] for r in heavy], dtype=np.int64).view(np.uint64)
    level = np.array([min(60, r[1].bit_length()) for r in heavy], dtype=np.uint64)
    sent = spark.sparkContext.broadcast((token, level))
    buckets = max(1, total * (100 - percent) // 100 // BUCKET_TOKENS)

    sets = materialise(rows.select("iid", "text").mapInArrow(_set_rows(words, percent), "iid long, n long, sig long, sig2 long, bits binary"), "sets")
    same = ["sig", "sig2", "n"]
    node = materialise(sets.filter("n > 0").groupBy(*same).agg(F.min("iid").alias("node")), "nodes")
    of_id = sets.filter("n > 0").select("iid", *same).distinct().join(node, same).select("iid", "node", "n")
    dealt = rows.select("iid", "text").mapInArrow(_prefix_rows(words, percent, sent, buckets), "bucket long, tokens binary, ids binary").repartition(F.col("bucket")).sortWithinPartitions("bucket")
    grouped = materialise(dealt.mapInArrow(_group_rows, "gid long, ids array<long>"), "groups")
    members = materialise(_distinct_groups(grouped).join(of_id, "iid").select("gid", F.col("node").alias("x"), "n").distinct(), "members")
    shared = materialise(_merged_groups(members), "groups")
    bits = sets.filter("n > 0").select(F.col("iid").alias("x"), "n", "bits")

    def near_size(a: str, b: str):
        return F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)

    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs (a, na, b, nb) that are similar."""
        both = pairs.join(bits.select(F.col("x").alias("a"), F.col("n").alias("na"), F.col("bits").alias("s")), ["a", "na"]).join(
            bits.select(F.col("x").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("t")), ["b", "nb"])
        return compared(both.select("a", "b", "na", "nb", "s", "t").mapInArrow(_possible(percent), "a long, b long"))

    def compared(pairs: DataFrame) -> DataFrame:
        possible = materialise(pairs.distinct(), "possible")
        wanted = materialise(possible.select(F.col("a").alias("iid")).union(possible.select("b")).distinct(), "wanted")
        chosen = rows.select("iid", "text").join(small_side(wanted, SMALL), "iid", "left_semi")
        whole = materialise(chosen.mapInArrow(_whole_sets(words, percent, sent), "iid long, tokens binary, " + ", ".join(f"{f} binary" for f in FRONTS)), "whole")

        def side(name: str, columns: list[str]) -> DataFrame:
            return whole.select(F.col("iid").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in columns))

        def both(pairs: DataFrame, columns: list[str]) -> DataFrame:
            return pairs.join(side("a", columns), "a").join(side("b", columns), "b").select("a", "b", *(f"{q}_{c}" for q in "ab" for c in columns))

        filtered = materialise(both(possible, FRONTS).mapInArrow(_shared_fronts, "a long, b long"), "filtered")
        return materialise(both(filtered, ["tokens"]).mapInArrow(_compared(percent), "a long, b long"), "links")

    def star(members: DataFrame, centre: DataFrame) -> DataFrame:
        both = members.join(centre, "gid").filter((F.col("x") != F.col("lead.x")) & near_size("n", "lead.n"))
        return both.select(F.col("lead.x").alias("a"), F.col("lead.n").alias("na"), F.col("x").alias("b"), F.col("n").alias("nb")).distinct()

    centre = materialise(shared.groupBy("gid").agg(F.min(F.struct("x", "n")).alias("lead"), F.count(F.lit(1)).alias("k")).filter("k > 1"), "centres")
    links = linked(star(shared, centre))
    left = shared.join(centre, "gid").filter("k > 2").filter(F.col("x") != F.col("lead.x")).select("gid", "x", "n", F.col("k").alias("m"))
    for _ in range(STARS):
        label = components(links)
        marked = materialise(left.join(label, left.x == label.node, "left").select("gid", "x", "n", F.coalesce("component", "x").alias("c")), "marked")
        open_ = materialise(marked.groupBy("gid").agg(F.min(F.struct("x", "n", "c")).alias("lead"), F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("m")).filter("lo < hi"), "open")
        left = marked.join(open_, "gid")
        links = materialise(links.unionByName(linked(star(left.filter("c <> lead.c").select("gid", "x", "n"), open_.select("gid", "lead")))), "links")
        left = materialise(left.filter("x <> lead.x").select("gid", "x", "n", "m"), "left")
    label = components(links)
    marked = left.join(label, left.x == label.node, "left").select("gid", "x", "n", "m", F.coalesce("component", "x").alias("c"))
    links = links.unionByName(compared(_cells(marked, bits, percent)))
    label = components(links)
    of = node.join(label, "node", "left").select(*same, F.coalesce("component", "node").alias("component"))
    out = sets.select("iid", "n", "sig", "sig2").join(of, same, "left")
    back = lambda c: F.nullif(c, F.lit(MAX_ID))
    return out.select(back(F.col("iid")).alias("doc_id"), F.col("n").alias("n_shingles"), back(F.coalesce("component", "iid")).alias("component_id"))


def _row_keys(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """docs with __id, __null, __words (whether the text has any) and __key, and (__key, __id, __null, c) of every distinct pair
    of id and text that has words. __key is a 64-bit hash of both under the first seed that gives no two pairs (told apart by 128 bits) the same."""
    text, id_ = F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.col(f"`{id_col}`").cast("long")
    own = [id_.isNull(), F.coalesce(id_, F.lit(0)), text]
    seed = 0
    while True:
        marked = docs.select("*", F.coalesce(id_, F.lit(MAX_ID)).alias("__id"), id_.isNull().alias("__null"), F.rlike(text, F.lit("[^\\x09-\\x0d\\x20]")).alias("__words"),
                             F.xxhash64(F.lit(seed), *own).alias("__key"), F.xxhash64(F.lit(-1 - seed), *own).alias("__second"))
        keys = materialise(marked.filter("__words").groupBy("__key", "__id", "__null").agg(F.count(F.lit(1)).alias("c"), F.min("__second").alias("lo"), F.max("__second").alias("hi")), "keys")
        if keys.filter("lo <> hi").isEmpty() and keys.groupBy("__key").count().filter("count > 1").isEmpty():
            return marked.drop("__second"), keys.drop("lo", "hi")
        seed += 1


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id. Null or repeated ids are told apart by their texts."""
    id_ = F.col(f"`{id_col}`").cast("long")
    if docs.groupBy(id_.alias("id")).agg(F.count(F.lit(1)).alias("c")).filter("c > 1 or id is null").isEmpty():
        return _linked_ids(docs, id_col, text_col, words, percent)
    marked, keys = _row_keys(docs, id_col, text_col)
    near = _near_keys(marked, text_col, words, percent).dropDuplicates(["__key"])
    best = near.join(keys.drop("c"), "__key").groupBy("c").agg(F.min(F.struct("__null", "__id")).alias("best"))
    known = near.join(best, "c").select("__key", F.lit(True).alias("__words"), F.col("n"), "best")
    own = F.when(~F.col("__null"), F.col("__id"))
    component = F.when(F.col("best").isNull(), own).when(~F.col("best.__null"), F.col("best.__id"))
    return marked.select("__key", "__words", "__id", "__null").join(known, ["__key", "__words"], "left").select(
        own.alias("doc_id"), F.coalesce("n", F.lit(0)).alias("n_shingles"), component.alias("component_id"))


def _near_keys(marked: DataFrame, text_col: str, words: int, percent: int) -> DataFrame:
    """(__key, n, c) of the marked rows with words: c is the component's smallest key."""
    near = _linked_ids(marked.filter("__words").select("__key", F.col(f"`{text_col}`").alias("__text")), "__key", "__text", words, percent)
    full = lambda c: F.coalesce(c, F.lit(MAX_ID))
    return near.select(full("doc_id").alias("__key"), F.col("n_shingles").alias("n"), full("component_id").alias("c"))


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The document with the smallest id of each component, with all columns; documents without words stay. Rows are
    linked by their texts alone: a shared or null id links nothing. Null ids come last, equal ids are ordered
    by a hash of the row's id and text; of rows with the same id and text one stays."""
    marked, keys = _row_keys(docs, id_col, text_col)
    own = ["__id", "__null", "__words", "__key"]
    several = keys.filter("c > 1").select("__key")
    if not several.isEmpty():
        again = several.withColumn("__words", F.lit(True))
        once = marked.join(again, ["__key", "__words"], "left_semi").dropDuplicates(["__key"])
        marked = materialise(marked.join(again, ["__key", "__words"], "left_anti").unionByName(once), "once")
    linked = materialise(_near_keys(marked, text_col, words, percent).select("__key", "c").filter("__key <> c"), "linked")
    member = materialise(linked.unionByName(linked.select(F.col("c").alias("__key"), "c").distinct()), "linked")
    best = member.join(keys.drop("c"), "__key").groupBy("c").agg(F.min(F.struct("__null", "__id", "__key")).alias("best"))
    gone = member.select("__key").join(best.select(F.col("best.__key").alias("__key")), "__key", "left_anti").withColumn("__words", F.lit(True))
    return marked.join(gone, ["__key", "__words"], "left_anti").drop(*own)
