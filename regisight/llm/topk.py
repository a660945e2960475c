"""Exact top-k search by inner product over a bit-sliced index.

Vectors become integers, floor(scale * x). A block of at most about BLOCK_ROWS rows is stored as bitmaps over its
rows: for each attribute, the slices of (value - smallest value of the block). The score of all rows of a block
for one query is a sum of slices: each signed binary digit of the query's components adds the attribute's slices,
shifted (a negative digit adds their complements), and full adders on whole bitmaps reduce the slices of one weight
to one, carries going to the next weight. The k best rows are then chosen from the most significant slice of the
sum downward: rows are certain, tied or out. What is tied after the last slice has equal scores, and the smaller
ids of it are taken. All of it is integer arithmetic, so scores and boundaries are exact.

Queries go in groups of about QUERY_GROUP against every block; each task keeps the k best of a query over the
pairs of group and block it gets, and a ranking over these rows ends the search. Blocks and groups are dealt by a
hash of id and vector, so neither grows with a common id, vector or source.

Defined results: rows whose vector is null or holds null or non-finite components take no part. Shorter vectors
end in zeros, an empty one has only zeros. Scaled components are cut to +-2^26. Rows with the same id and the same
integers are one row; rows that share an id with other integers stay candidates of each other. A row with a null
id is never a query chosen by id, and comes after all other ids in ties. Ranks of equal scores go by id, then by the
integers. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regisight.llm.common import materialise
from regisight.llm.vectors import integer_vectors, matrix

BLOCK_ROWS = 16384
QUERY_GROUP = 256
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)

_INDEX = pa.schema([("block", pa.int32()), ("ids", pa.list_(pa.int64())), ("n_rows", pa.int32()), ("low", pa.list_(pa.int32())), ("width", pa.list_(pa.int32())), ("slices", pa.binary())])
_FOUND = pa.schema([("query_id", pa.int64()), ("query_key", pa.int64()), ("vec_id", pa.int64()), ("vec_key", pa.int64()), ("score", pa.int64())])


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bitmaps, smallest value, number of slices) of the columns of a matrix; bit r of a bitmap is row r, and the
    slices of one attribute stand one after another, least significant first."""
    low = values.min(axis=0, initial=np.iinfo(np.int32).max).astype(np.int64)
    above = values.astype(np.int64) - low
    width = np.array([int(x).bit_length() for x in above.max(axis=0, initial=0)], dtype=np.int32)
    words = -(-max(1, len(values)) // 64)
    out = np.zeros((int(width.sum()), words), dtype=np.uint64)
    at = 0
    for column, w in zip(above.T, width.tolist(), strict=True):
        bits = np.zeros((w, words * 64), dtype=np.uint8)
        bits[:, : len(values)] = (column >> np.arange(w)[:, None]) & 1
        out[at : at + w] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
        at += w
    return out, low, width


@lru_cache(maxsize=1 << 16)
def digits(value: int) -> list[tuple[int, int]]:
    """(power, 1 or -1): the non-adjacent form, which has the fewest digits that are not 0."""
    out, power = [], 0
    while value:
        if value & 1:
            d = 2 - (value & 3)
            out.append((power, d))
            value -= d
        value >>= 1
        power += 1
    return out


def added(columns: list[list[np.ndarray]]) -> np.ndarray:
    """The slices of the sum, least significant first; columns[c] holds matrices of bitmaps of weight 2^c."""
    out, c = [], 0
    while c < len(columns):
        a = np.concatenate(columns[c]) if columns[c] else None
        carries = []
        while a is not None and len(a) > 1:
            if len(a) == 2:
                carries.append(a[:1] & a[1:])
                a = a[:1] ^ a[1:]
                break
            t = len(a) // 3
            x, y, z = a[:t], a[t : 2 * t], a[2 * t : 3 * t]
            half = x ^ y
            carries.append((x & y) | (half & z))
            half ^= z
            a = np.concatenate([half, a[3 * t :]]) if 3 * t < len(a) else half
        if carries:
            if c + 1 == len(columns):
                columns.append([])
            columns[c + 1].extend(carries)
        out.append(a[0] if a is not None else None)
        c += 1
    words = next((x.shape[-1] for x in out if x is not None), 1)
    return np.stack([x if x is not None else np.zeros(words, np.uint64) for x in out]) if out else np.zeros((0, words), np.uint64)


def count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_rows(total: np.ndarray, alive: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest sums among the rows alive (all, if fewer); equal sums go by position."""
    certain, tied = np.zeros_like(alive), alive
    have = 0
    for s in total[::-1]:
        with_bit = tied & s
        more = have + count(with_bit)
        if more > k:
            tied = with_bit
        else:
            certain, have = certain | with_bit, more
            if more == k:
                return positions(certain)
            tied = tied & ~s
    return np.concatenate([positions(certain), positions(tied)[: k - have]])


class Block:
    """Bitmaps of one block, with their complements, and the rows' ids in ascending order."""

    def __init__(self, ids: list[int | None], n_rows: int, low: np.ndarray, width: np.ndarray, slices: bytes):
        self.ids, self.n, self.low = ids, n_rows, low.astype(np.int64)
        words = -(-max(1, n_rows) // 64)
        plain = np.frombuffer(slices, dtype=np.uint64).reshape(-1, words)
        self.both = np.concatenate([plain, ~plain])
        self.plain, self.width = len(plain), width
        self.start = np.concatenate([[0], np.cumsum(width)]).astype(np.int64)
        self.alive = np.packbits(np.arange(words * 64) < n_rows, bitorder="little").view(np.uint64)

    def values(self, rows: np.ndarray) -> np.ndarray:
        """The integers of some rows, read back from their slices."""
        bit = (self.both[: self.plain][:, rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)
        out = np.repeat(self.low[None, :], len(rows), axis=0)
        for i, w in enumerate(self.width.tolist()):
            for b in range(w):
                out[:, i] += bit[self.start[i] + b].astype(np.int64) << b
        return out

    def sums(self, query: list[int]) -> tuple[np.ndarray, int]:
        """Slices of (score + constant) over all rows, and the constant."""
        constant = -sum(q * low for q, low in zip(query, self.low.tolist(), strict=True))
        terms = [(i, power, sign) for i, q in enumerate(query) if self.width[i] for power, sign in digits(q)]
        if not terms:
            return np.zeros((0, self.both.shape[1]), np.uint64), constant
        attribute, power, sign = np.array(terms, dtype=np.int64).T
        width = self.width[attribute].astype(np.int64)
        constant += sum(((1 << w) - 1) << p for w, p, s in zip(width.tolist(), power.tolist(), sign.tolist(), strict=True) if s < 0)
        bit = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        pick = np.repeat(self.start[attribute] + np.where(sign < 0, self.plain, 0), width) + bit
        weight = np.repeat(power, width) + bit
        order = np.argsort(weight, kind="stable")
        cuts = np.searchsorted(weight[order], np.arange(weight.max() + 2))
        columns = [[self.both[pick[order[a:b]]]] if b > a else [] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return added(columns), constant

    def best(self, query: list[int], own: int | None, k: int) -> list[tuple[int, int]]:
        """(position, score) of the k best rows, `own` left out."""
        alive = self.alive
        if own is not None:
            alive = alive.copy()
            alive[own >> 6] &= ~(np.uint64(1) << np.uint64(own & 63))
        total, constant = self.sums(query)
        if not len(total):
            return [(int(r), -constant) for r in positions(alive)[:k]]
        rows = top_rows(total, alive, k)
        bits = (total[:, rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)
        weights = [1 << c for c in range(len(total))]
        return [(int(r), sum(w for w, b in zip(weights, column, strict=True) if b) - constant) for r, column in zip(rows, bits.T.tolist(), strict=True)]


def bit_sliced(vectors: DataFrame, dim: int, blocks: int) -> DataFrame:
    """One row for each block of (vid, v, vkey): ids and keys in order, and the slices of all attributes."""

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by([("nid", "ascending"), ("vid", "ascending"), ("vkey", "ascending")])
        slices, low, width = slices_of(matrix(t.column("v"), dim))
        ids = [x for pair in zip(t.column("vid").to_pylist(), t.column("vkey").to_pylist(), strict=True) for x in pair]
        return pa.Table.from_arrays([pa.array([x], type=f.type) for x, f in zip((t.column("block")[0].as_py(), ids, t.num_rows, low.astype(np.int32), width, slices.tobytes()), _INDEX, strict=True)], schema=_INDEX)

    dealt = vectors.withColumn("block", F.pmod("deal", F.lit(blocks)).cast("int")).withColumn("nid", F.col("vid").isNull().cast("int"))
    return dealt.groupBy("block").applyInArrow(pack, "block int, ids array<long>, n_rows int, low array<int>, width array<int>, slices binary")


def _search(pairs: DataFrame, dim: int, k: int) -> DataFrame:
    """pairs: (queries array<struct<vid, vkey, v>>, index block); the k best of every query within each task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, list[tuple]] = {}
        for b in batches:
            for r in range(len(b)):
                one = b.slice(r, 1)
                ids = one.column("ids")[0].as_py()
                block = Block(ids[::2], one.column("n_rows")[0].as_py(), np.array(one.column("low")[0].as_py()), np.array(one.column("width")[0].as_py()), one.column("slices")[0].as_py())
                place = {p: i for i, p in enumerate(zip(ids[::2], ids[1::2], strict=True))}
                for q in one.column("queries")[0].as_py():
                    key = q["vid"], q["vkey"]
                    found = [(-s, ids[2 * p] is None, ids[2 * p] or 0, ids[2 * p + 1]) for p, s in block.best(q["v"] + [0] * (dim - len(q["v"])), place.get(key), k)]
                    best[key] = sorted(best.get(key, []) + found)[:k]
        out = [(*key, None if null else i, vkey, -s) for key, rows in best.items() for s, null, i, vkey in rows]
        for at in range(0, len(out), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out[at : at + 10_000], strict=True), _FOUND, strict=True)], schema=_FOUND)

    return pairs.mapInArrow(search, "query_id long, query_key long, vec_id long, vec_key long, score long")


def top_inner_products(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding",
                       block_rows: int = BLOCK_ROWS, query_group: int = QUERY_GROUP) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k rows with the highest inner product for each row that `is_query`, an
    expression over `vid`, chooses."""
    ints = integer_vectors(vectors, scale, id_col, vector_col)
    known = materialise(ints.distinct().withColumn("vkey", F.xxhash64("v")).withColumn("deal", F.xxhash64("vid", "v", F.lit(7))), "vectors")
    chosen = F.coalesce(is_query, F.lit(False))
    n, n_queries, dim = known.agg(F.count("*"), F.count_if(chosen), F.max(F.size("v"))).first()
    blocks, groups = max(1, -(-n // block_rows)), max(1, -(-n_queries // query_group))
    index = materialise(bit_sliced(known, dim or 0, blocks), "bit-sliced")
    queries = known.filter(chosen).withColumn("grp", F.pmod("deal", F.lit(groups)).cast("int")).groupBy("grp").agg(F.collect_list(F.struct("vid", "vkey", "v")).alias("queries"))
    grid = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(index.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))), ["grp", "block"])
    found = _search(grid.repartition(min(blocks * groups, 10_000), "grp", "block"), dim or 0, k)
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("vec_key")]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
