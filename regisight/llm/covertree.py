"""Vector code compression: product codes whose codebooks come from Lloyd rounds over cover trees.

Vectors become integers, floor(scale * x), and are cut into equal parts. Each chunk of rows gets one cover tree for
each part position, over the distinct parts of its rows: a node of radius r has children that lie more than half
the power of two at or above r from each other and hold what is nearer to them than that. The parts stand in tree
order with cumulative sums of their components and counts, so the sum of any subtree is a difference. Trees are built
once and stored; every round sends the codebooks to them. A node all of whose parts must be nearest to one entry, by
the triangle inequality (second distance - first distance > 2 * radius), is assigned whole; only other nodes go
on to their children, and at the leaves to exact comparisons in integers. What a task returns is a sum and a count
for each entry; new entries are floor(sum / count).

Defined results: rows whose vector is null or holds null or non-finite components are dropped. Shorter vectors end in
zeros, and so does the last part where the longest does not divide. Scaled components are cut to +-2^26. The first
codebooks are the parts of the rows with the smallest ids; equal ids go by their integers, null ids come last; there
are fewer entries if there are fewer rows. Repeated rows count, and return, each by itself. Equal labels share
their error, null labels together. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regisight.llm.common import materialise
from regisight.llm.vectors import integer_vectors, matrix
from regisight.plans.sizing import small_side

CHUNK_ROWS = 8192
LEAF = 8
SLICE = 4096
CODE_SCHEMA = "vid long, rest_0 {label}, code string, error long"


class CoverTree:
    """Trees of all positions of one chunk. parts: distinct parts in tree order, by position; cumulated: their
    components and counts, summed up from the front; nodes: (first part, end, first child, end) and radius; the
    first part of a node is its centre."""

    def __init__(self, parts: np.ndarray, cumulated: np.ndarray, nodes: np.ndarray, radius: np.ndarray, roots: np.ndarray):
        self.parts, self.cumulated, self.nodes, self.radius, self.roots = parts, cumulated, nodes, radius, roots

    @classmethod
    def build(cls, parts: np.ndarray, counts: np.ndarray, position_ends: np.ndarray) -> tuple[CoverTree, np.ndarray]:
        """Also the tree order: parts[order] stand in the tree."""
        order = np.arange(len(parts))
        lo = np.concatenate([[0], position_ends[:-1]]).astype(np.int64)
        hi = position_ends.astype(np.int64)
        generations, radii = [], []
        first_child = len(lo)
        while len(lo):
            size = hi - lo
            owner = np.repeat(np.arange(len(lo)), size)
            at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
            far = squared(parts[order[at]], parts[order[lo]][owner])
            radius2 = np.maximum.reduceat(far, np.cumsum(size) - size)
            radii.append(np.sqrt(radius2.astype(np.float64)))
            split = (size > LEAF) & (radius2 > 0)
            cover2 = np.where(split, 4.0 ** (np.ceil(np.log2(np.maximum(radii[-1], 1e-9))) - 1), 0)
            at, owner = at[split[owner]], owner[split[owner]]
            child = np.zeros(len(at), dtype=np.int64)
            open_, made = np.arange(len(at)), 0
            while len(open_):  # one new child for each node that has parts left: its first part that no sibling covers
                own = owner[open_]
                starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                picked = order[at[open_[starts]]]
                spread = np.repeat(picked, np.diff(np.concatenate([starts, [len(own)]])))
                near = squared(parts[order[at[open_]]], parts[spread]) <= cover2[own]
                child[open_[near]] = made
                made += 1
                open_ = open_[~near]
            by_child = np.lexsort((child, owner))
            order[at] = order[at[by_child]]
            owner, child = owner[by_child], child[by_child]
            starts = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (child[1:] != child[:-1])])) if len(at) else np.zeros(0, np.int64)
            n_children = np.bincount(owner[starts], minlength=len(lo)) if len(at) else np.zeros(len(lo), np.int64)
            end = first_child + np.cumsum(n_children)
            generations.append(np.stack([lo, hi, end - n_children, end], axis=1))
            first_child += len(starts)
            lo, hi = at[starts], at[np.concatenate([starts[1:], [len(at)]])[: len(starts)] - 1] + 1
        nodes = np.concatenate(generations) if generations else np.zeros((0, 4), np.int64)
        sums = np.concatenate([parts[order].astype(np.int64) * counts[order, None], counts[order, None]], axis=1)
        cumulated = np.concatenate([np.zeros((1, sums.shape[1]), np.int64), np.cumsum(sums, axis=0)])
        return cls(parts[order], cumulated, nodes, np.concatenate(radii) if radii else np.zeros(0), np.arange(len(position_ends))), order

    def assign(self, codebooks: np.ndarray) -> tuple[np.ndarray, int]:
        """Entry of every part under codebooks (position, entry, component), and how many were compared exactly."""
        entry = np.zeros(len(self.parts), dtype=np.int64)
        exact = 0
        for position in range(len(codebooks)):
            book = codebooks[position]
            frontier = self.roots[position : position + 1]
            while len(frontier):
                left = []
                for a in range(0, len(frontier), SLICE):
                    some = frontier[a : a + SLICE]
                    lo, hi, first, end = self.nodes[some].T
                    distance = np.sqrt(distances(self.parts[lo], book).astype(np.float64))
                    best = distance.argmin(axis=1)
                    if len(book) > 1:
                        two = np.partition(distance, 1, axis=1)[:, :2]
                        whole = two[:, 1] - two[:, 0] > 2 * self.radius[some] + 1e-6 * (1 + two[:, 1])
                    else:
                        whole = np.ones(len(some), dtype=bool)
                    entry[ranges(lo[whole], hi[whole])] = np.repeat(best[whole], (hi - lo)[whole])
                    leaf = ~whole & (first == end)
                    inside = ranges(lo[leaf], hi[leaf])
                    for b in range(0, len(inside), SLICE):
                        entry[inside[b : b + SLICE]] = distances(self.parts[inside[b : b + SLICE]], book).argmin(axis=1)
                    exact += len(inside)
                    down = ~whole & (first != end)
                    left.append(ranges(first[down], end[down]))
                frontier = np.concatenate(left)
        return entry, exact

    def sums(self, entry: np.ndarray, entries: int) -> np.ndarray:
        """(position, entry, components and count): differences of the cumulative sums over runs of one entry."""
        lo, hi = self.nodes[self.roots, 0], self.nodes[self.roots, 1]
        position = np.repeat(np.arange(len(lo)), hi - lo)
        out = np.zeros((len(lo), entries, self.cumulated.shape[1]), dtype=np.int64)
        if len(entry):
            starts = np.flatnonzero(np.concatenate([[True], (entry[1:] != entry[:-1]) | (position[1:] != position[:-1])]))
            ends = np.concatenate([starts[1:], [len(entry)]])
            np.add.at(out, (position[starts], entry[starts]), self.cumulated[ends] - self.cumulated[starts])
        return out


def ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    size = hi - lo
    return np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a.astype(np.int64) - b
    return (d * d).sum(axis=1)


def distances(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances, exact: as doubles while all products fit them, as 64-bit integers beyond."""
    reach = max(int(np.abs(points).max(initial=0)), int(np.abs(book).max(initial=0)))
    kind = np.float64 if 4 * points.shape[1] * reach * reach < 1 << 53 else np.int64
    p, c = points.astype(kind), book.astype(kind)
    return (p * p).sum(axis=1)[:, None] - 2 * (p @ c.T) + (c * c).sum(axis=1)[None, :]


def _planted(rows: DataFrame, parts: int, width: int, chunk_rows: int, label: str) -> DataFrame:
    """One row for each chunk: ids and labels of its rows, the place of their parts in the trees, and the trees."""

    def grow(vectors: np.ndarray) -> tuple[bytes, ...]:
        flat = vectors.reshape(len(vectors), parts, width)
        distinct, counts, place = [], [], np.zeros((len(vectors), parts), dtype=np.int64)
        for p in range(parts):
            d, inverse, c = np.unique(flat[:, p], axis=0, return_inverse=True, return_counts=True)
            place[:, p] = inverse.ravel() + sum(map(len, distinct))
            distinct.append(d)
            counts.append(c)
        tree, order = CoverTree.build(np.concatenate(distinct), np.concatenate(counts), np.cumsum([len(d) for d in distinct]))
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return (back[place].astype(np.int32).tobytes(), tree.parts.astype(np.int32).tobytes(), tree.cumulated.tobytes(),
                np.concatenate([tree.nodes.astype(np.float64), tree.radius[:, None]], axis=1).tobytes(), tree.roots.tobytes())

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in _and_end(batches):
            if b is not None:
                held.append(b)
            while held and (sum(map(len, held)) >= chunk_rows or b is None):
                t = pa.Table.from_batches(held)
                now, rest = t.slice(0, chunk_rows), t.slice(chunk_rows)
                held = rest.to_batches() if len(rest) else []
                grown = grow(matrix(now.column("v"), parts * width))
                labels = now.column("rest_0").combine_chunks()
                yield pa.RecordBatch.from_arrays([pa.array([now.column("vid").to_pylist()], pa.list_(pa.int64())), pa.ListArray.from_arrays(pa.array([0, len(labels)], pa.int32()), labels),
                                                  *(pa.array([x], pa.binary()) for x in grown)], names=["ids", "labels", "place", "parts", "cumulated", "nodes", "roots"])

    return rows.select("vid", "v", "rest_0").mapInArrow(plant, f"ids array<long>, labels array<{label}>, place binary, parts binary, cumulated binary, nodes binary, roots binary")


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _tree(b: pa.RecordBatch, r: int, width: int) -> CoverTree:
    get = lambda name, kind: np.frombuffer(b.column(name)[r].as_py(), dtype=kind)
    nodes = get("nodes", np.float64).reshape(-1, 5)
    return CoverTree(get("parts", np.int32).reshape(-1, width), get("cumulated", np.int64).reshape(-1, width + 1), nodes[:, :4].astype(np.int64), nodes[:, 4], get("roots", np.int64))


def _moved(trees: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each task sums its trees, Spark adds the tasks' sums up."""
    parts, entries, width = codebooks.shape

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width + 1), dtype=np.int64)
        for b in batches:
            for r in range(len(b)):
                tree = _tree(b, r, width)
                sums += tree.sums(tree.assign(codebooks)[0], entries)
        cell = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(sums.ravel()[cell], pa.int64())], names=["cell", "amount"])

    sums = np.zeros(parts * entries * (width + 1), dtype=np.int64)
    for r in trees.mapInArrow(total, "cell long, amount long").groupBy("cell").agg(F.sum("amount").alias("amount")).collect():  # as many rows as the codebooks have numbers
        sums[r["cell"]] = r["amount"]
    sums = sums.reshape(parts, entries, width + 1)
    used = sums[:, :, -1:]
    return np.where(used > 0, sums[:, :, :-1] // np.maximum(used, 1), codebooks)


def _coded(trees: DataFrame, codebooks: np.ndarray, label: str) -> DataFrame:
    parts, _, width = codebooks.shape

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(len(b)):
                tree = _tree(b, r, width)
                entry, _ = tree.assign(codebooks)
                place = np.frombuffer(b.column("place")[r].as_py(), dtype=np.int32).reshape(-1, parts)
                codes = entry[place]
                error = np.zeros(len(place), dtype=np.int64)
                for p in range(parts):
                    error += squared(tree.parts[place[:, p]], codebooks[p][codes[:, p]])
                text = codes.astype(np.uint8).tobytes().hex()
                step = 2 * parts
                yield pa.RecordBatch.from_arrays([b.column("ids").slice(r, 1).flatten(), b.column("labels").slice(r, 1).flatten(),
                                                  pa.array([text[i : i + step] for i in range(0, len(text), step)], pa.string()), pa.array(error, pa.int64())],
                                                 names=["vid", "rest_0", "code", "error"])

    return trees.mapInArrow(code, CODE_SCHEMA.format(label=label))


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256, parts: int = 16,
             entries: int = 64, rounds: int = 2, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, code, error, label_error), codebooks as (part, entry, component)); at most 256 entries."""
    if not 0 < entries <= 256:
        raise ValueError("a code of two hex digits has 1 to 256 entries")
    label = vectors.schema[label_col].dataType.simpleString()
    kept = materialise(integer_vectors(vectors, scale, id_col, vector_col, label_col), "vectors")
    n, dim = kept.agg(F.count("*"), F.max(F.size("v"))).first()
    width = max(1, -(-(dim or 0) // parts))
    start = kept.orderBy(F.col("vid").asc_nulls_last(), "v").limit(entries).select("v").collect()  # at most 256 rows
    codebooks = np.zeros((parts, len(start), width), dtype=np.int64)
    for e, r in enumerate(start):
        codebooks[:, e] = np.array(r["v"] + [0] * (parts * width - len(r["v"]))).reshape(parts, width)
    trees = materialise(_planted(kept.repartition(max(1, -(-n // chunk_rows))), parts, width, chunk_rows, label), "cover-trees")
    for _ in range(rounds if start else 0):
        codebooks = _moved(trees, codebooks)
    coded = materialise(_coded(trees, codebooks, label), "codes")
    by_label = coded.groupBy(F.col("rest_0").alias("label")).agg(F.sum("error").alias("label_error"))
    out = coded.withColumnRenamed("rest_0", "label").alias("c").join(small_side(by_label).alias("l"), F.col("c.label").eqNullSafe(F.col("l.label")), "left")
    return out.select(F.col("c.vid").alias("vec_id"), F.col("c.label").alias("label"), "code", "error", "label_error"), codebooks


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
