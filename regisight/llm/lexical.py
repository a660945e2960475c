"""Ranked lexical search with hashed max-sketches.

Each document is folded once into a sketch: its distinct terms are hashed to coordinates, and a coordinate keeps the
largest count of the terms that meet there. A term's impact on a document grows with its count, so the impact at a
coordinate is an upper bound for all its terms. The sketch has 1024 to 2048 coordinates for each distinct
term (2^22 at most; beyond that coordinates are shared more often, which loosens bounds but never results) and stores
only those that are not zero. With 16 to 32, rare terms met others so often that 72 % of all pairs of item and
document had to be scored exactly.

A block of queries looks all its terms up in every sketch at once; the sum of weight times bound is an upper bound of
a document's score. The documents with the highest bounds of all are scored exactly first, from their texts; the k-th
of these scores is each query's threshold, and what is then scored exactly is every document whose bound reaches it.
No document that is left out can enter the result.

Queries go in blocks of at most about ITEMS_PER_BLOCK, each sent to the tasks by itself. What waves of candidates hold
is kept as tables and joined to the documents by id and text hash.

Defined results: null and empty texts have no terms; a document without terms is not counted and never found, an item
without terms finds nothing. Repeated documents count, and are found, each by itself; equal scores go by ascending id,
null ids last (a null id stands for the largest long), then by text hash. Rows of items that are equal in id and text are one item; items that share an id are
ranked apart. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regisight.llm.common import MAX_ID, keyed, materialise, texts
from regisight.llm.decontaminate import words_of as terms_of
from regisight.plans.sizing import small_side

K = 20
ITEMS_PER_BLOCK = 512
WAVE = 64
SPREAD, MAX_BITS = 10, 22
MANY = 255
ROWS = 512

#: Fixed values of the score.
IMPACT, PER_COUNT, PER_LENGTH, BASE, SHARE, SCALE = 1_000_000_000, 1000, 12, 75, 25, 1000


def weight(n_docs: int, df: int) -> int:
    return math.floor(SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impact(tf, m):
    """Integers, or arrays of them."""
    return (IMPACT * tf) // (PER_COUNT * tf + PER_LENGTH * m)


def hashed(term: bytes) -> int:
    return zlib.crc32(term)


def bits_for(distinct: int) -> int:
    return min(MAX_BITS, max(1, distinct - 1).bit_length() + SPREAD)


def folded(counts: list[Counter]) -> list[tuple[int, bytes, bytes]]:
    """(bits, coordinates as 32-bit integers, counts as bytes, 255 standing for all larger ones) of each document."""
    size = np.array([len(c) for c in counts], dtype=np.int64)
    bits = np.array([bits_for(int(s)) for s in size], dtype=np.int64)
    h = np.fromiter((hashed(t) for c in counts for t in c), dtype=np.int64, count=int(size.sum()))
    tf = np.fromiter((n for c in counts for n in c.values()), dtype=np.int64, count=len(h))
    doc = np.repeat(np.arange(len(counts)), size)
    place = (doc << 32) | (h >> (32 - bits[doc]))
    order = np.argsort(place, kind="stable")
    place, tf = place[order], np.minimum(tf[order], MANY)
    starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else np.zeros(0, np.int64)
    most = np.maximum.reduceat(tf, starts).astype(np.uint8) if len(place) else np.zeros(0, np.uint8)
    place = place[starts]
    cut = np.searchsorted(place >> 32, np.arange(len(counts) + 1))
    coordinate = (place & 0xFFFFFFFF).astype(np.uint32)
    return [(int(bits[d]), coordinate[a:b].tobytes(), most[a:b].tobytes()) for d, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True))]


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index: (iid, tkey, n, bits, coordinates, counts) of every document with terms."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, len(b), ROWS):
                some = b.slice(a, ROWS)
                counts = [Counter(terms_of(t)) for t in texts(some.column("text"))]
                full = [i for i, c in enumerate(counts) if c]
                made = folded([counts[i] for i in full])
                keep = pa.array(full, pa.int32())
                yield pa.RecordBatch.from_arrays([some.column("iid").take(keep), some.column("tkey").take(keep), pa.array([sum(counts[i].values()) for i in full], pa.int64()),
                                                  pa.array([x[0] for x in made], pa.int32()), pa.array([x[1] for x in made], pa.binary()), pa.array([x[2] for x in made], pa.binary())],
                                                 names=["iid", "tkey", "n", "bits", "coordinates", "counts"])

    return keyed(docs, id_col, text_col).select("iid", "tkey", "text").mapInArrow(fold, "iid long, tkey long, n long, bits int, coordinates binary, counts binary")


def document_frequencies(docs: DataFrame, vocabulary: set[bytes], text_col: str = "text") -> dict[bytes, int]:
    """How many documents hold each term of a bounded vocabulary; every task counts before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter = Counter()
        for b in batches:
            for t in texts(b.column(0)):
                df.update(vocabulary.intersection(terms_of(t)))
        yield pa.RecordBatch.from_arrays([pa.array(list(df), pa.binary()), pa.array(list(df.values()), pa.int64())], names=["term", "df"])

    counted = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(count, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {bytes(r["term"]): r["df"] for r in counted.collect()}  # as many rows as the vocabulary at most


class Queries:
    """The weighted terms of a block of items, and the corpus statistics that scores need."""

    def __init__(self, items: list[Counter], df: dict[bytes, int], n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, max(1, n_terms)
        self.terms = sorted({t for c in items for t in c if df.get(t)})
        number = {t: i for i, t in enumerate(self.terms)}
        w = {t: weight(n_docs, df[t]) for t in self.terms}
        self.items = [[(t, w[t] * n) for t, n in c.items() if t in number] for c in items]
        pairs = sorted((number[t], i, x) for i, c in enumerate(self.items) for t, x in c)
        self.item = np.array([p[1] for p in pairs], dtype=np.int64)
        self.share = np.array([p[2] for p in pairs], dtype=np.float64)
        self.term_start = np.searchsorted([p[0] for p in pairs], np.arange(len(self.terms) + 1))
        self.hash = np.array([hashed(t) for t in self.terms], dtype=np.int64)
        self.lookups: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def length_part(self, n):
        return BASE + (SHARE * n * self.n_docs) // self.n_terms

    def lookup(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(start of each coordinate's terms, terms by coordinate) for sketches of 2^bits coordinates."""
        if bits not in self.lookups:
            at = self.hash >> (32 - bits)
            start = np.zeros((1 << bits) + 1, dtype=np.int32)
            np.cumsum(np.bincount(at, minlength=1 << bits), out=start[1:])
            self.lookups[bits] = start, np.argsort(at, kind="stable")
        return self.lookups[bits]

    def bounds(self, n: np.ndarray, bits: np.ndarray, coordinates: list[bytes], counts: list[bytes]) -> np.ndarray:
        """(document, item): upper bounds of all scores."""
        out = np.zeros((len(n), len(self.items)))
        m = self.length_part(n)
        for b in np.unique(bits).tolist():
            of = np.flatnonzero(bits == b)
            start, by_coordinate = self.lookup(b)
            at = np.frombuffer(b"".join(coordinates[i] for i in of), dtype=np.uint32).astype(np.int64)
            tf = np.frombuffer(b"".join(counts[i] for i in of), dtype=np.uint8).astype(np.int64)
            doc = np.repeat(of, [len(counts[i]) for i in of])
            first, many = start[at], start[at + 1] - start[at]
            held = np.flatnonzero(many)
            doc, tf, first, many = doc[held], tf[held], first[held], many[held]
            bound = np.where(tf < MANY, impact(tf, m[doc]), IMPACT // PER_COUNT)
            term = by_coordinate[_spread(first, many)]
            doc, bound = np.repeat(doc, many), np.repeat(bound, many)
            first, many = self.term_start[term], np.diff(self.term_start)[term]
            use = _spread(first, many)
            cell = np.repeat(doc, many) * len(self.items) + self.item[use]
            out.ravel()[:] += np.bincount(cell, weights=self.share[use] * np.repeat(bound, many), minlength=out.size)
        return out

    def score(self, item: int, counts: dict[bytes, int], m: int) -> int:
        return sum(x * impact(counts[t], m) for t, x in self.items[item] if t in counts)


def _spread(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    return np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())


_PAIRS = pa.schema([("item", pa.int32()), ("iid", pa.int64()), ("tkey", pa.int64()), ("bound", pa.int64())])
_PAIRS_SQL = "item int, iid long, tkey long, bound long"


def _bounded(b: pa.RecordBatch, queries: Queries) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for a in range(0, len(b), ROWS):
        some = b.slice(a, ROWS)
        column = {name: some.column(name) for name in some.schema.names}
        yield (column["iid"].to_numpy(), column["tkey"].to_numpy(),
               queries.bounds(column["n"].to_numpy(), column["bits"].to_numpy(), column["coordinates"].to_pylist(), column["counts"].to_pylist()))


def _pairs(item: np.ndarray, iid: np.ndarray, tkey: np.ndarray, bound: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((item.astype(np.int32), iid, tkey, bound.astype(np.int64)), _PAIRS, strict=True)], schema=_PAIRS)


def highest_bounds(index: DataFrame, queries: Queries, k: int, wave: int) -> DataFrame:
    """(item, iid, tkey) of the `wave` highest of the bounds that are among the k highest of their task."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bound = np.zeros((0, len(queries.items)))
        iid, tkey = (np.zeros((0, len(queries.items)), np.int64) for _ in range(2))
        for b in batches:
            for i, t, new in _bounded(b, queries):
                bound = np.concatenate([bound, new])
                iid = np.concatenate([iid, np.repeat(i[:, None], new.shape[1], 1)])
                tkey = np.concatenate([tkey, np.repeat(t[:, None], new.shape[1], 1)])
                if len(bound) > k:
                    keep = np.argpartition(-bound, k - 1, axis=0)[:k]
                    bound, iid, tkey = (np.take_along_axis(x, keep, 0) for x in (bound, iid, tkey))
        row, item = np.nonzero(bound)
        yield _pairs(item, iid[row, item], tkey[row, item], bound[row, item])

    each = index.mapInArrow(best, _PAIRS_SQL)
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.col("bound").desc(), "iid", "tkey"))
    return each.withColumn("place", place).filter(F.col("place") <= wave).select("item", "iid", "tkey")


def reaching(index: DataFrame, queries: Queries, thresholds: list[int]) -> DataFrame:
    """(item, iid, tkey) of all bounds that reach the item's threshold."""
    least = np.maximum(np.array(thresholds, dtype=np.float64), 1)

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t, bound in _bounded(b, queries):
                row, item = np.nonzero(bound >= least)
                yield _pairs(item, i[row], t[row], bound[row, item])

    return index.mapInArrow(reach, _PAIRS_SQL).select("item", "iid", "tkey")


def exact(documents: DataFrame, candidates: DataFrame, queries: Queries, k: int) -> DataFrame:
    """(item, iid, tkey, score, place): the k best of the candidates of each item, scored from the whole texts."""
    wanted = candidates.groupBy("iid", "tkey").agg(F.collect_set("item").alias("items"))  # an item block bounds the set

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, int, int]]] = {}
        known = {t for c in queries.items for t, _ in c}
        for b in batches:
            for iid, tkey, text, items in zip(b.column("iid").to_pylist(), b.column("tkey").to_pylist(), texts(b.column("text")), b.column("items").to_pylist(), strict=True):
                words = terms_of(text)
                m = queries.length_part(len(words))
                counts = Counter(w for w in words if w in known)
                for i in items:
                    row = (queries.score(i, counts, m), -iid, -tkey)
                    heap = best.setdefault(i, [])
                    if row[0] > 0:
                        (heapq.heappush if len(heap) < k else heapq.heappushpop)(heap, row)
        out = [(i, -a, -t, s) for i, heap in best.items() for s, a, t in heap]
        yield _pairs(*(np.array([r[j] for r in out], dtype=np.int64) for j in range(4)))

    scored = documents.join(small_side(materialise(wanted, "candidates")), ["iid", "tkey"]).select("iid", "tkey", "text", "items").mapInArrow(score, _PAIRS_SQL)
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.col("bound").desc(), "iid", "tkey"))
    return scored.withColumn("place", place).filter(F.col("place") <= k).withColumnRenamed("bound", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
           index: DataFrame | None = None, items_per_block: int = ITEMS_PER_BLOCK, wave: int = WAVE) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k best documents of every item. `index` takes sketches stored before."""
    spark = docs.sparkSession
    documents = keyed(docs, id_col, text_col)
    index = materialise(sketches(docs, id_col, text_col), "sketches") if index is None else index
    n_docs, n_terms = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    asked = materialise(items.select(F.col(f"`{item_col}`").alias("item_id"), F.coalesce(F.col(f"`{item_text_col}`").cast("string"), F.lit("")).alias("text")).distinct(), "items")
    blocks = max(1, -(-asked.count() // items_per_block))
    results = None
    for block in range(blocks):
        chosen = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()  # about items_per_block rows
        counts = [Counter(terms_of(r["text"])) for r in chosen]
        queries = Queries(counts, document_frequencies(docs, {t for c in counts for t in c}, text_col), n_docs, n_terms)
        first = exact(documents, highest_bounds(index, queries, k, wave), queries, k)
        threshold = [1] * len(chosen)
        for r in first.filter(F.col("place") == k).select("item", "score").collect():
            threshold[r["item"]] = r["score"]
        final = exact(documents, reaching(index, queries, threshold), queries, k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(chosen)], f"item int, item_id {asked.schema['item_id'].dataType.simpleString()}")
        doc_id = F.when(F.col("iid") != MAX_ID, F.col("iid")).alias("doc_id")
        part = materialise(final.join(small_side(names), "item").select("item_id", F.col("place").cast("int").alias("rank"), doc_id, "score"), "ranked")
        results = part if results is None else results.unionByName(part)
    return results
