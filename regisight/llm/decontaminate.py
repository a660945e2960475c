"""Benchmark decontamination by Wu-Manber multi-pattern search.

A text is normalised to its words (A-Z lower-cased, runs of [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]) with one space
before, between and after them, so an occurrence of " w1 .. wk " is an occurrence of the words. The patterns
are the distinct 10-word windows of all items. For each length class of patterns a shift table over blocks of
bytes gives how far a search position may move; where the shift is 0, the bucket of the block's hash lists the
patterns to compare directly. All segments of a batch advance together in numpy; long texts are cut into
overlapping segments, so one text of any length is searched whole.

The pattern set is searched in blocks of at most PATTERNS_PER_BLOCK patterns, each sent to the tasks by
itself: what is broadcast at once has a bound, whatever the size of the benchmark.

Defined results: a null or empty text has no words and no hits, an item without words has no window and never
occurs, equal windows of several items count for each of them, repeated rows are judged each by itself, an
empty documents or benchmark table gives an empty table or no hits. Null item ids take part in hits but are
left out of the list of items. Other columns are ignored, except by drop_contaminated, which keeps them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regisight.llm.common import lean, materialise, texts

WINDOW = 10
PATTERNS_PER_BLOCK = 100_000
SEGMENT = 4096
TABLE_BITS = 20

#: Bytes that are not part of a word become spaces, A-Z become a-z.
WORD_BYTES = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def normalised(text: str) -> bytes:
    return b" " + b" ".join(w) + b" " if (w := words_of(text)) else b""


def windows(text: str, width: int = WINDOW) -> set[bytes]:
    w = words_of(text)
    return {b" " + b" ".join(w[i : i + width]) + b" " for i in range(max(1, len(w) - width + 1))} if w else set()


class WuManber:
    """Shift and bucket tables of patterns of similar length: blocks of `block` bytes (8 at most) within the
    first m bytes of each pattern, m being the shortest pattern's length."""

    def __init__(self, patterns: list[bytes]):
        self.m = min(map(len, patterns))
        self.block = min(8, max(2, self.m // 3))
        self.mask = np.uint64((1 << (8 * self.block)) - 1)
        self.shift = np.full(1 << TABLE_BITS, self.m - self.block + 1, dtype=np.int32)
        heads = np.zeros((len(patterns), self.m + 8), dtype=np.uint8)
        for k, p in enumerate(patterns):
            heads[k, : self.m] = np.frombuffer(p[: self.m], dtype=np.uint8)
        for at in range(self.m - self.block + 1):
            slots = self.slot(np.ascontiguousarray(heads[:, at : at + 8]).view("<u8")[:, 0])
            np.minimum.at(self.shift, slots, self.m - self.block - at)
        self.buckets: dict[int, list[bytes]] = {}
        for s, p in zip(slots.tolist(), patterns, strict=True):
            self.buckets.setdefault(s, []).append(p)

    def slot(self, value: np.ndarray) -> np.ndarray:
        return (((value & self.mask) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def search(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(position, pattern) of every occurrence that begins in [start, end) of a segment; data ends in 8
        bytes of padding, and an occurrence may reach beyond its segment's end."""
        view = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))
        last = self.m - self.block
        pos = starts + last
        stop = np.minimum(ends + last, len(data) - 7)
        live = pos < stop
        pos, stop = pos[live], stop[live]
        while len(pos):
            slots = self.slot(view[pos])
            move = self.shift[slots]
            for k in np.flatnonzero(move == 0).tolist():
                at = int(pos[k]) - last
                for p in self.buckets.get(int(slots[k]), ()):
                    if data.startswith(p, at):
                        yield at, p
            pos = pos + np.maximum(move, 1)
            live = pos < stop
            if not live.all():
                pos, stop = pos[live], stop[live]


def compiled(patterns: list[bytes]) -> list[WuManber]:
    """One table set for each class of pattern lengths, so short patterns don't shorten the others' shifts."""
    classes: dict[int, list[bytes]] = {}
    for p in patterns:
        classes.setdefault(next((c for c in (48, 32, 16, 8) if len(p) >= c), 0), []).append(p)
    return [WuManber(ps) for ps in classes.values()]


def _patterns(items: DataFrame, item_col: str, text_col: str, width: int) -> DataFrame:
    """(pattern, item_ids, block): the distinct windows of all items; computed by the tasks."""

    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(i, w) for i, t in zip(b.column(0).to_pylist(), texts(b.column(1)), strict=True) for w in sorted(windows(t, width))]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.binary())], names=["item_id", "pattern"])

    flat = items.select(F.col(f"`{item_col}`").cast("string").alias("item_id"), F.col(f"`{text_col}`").alias("text"))
    return flat.mapInArrow(cut, "item_id string, pattern binary").groupBy("pattern").agg(F.collect_set("item_id").alias("item_ids"))


def _search_block(carried: DataFrame, patterns: dict[bytes, list[str]], last: bool, keep_text: bool) -> DataFrame:
    """carried: (row, text, spans, item_ids); the word spans [begin, end, ..] of this block's occurrences and
    their item ids are appended. The last block's rows are digested in the same Python worker, so texts don't go through another."""
    sent = carried.sparkSession.sparkContext.broadcast(patterns)
    tables: list[WuManber] = []

    @lean
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids = sent.value
        if not tables and item_ids:
            tables.extend(compiled(list(item_ids)))
        for b in batches:
            forms = [normalised(t) for t in texts(b.column(1))]
            size = np.array([len(f) for f in forms], dtype=np.int64)
            begin = np.concatenate([[0], np.cumsum(size)])
            data = b"".join(forms) + b"\0" * 8
            cuts = -(-size // SEGMENT)
            doc = np.repeat(np.arange(len(forms)), cuts)
            starts = begin[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * SEGMENT
            ends = np.minimum(starts + SEGMENT, begin[doc + 1])
            hits: dict[int, list[tuple[int, int]]] = {}
            spans, found = b.column(2).to_pylist(), b.column(3).to_pylist()
            for t in tables:
                for at, p in t.search(data, starts, ends):
                    d = int(np.searchsorted(begin, at, "right")) - 1
                    if at + len(p) <= begin[d + 1]:
                        hits.setdefault(d, []).append((at, at + len(p)))
                        found[d] = [*{*found[d], *item_ids[p]}]
            for d, pairs in hits.items():
                space = np.flatnonzero(np.frombuffer(forms[d], dtype=np.uint8) == 32) + begin[d]
                ends_at = np.array(sorted(pairs))
                spans[d] = spans[d] + np.stack([np.searchsorted(space, ends_at[:, 0]), np.searchsorted(space, ends_at[:, 1] - 1)], 1).ravel().tolist()
            if last:
                yield _digested(b.column(0), b.column(1), spans, found, keep_text)
            else:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(spans, pa.list_(pa.int64())), pa.array(found, pa.list_(pa.string()))],
                                                 names=["row", "text", "spans", "item_ids"])

    row = carried.schema["row"].dataType.simpleString()
    digest = f"row {row}, text string, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, item_ids array<string>"
    return carried.mapInArrow(search, digest if last else carried.schema)


def _digested(row: pa.Array, text: pa.Array, spans: list[list[int]], found: list[list[str]], keep_text: bool) -> pa.RecordBatch:
    n_hit, n_items, digests = [], [], []
    for s, items in zip(spans, found, strict=True):
        end = hit = 0
        for a, e in sorted(zip(s[::2], s[1::2], strict=True)):
            hit += max(0, e - max(a, end))
            end = max(end, e)
        n_hit.append(hit)
        n_items.append(len(items))
        digests.append(hashlib.sha256(",".join(sorted(items)).encode()).hexdigest())
    n_words = [len(words_of(t)) for t in texts(text)]
    return pa.RecordBatch.from_arrays([row, text if keep_text else pa.nulls(len(row), pa.string()), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()),
                                       pa.array(digests, pa.string()), pa.array([n > 0 for n in n_hit], pa.bool_()), pa.array(found, pa.list_(pa.string()))],
                                      names=["row", "text", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "item_ids"])


def _judged(docs: DataFrame, items: DataFrame, rest: list[str], text_col: str, item_col: str, item_text_col: str, width: int, block: int, keep_text: bool) -> DataFrame:
    patterns = materialise(_patterns(items, item_col, item_text_col, width), "patterns")
    n = max(1, -(-patterns.count() // block))
    carried = docs.select(F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in rest)).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"),
                          F.array().cast("array<long>").alias("spans"), F.array().cast("array<string>").alias("item_ids"))
    for i in range(n):
        chosen = patterns if n == 1 else patterns.filter(F.pmod(F.xxhash64("pattern"), F.lit(n)) == i)
        carried = _search_block(carried, {bytes(r[0]): list(r[1]) for r in chosen.collect()}, i == n - 1, keep_text)  # about `block` patterns: the stated bound
    return carried


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", width: int = WINDOW, block: int = PATTERNS_PER_BLOCK) -> DataFrame:
    """One row per document: words, words hit, items with occurring windows, their digest and ids."""
    return _judged(docs, items, [id_col], text_col, item_col, item_text_col, width, block, False).select(
        F.col("row")[id_col].alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "item_ids")


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                      width: int = WINDOW, block: int = PATTERNS_PER_BLOCK) -> DataFrame:
    """The documents without any hit, with all their columns."""
    rest = [c for c in docs.columns if c != text_col]
    clean = _judged(docs, items, rest, text_col, item_col, item_text_col, width, block, True).filter(~F.col("contaminated"))
    return clean.select(*(F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))
