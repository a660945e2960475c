"""Removal of repeated multi-line passages.

A passage is a run of MIN_LINES lines that are not blank, with the blank lines between them. Every such run is
compared over the whole corpus, so a repeat of any length is found whole, wherever it begins or ends in either
document: a longer repeat is the union of its runs. Besides, texts are cut into chunks that end after a line where
the hash over the hashes of the last ROLL lines is a local minimum, so boundaries find their place again after
insertions and deletions; chunks of MIN_LINES lines with fewer that are not blank are compared as well. Hashes are
counted, the bytes of those whose 128-bit hash repeats are fetched and compared, and every occurrence
but the first (by id, then line) is removed, unless it overlaps the first. Bytes that differ from others of
the same hash are never removed. Blank lines go with the lines on both sides of them (or the end of the text).

The first occurrence of every line stays in the corpus; where a document's own lines stand between
repeats of two others, each repeat is judged by itself. Single lines are no passages, however long.

A passage in a third of all documents is one row of a partial aggregation in each task; joins on the hash are
plain equi-joins that may be split by the hash's rows.

Defined results: a null text is empty and stays as it is; chunks of white space only are kept; a line is what
lies between two \\n, and a removed passage takes its line ends with it; rows that repeat an id are ordered by a
hash of their text, full repeats of a row are the same position and are treated alike; a null id comes after all
others; an empty table gives an empty table; other columns are kept.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regisight.llm.common import keyed, lean, materialise, texts

ROLL, MIN_LINES = 2, 2
BLANK = " \t\n\r\x0b\x0c"  # what bytes.strip() takes away
_MASK = (1 << 64) - 1


def chunks(lines: list[bytes], roll: int = ROLL) -> list[tuple[int, int]]:
    """[begin, end) line ranges of a text: a chunk ends after a line whose rolling hash is smaller than that of the
    line before and not larger than that of the line after, which spaces ends by two lines at least."""
    hashes = [xxhash.xxh64_intdigest(x) for x in lines]
    rolled = []
    for i in range(len(lines)):
        r = 0
        for h in hashes[max(0, i - roll + 1) : i + 1]:
            r = (r * 0x9E3779B97F4A7C15 + h) & _MASK
        rolled.append(r ^ r >> 29)
    ends = [i + 1 for i in range(1, len(lines) - 1) if rolled[i] < rolled[i - 1] and rolled[i] <= rolled[i + 1]]
    edges = [0, *ends, len(lines)]
    return list(zip(edges, edges[1:]))


def passages(lines: list[bytes], least: int = MIN_LINES) -> list[tuple[int, int]]:
    """[begin, end) line ranges that are compared: runs of so many lines that are not blank, and chunks with fewer."""
    full = [i for i, x in enumerate(lines) if x.strip()]
    runs = [(a, b + 1) for a, b in zip(full, full[least - 1 :])]
    before = [0, *itertools.accumulate(1 if x.strip() else 0 for x in lines)]
    return runs + [(a, b) for a, b in chunks(lines) if b - a >= least and 0 < before[b] - before[a] < least]


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _passage_rows(least: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            for iid, tkey, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts(b.column(2)), strict=True):
                lines = text.encode("utf-8", "surrogatepass").split(b"\n")
                if len(lines) < least:
                    continue
                for begin, end in passages(lines, least):
                    h = xxhash.xxh3_128_intdigest(b"\n".join(lines[begin:end]))
                    for o, v in zip(out, (_signed(h >> 64), _signed(h & _MASK), iid, tkey, begin, end), strict=True):
                        o.append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types, strict=True)], names=["h", "h2", "iid", "tkey", "begin", "end"])

    return run


@lean
def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        h, h2, body = [], [], []
        for text, wanted in zip(texts(b.column(0)), b.column(1).to_pylist(), strict=True):
            lines = text.encode("utf-8", "surrogatepass").split(b"\n")
            for w in wanted:
                h.append(w["h"])
                h2.append(w["h2"])
                body.append(b"\n".join(lines[w["begin"] : w["end"]]))
        yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(h2, pa.int64()), pa.array(body, pa.binary())], names=["h", "h2", "body"])


def repeated_chunks(rows: DataFrame, least: int = MIN_LINES) -> DataFrame:
    """rows: keyed documents. (iid, tkey, begin, end) of every passage that repeats an earlier one."""
    text = rows.select("iid", "tkey", "text")
    found = materialise(text.mapInArrow(_passage_rows(least), "h long, h2 long, iid long, tkey long, begin int, end int"), "chunks")
    place = F.struct("iid", "tkey", "begin")
    often = found.groupBy("h", "h2").agg(F.count(F.lit(1)).alias("c"), F.min(place).alias("first")).filter("c > 1").drop("c")
    again = materialise(found.join(often, ["h", "h2"]), "repeats")
    wanted = again.groupBy("iid", "tkey").agg(F.collect_list(F.struct("h", "h2", "begin", "end")).alias("wanted"))
    bodies = text.join(wanted, ["iid", "tkey"]).select("text", "wanted").mapInArrow(_bodies, "h long, h2 long, body binary")
    same = bodies.distinct().groupBy("h", "h2").agg(F.count(F.lit(1)).alias("c")).filter("c = 1").select("h", "h2")
    own = (F.col("iid") == F.col("first.iid")) & (F.col("tkey") == F.col("first.tkey")) & (F.col("begin") < F.col("first.begin") + F.col("end") - F.col("begin"))
    return again.join(same, ["h", "h2"]).filter((place > F.col("first")) & ~own).select("iid", "tkey", "begin", "end")


def _with_blanks(lines: list[str], gone: set[int]) -> set[int]:
    """gone and the blank lines that have removed lines, or an end of the text, on both sides."""
    if not gone:
        return gone
    stay = [-1, *(i for i, x in enumerate(lines) if i not in gone and x.strip(BLANK)), len(lines)]
    out = set(gone)
    for a, b in zip(stay, stay[1:]):
        inside = [i for i in range(a + 1, b) if i in gone]
        if inside:
            out.update(range(0 if a < 0 else inside[0], len(lines) if b == len(lines) else inside[-1] + 1))
    return out


@lean
def _rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out, n_lines, n_removed = [], [], []
        for text, drop in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            lines = (text or "").split("\n")
            gone = _with_blanks(lines, {k for d in drop or () for k in range(d["begin"], d["end"])})
            out.append(text if not gone else "\n".join(x for k, x in enumerate(lines) if k not in gone))
            n_lines.append(len(lines))
            n_removed.append(len(gone))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())],
                                         names=["row", "text", "n_lines", "n_removed_lines"])


def _cleaned(docs: DataFrame, id_col: str, text_col: str, rest: list[str], least: int) -> DataFrame:
    marks = repeated_chunks(keyed(docs, id_col, text_col), least)
    drop = marks.groupBy("iid", "tkey").agg(F.collect_list(F.struct("begin", "end")).alias("drop"))
    own, id_ = F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.col(f"`{id_col}`").cast("long")
    row = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in rest))
    left = docs.select(F.coalesce(id_, F.lit(9223372036854775807)).alias("iid"), F.xxhash64(own).bitwiseAND(F.lit(0xFFFFFFFF)).alias("tkey"), row.alias("row"), F.col(f"`{text_col}`").alias("text"))
    joined = left.join(drop, ["iid", "tkey"], "left").select("row", "text", "drop")
    return joined.mapInArrow(_rest, f"row {joined.schema['row'].dataType.simpleString()}, text string, n_lines long, n_removed_lines long")


def line_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_LINES) -> DataFrame:
    """Per row: doc_id, n_lines, n_removed_lines and the remaining text."""
    return _cleaned(docs, id_col, text_col, [id_col], least).select(F.col("row")[id_col].alias("doc_id"), "n_lines", "n_removed_lines", "text")


def remove_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_LINES, drop_whole: bool = False) -> DataFrame:
    """docs with the text that remains; all rows and columns stay, but for drop_whole rows whose lines are all removed."""
    out = _cleaned(docs, id_col, text_col, [c for c in docs.columns if c != text_col], least)
    out = out.filter("n_removed_lines < n_lines") if drop_whole else out
    return out.select(*(F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))
