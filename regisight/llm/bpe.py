"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

A pretoken's symbols lie in an array; leaf i of a min-tree holds (rank of the pair that starts at symbol i,
i), so the root is the leftmost pair of lowest rank. A merge changes the pair on either side of it: three
leaves, each mended along its path to the root, until the root says that no pair is left. n symbols take
O(n log n), also for a pretoken of any length. The new pretokens of a batch go through their trees together,
one numpy step merging once in each of them; pretokens beyond LOCKSTEP bytes go one by one (merge_all).

Texts are cut where a new pretoken must begin (a space after a non-space), and pieces seen before come from
a cache of bounded size, so work per text is a few dictionary look-ups a word. Everything is per row: nothing
is shuffled and a lost task repeats only its rows.

Defined results: a null text is empty and has no tokens (the digest is that of the empty string); strings of
added special tokens inside a text become their ids, as the library's default does; repeated rows are encoded
each by itself; an empty table gives an empty table; other columns are kept by encode_documents' callers only.
"""

from __future__ import annotations

import gc
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regisight.llm.common import lean, texts

#: Fixed value: the pretoken pattern of byte-level BPE.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE_BEFORE_SPACE = regex.compile(r"[^\S ] ").search
SINGLE_MARKS = frozenset(",.;:!?")
CACHE, PIECE = 50_000, 1_000_000
NONE = 1 << 62
NO_RANK = (1 << 31) - 1
LOCKSTEP, TOGETHER = 64, 4096
_SHIFT = 32


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of bytes in the vocabulary file: visible Latin-1 bytes stand for themselves, the
    others take code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def merge_all(symbols: list[int], pairs: dict[int, tuple[int, int]]) -> list[int]:
    """symbols after all merges; pairs maps (left << 32 | right) to (rank, merged symbol)."""
    n = len(symbols)
    if n < 2:
        return symbols
    get = pairs.get
    size = 1 << (n - 2).bit_length() if n > 2 else 1
    tree = [NONE] * (2 * size)
    for i in range(n - 1):
        p = get(symbols[i] << _SHIFT | symbols[i + 1])
        if p is not None:
            tree[size + i] = p[0] << _SHIFT | i
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n

    def put(i: int, value: int) -> None:
        k = size + i
        tree[k] = value
        k >>= 1
        while k:
            a, b = tree[2 * k], tree[2 * k + 1]
            low = a if a < b else b
            if tree[k] == low:
                break
            tree[k] = low
            k >>= 1

    while (root := tree[1]) != NONE:
        i = root & 0xFFFFFFFF
        j = after[i]
        symbols[i] = merged = get(symbols[i] << _SHIFT | symbols[j])[1]
        alive[j] = False
        k = after[i] = after[j]
        if j < n - 1:
            put(j, NONE)
        if k < n:
            before[k] = i
            p = get(merged << _SHIFT | symbols[k])
            put(i, NONE if p is None else p[0] << _SHIFT | i)
        else:
            put(i, NONE)
        h = before[i]
        if h >= 0:
            p = get(symbols[h] << _SHIFT | merged)
            put(h, NONE if p is None else p[0] << _SHIFT | h)
    return [s for s, a in zip(symbols, alive, strict=True) if a]


class PairTable:
    """Ranks and results of all pairs in an open hash table, for numpy look-ups; byte pairs have a table of their own."""

    def __init__(self, pairs: dict[int, tuple[int, int]], byte_id: np.ndarray):
        n = len(pairs)
        bits = max(4, (4 * n).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ranks = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, NO_RANK, dtype=np.int32)
        keys = np.fromiter(pairs, dtype=np.int64, count=n)
        ranks = np.fromiter((r for r, _ in pairs.values()), dtype=np.int32, count=n)
        slot = self.slot(keys)
        while len(keys):  # of the pairs that want one empty slot the first gets it, the others try the next slot
            empty = np.flatnonzero(self.keys[slot] < 0)
            _, one = np.unique(slot[empty], return_index=True)
            put = empty[one]
            self.keys[slot[put]], self.ranks[slot[put]] = keys[put], ranks[put]
            left = np.ones(len(keys), dtype=bool)
            left[put] = False
            keys, ranks, slot = keys[left], ranks[left], (slot[left] + 1) & self.mask
        self.merged = np.full(max((r for r, _ in pairs.values()), default=-1) + 1, -1, dtype=np.int32)
        for r, m in pairs.values():
            self.merged[r] = m
        self.byte_id = byte_id.astype(np.int32)
        self.byte_ranks = self.rank(np.repeat(self.byte_id, 256), np.tile(self.byte_id, 256))

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs (left, right), NO_RANK for none; a negative symbol makes no pair."""
        key = left.astype(np.int64) << _SHIFT | right
        slot = self.slot(key)
        found = self.keys.take(slot)
        out = np.where((found == key) & (key >= 0), self.ranks.take(slot), NO_RANK)
        open_ = np.flatnonzero((found != key) & (found >= 0) & (key >= 0))
        while len(open_):
            slot_ = slot[open_] = (slot[open_] + 1) & self.mask
            found = self.keys[slot_]
            hit = found == key[open_]
            out[open_[hit]] = self.ranks[slot_[hit]]
            open_ = open_[~hit & (found >= 0)]
        return out


def merge_lockstep(words: list[bytes], table: PairTable, size: int) -> tuple[list[int], list[int]]:
    """merge_all of words of at most `size` bytes (a power of two), all trees advancing together: the symbols of all
    words and where those of each end. A leaf is rank * size + position; words lie one after another in flat arrays."""
    w, width = len(words), size + 1
    n = np.array([len(x) for x in words])
    cell = np.arange(size)
    inside = cell < n[:, None]
    raw = np.zeros((w, size), dtype=np.uint8)
    raw[inside] = np.frombuffer(b"".join(words), dtype=np.uint8)
    symbols = np.full((w, width), -1, dtype=np.int32)
    symbols[:, :size] = np.where(inside, table.byte_id[raw], -1)
    bits = size.bit_length() - 1
    trees = np.full((w, 2 * size), NONE, dtype=np.int64)
    first = table.byte_ranks[raw[:, :-1].astype(np.int64) << 8 | raw[:, 1:]].astype(np.int64)
    trees[:, size:-1] = np.where(inside[:, 1:] & (first != NO_RANK), first << bits | cell[:-1], NONE)
    k = size
    while k > 1:
        k //= 2
        np.minimum(trees[:, 2 * k : 4 * k : 2], trees[:, 2 * k + 1 : 4 * k : 2], out=trees[:, k : 2 * k])
    tree, sym, alive = trees.reshape(-1), symbols.reshape(-1), inside.copy()
    after = np.tile(np.arange(1, width + 1), (w, 1)).reshape(-1)
    before = np.tile(np.arange(-1, width - 1), (w, 1)).reshape(-1)
    living = alive.reshape(-1)
    rows = np.flatnonzero(trees[:, 1] != NONE)
    root = trees[rows, 1]
    while len(rows):
        at, leaves = rows * width, rows * (2 * size) + size
        i = root & (size - 1)
        m = table.merged.take(root >> bits)
        ai = at + i
        j = after.take(ai)
        right = after.take(at + j)
        sym[ai] = m
        living[rows * size + j] = False
        after[ai] = right
        before[at + right] = i
        left = before.take(ai)
        # without a left neighbour the last leaf is written, which never starts a pair
        place = np.concatenate([i, left % size])
        ranks = table.rank(np.concatenate([m, np.where(left < 0, -1, sym.take(at + left % size))]), np.concatenate([sym.take(at + right), m]))
        tree[leaves + j] = NONE
        tree[np.concatenate([leaves, leaves]) + place] = np.where(ranks == NO_RANK, NONE, ranks.astype(np.int64) << bits | place)
        start = np.concatenate([leaves, leaves, leaves]) - size
        node = np.concatenate([place, j]) + size
        level = size
        while level > 1:
            level //= 2
            node >>= 1
            child = start + 2 * node
            tree[start + node] = np.minimum(tree.take(child), tree.take(child + 1))
        root = tree.take(leaves - size + 1)
        more = root != NONE
        rows, root = rows[more], root[more]
    return symbols[:, :size][alive].tolist(), np.cumsum(alive.sum(axis=1)).tolist()


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocab, alphabet = file["model"]["vocab"], byte_alphabet()
        self.byte_id = [0] * 256
        for c, b in alphabet.items():
            self.byte_id[b] = vocab[c]
        self.pairs: dict[int, tuple[int, int]] = {}
        for rank, m in enumerate(file["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.pairs.setdefault(vocab[a] << _SHIFT | vocab[b], (rank, vocab[a + b]))
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.piece = {i: bytes(alphabet[c] for c in s) for s, i in vocab.items()} | {i: s.encode() for s, i in self.special.items()}
        self.piece_of_decimal = {str(i): b for i, b in self.piece.items()}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pretokens = regex.compile(PRETOKEN).findall
        self.table = PairTable(self.pairs, np.array(self.byte_id))
        self.decimal = {i: str(i) for i in self.piece}
        self.bare, self.after_space = _Segments(self, ""), _Segments(self, " ")

    def merged(self, word: str) -> str:
        """Comma-joined ids of one pretoken."""
        return ",".join([self.decimal[i] for i in merge_all([self.byte_id[b] for b in word.encode("utf-8", "surrogatepass")], self.pairs)])

    def cut(self, segment: str) -> list[str]:
        """The pretokens of a segment; a plain word, also with one mark behind it, needs no pattern."""
        if segment.isascii():
            word = segment[1:] if segment[:1] == " " else segment
            if word.isalpha():
                return [segment]
            if word[-1:] in SINGLE_MARKS and word[:-1].isalpha():
                return [segment[:-1], segment[-1]]
        return self.pretokens(segment)

    def home(self, word: str) -> tuple[_Segments, str]:
        """The cache and the key of a pretoken, which is a segment as well."""
        return (self.after_space, word[1:]) if word[0] == " " and len(word) > 1 and not word[1].isspace() else (self.bare, word)

    def word(self, word: str) -> str:
        cache, key = self.home(word)
        return cache[key]

    def learn(self, batch: list[str]) -> None:
        """Puts the new segments of some texts into the caches, their pretokens merged together. Segments of several
        pretokens seldom come again: they stay until other texts are learnt, their pretokens longer."""
        first: set[str] = set()
        rest: set[str] = set()
        for t in batch:
            parts = t.split(" ")
            first.add(parts[0])
            rest.update(parts[1:])
        cuts: list[tuple[_Segments, str, _Segments, str, list[str]]] = []
        bare: set[str] = set()
        spaced: set[str] = set()
        for cache, keys in ((self.bare, first), (self.after_space, rest)):
            cache.forget()
            cache.turn()
            plain, others = [], []
            for key in cache.unknown(keys):
                (plain if key.isalpha() and key.isascii() else others).append(key)
            (spaced if cache.before else bare).update([k for k in plain if len(k) < LOCKSTEP])
            for key, words in self.cut_all(cache.before, [k for k in others if k and len(k) < LOCKSTEP]):
                own, k = self.home(words[0])
                (spaced if own.before else bare).add(k)
                if len(words) > 1:  # only the first may begin with a space
                    cuts.append((cache, key, own, k, words[1:]))
                    bare.update(words[1:])
        self.merge_new([(cache, k) for cache, keys in ((self.bare, bare), (self.after_space, spaced)) for k in cache.unknown(keys)])
        joined = self.bare.__getitem__
        for cache, key, own, k, words in cuts:
            cache.pass_by(key, ",".join([own[k], *map(joined, words)]))

    def cut_all(self, before: str, keys: list[str]) -> list[tuple[str, list[str]]]:
        """Keys with the pretokens of the segments before + key. Those that begin with a space and don't end with white
        space are cut as one text: nothing but their beginnings begins with a space there."""
        together = [k for k in keys if not k[-1].isspace()] if before else []
        cut: list[list[str]] = []
        for w in self.pretokens(before + before.join(together)) if together else []:
            if w[0] == before:
                cut.append([w])
            else:
                cut[-1].append(w)
        return [*zip(together, cut, strict=True), *((k, self.cut(before + k)) for k in keys if not before or k[-1].isspace())]

    def merge_new(self, places: list[tuple[_Segments, str]]) -> None:
        """Puts the ids of pretokens into their places, those whose trees are of one size merged together."""
        raws = [(cache.before + k).encode("utf-8", "surrogatepass") for cache, k in places]
        sizes = np.array([len(r) for r in raws], dtype=np.int64)
        size, low = 8, 0
        while low < LOCKSTEP:
            order = np.flatnonzero((sizes > low) & (sizes <= size)).tolist()
            for lo in range(0, len(order), TOGETHER):
                part = order[lo : lo + TOGETHER]
                ids, ends = merge_lockstep([raws[x] for x in part], self.table, size)
                decimals, start = list(map(self.decimal.__getitem__, ids)), 0
                for x, end in zip(part, ends, strict=True):
                    cache, k = places[x]
                    cache[k] = ",".join(decimals[start:end])
                    start = end
            size, low = 2 * size, size

    def encode_plain(self, text: str) -> list[str]:
        """Comma-joined ids of the segments of a text without special tokens; a segment begins at a space
        that follows a non-space, where a pretoken always begins."""
        if "  " in text or text.endswith(" ") or SPACE_BEFORE_SPACE(text):
            return list(map(self.word, self.pretokens(text)))
        parts = text.split(" ")
        first = self.bare[parts[0]] if parts[0] else ""
        out = list(map(self.after_space.__getitem__, parts[1:]))
        return [first, *out] if first else out

    def encode_joined(self, text: str) -> str:
        """Decimal ids joined by commas."""
        if self.split_special is None or not any(s in text for s in self.special):
            return ",".join(self.encode_plain(text))
        out = []
        for k, part in enumerate(self.split_special.split(text)):
            if k % 2:
                out.append(str(self.special[part]))
            elif part:
                out += self.encode_plain(part)
        return ",".join(out)

    def encode(self, text: str) -> list[int]:
        joined = self.encode_joined(text)
        return list(map(int, joined.split(","))) if joined else []

    def decode_bytes(self, ids: list[int]) -> bytes:
        """The bytes of ids; special tokens give their strings."""
        return b"".join(map(self.piece.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


class _Segments(dict):
    """Comma-joined ids of segments, all of which begin with `before`, in two generations: what is used moves to the
    young one, and when that is full it becomes the old one, whose unused entries go. Long segments aren't kept, those
    of several pretokens (passing) only for the texts they were learnt from."""

    def __init__(self, codec: Codec, before: str):
        super().__init__()
        self.codec, self.before, self.old, self.passing = codec, before, {}, []

    def turn(self) -> None:
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()

    def unknown(self, keys: set[str]) -> list[str]:
        """The keys in neither generation; those in the old one are young then."""
        new = [k for k in keys if k not in self]
        if self.old:
            for k in (old := self.old).keys() & new:
                self[k] = old[k]
            new = [k for k in new if k not in old]
        return new

    def forget(self) -> None:
        for key in self.passing:
            self.pop(key, None)
        self.passing.clear()

    def pass_by(self, key: str, joined: str) -> None:
        """Keeps a segment until others are learnt."""
        self[key] = joined
        self.passing.append(key)

    def __missing__(self, key: str) -> str:
        joined = self.old.get(key)
        if joined is None:
            words = self.codec.cut(self.before + key)
            joined = self.codec.merged(words[0]) if len(words) == 1 else ",".join(map(self.codec.word, words))
            if len(key) >= LOCKSTEP:
                return joined
            self.turn()
        self[key] = joined
        return joined


def pieces(batch: list[str]) -> Iterator[list[str]]:
    """Texts of a batch in pieces of about PIECE characters, so that what they bring to the caches is bounded."""
    lo = size = 0
    for hi, t in enumerate(batch):
        size += len(t)
        if size >= PIECE:
            yield batch[lo : hi + 1]
            lo, size = hi + 1, 0
    if lo < len(batch):
        yield batch[lo:]


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a vocabulary file, loaded once in each Python worker."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _learned(c: Codec, column: pa.Array) -> Iterator[str]:
    """The texts of a column, each after its segments were learnt."""
    for piece in pieces(list(texts(column))):
        gc.disable()  # learning makes many short lists and no cycles, which the collector would walk again and again
        try:
            c.learn(piece)
        finally:
            gc.enable()
        yield from piece


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for b in batches:
            ids = [c.encode(t) for t in _learned(c, b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of rows with token ids; null ids give an empty text."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.decode(x or []) for x in b.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{ids_col}`").alias("ids")).mapInArrow(run, "doc_id long, text string")


def encode_checked(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, n_tokens, exact) of every row; exact: the ids decode to the text."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for b in batches:
            ids, exact = [], []
            for t in _learned(c, b.column(1)):
                decimals = joined.split(",") if (joined := c.encode_joined(t)) else []
                ids.append(np.array(decimals, dtype=np.int32))
                exact.append(b"".join(map(c.piece_of_decimal.__getitem__, decimals)).decode("utf-8", "replace") == t)
            n = np.array([len(x) for x in ids], dtype=np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
            yield pa.RecordBatch.from_arrays([b.column(0), lists, pa.array(n), pa.array(exact, pa.bool_())], names=["doc_id", "ids", "n_tokens", "exact"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, exact boolean")


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256 of encoding and decoding the whole text."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        piece = c.piece_of_decimal.__getitem__
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for t in _learned(c, b.column(1)):
                joined = c.encode_joined(t)
                ids = joined.split(",") if joined else []
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(joined.encode()).hexdigest())
                text_sha.append(hashlib.sha256(b"".join(map(piece, ids)).decode("utf-8", "replace").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
