"""Python workers live on between stages: what they take and keep is bounded."""

import collections
import re
import tracemalloc
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from regisight.llm import bpe, common, decontaminate, jaccard, linededup


def anonymous_mb() -> float:
    return sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def test_lean_gives_freed_memory_back():
    if not Path("/proc/self/smaps_rollup").exists() or not hasattr(common.ctypes.CDLL(None), "malloc_trim"):
        pytest.skip("memory can't be read or given back here")
    pinned = []

    def run(batches):
        for b in batches:
            held = [np.ones(8_000) for _ in range(3_000)]  # 190 MB in pieces that the allocator keeps
            pinned.append(np.ones(8_000))  # lies above them
            del held
            yield b

    before = anonymous_mb()
    assert list(common.lean(run)(iter([1, 2]))) == [1, 2]
    assert anonymous_mb() - before < 60


def test_functions_of_the_pipeline_give_back(monkeypatch):
    called = []
    monkeypatch.setattr(common, "give_back", lambda: called.append(1))
    runs = [jaccard._heavy_rows(5), jaccard._set_rows(5, 75), jaccard._prefix_rows(5, 75, type("B", (), {"value": (np.zeros(0, np.uint64),) * 2}), 1), jaccard._group_rows, jaccard._possible(75),
            jaccard._whole_sets(5, 75, type("B", (), {"value": (None, None)})), jaccard._shared_fronts, jaccard._compared(75), jaccard._cell_rows(75), linededup._passage_rows(2), linededup._bodies, linededup._rest]
    for k, run in enumerate(runs, 1):
        assert list(run(iter([]))) == [] and len(called) == k


def bucket_rows(rng, n: int, ids: int, rows: int = 20, bucket: int = 3) -> tuple[pa.RecordBatch, dict]:
    """A bucket of n places of shingles and the members of each."""
    tok, own = rng.integers(0, n // 3, n) * 0x9E3779B1 % (1 << 40), rng.integers(0, ids, n)
    short = np.ascontiguousarray(tok.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:])
    cut = np.array_split(np.arange(n), rows)
    b = pa.RecordBatch.from_arrays([pa.array([bucket] * rows), pa.array([short[c].tobytes() for c in cut], pa.binary()), pa.array([own[c].tobytes() for c in cut], pa.binary())], names=["bucket", "tokens", "ids"])
    members = collections.defaultdict(list)
    if n <= 100_000:
        for t, o in zip(tok.tolist(), own.tolist(), strict=True):
            members[t].append(o)
    return b, members


def test_groups_of_a_bucket_are_whole():
    rng = np.random.default_rng(1)
    found, first = bucket_rows(rng, 6_000, 12)
    other, second = bucket_rows(rng, 3_000, 5, bucket=4)
    hot = pa.RecordBatch.from_arrays([pa.array([-5]), pa.array([np.array([7, 9, 7], np.int64).tobytes()], pa.binary()), pa.array([np.array([4, 5, 3], np.int64).tobytes()], pa.binary())], names=["bucket", "tokens", "ids"])
    out = pa.Table.from_batches(jaccard._group_rows(iter([hot, found, other]))).to_pylist()
    cold = [r for r in out if r["gid"] >= 0]
    assert len({r["gid"] for r in cold}) == len(cold)
    for bucket, members in ((3, first), (4, second)):
        got = [tuple(r["ids"]) for r in cold if r["gid"] >> 32 == bucket]
        assert len(got) == len(set(got)) and set(got) == {tuple(sorted(m)) for m in members.values() if len(m) > 1}
    assert [tuple(r["ids"]) for r in out if r["gid"] < 0] == [(3, 4), (5,)]


def test_groups_of_a_bucket_take_little_memory():
    b, _ = bucket_rows(np.random.default_rng(2), 600_000, 100_000)
    size = sum(len(x.as_buffer()) for k in (1, 2) for x in b.column(k))
    tracemalloc.start()
    try:
        assert sum(x.num_rows for x in jaccard._group_rows(iter([b]))) > 50_000
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 7 * size, peak / size


def test_bpe_learns_little_at_once():
    texts = ["word " * 20_000] * 40
    cut = list(bpe.pieces(texts))
    assert [t for p in cut for t in p] == texts and max(sum(map(len, p)) for p in cut) <= 1_200_000
    assert bpe.CACHE <= 50_000


def test_bpe_learns_segments_together():
    """Every new segment was cut by itself, and segments that never come again put the words out of the caches."""
    c, calls = bpe.Codec(public_tokenizers.path("byte_bpe_50k.json")), []
    cut = c.pretokens
    c.pretokens = lambda t: calls.append(1) or cut(t)
    batch = [" ".join(f"w{k}.\nX{j}" for k in range(40)) for j in range(40)]
    c.learn(batch)
    assert len(calls) <= 2 * len(batch) and "w1.\nX1" in c.after_space
    ids = [c.encode(t) for t in batch]
    c.learn(["some words"])
    assert not any("\n" in k and len(k) > 1 for d in (c.after_space, c.bare, c.after_space.old, c.bare.old) for k in d) and {"words", "w"} <= c.after_space.keys()
    assert ids == [c.encode(t) for t in batch] and [c.decode(x) for x in ids] == batch


def test_bpe_learnt_segments_are_cut_as_texts(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 40)
    path = public_tokenizers.path("byte_bpe_50k.json")
    c = bpe.Codec(path)
    rng = np.random.default_rng(3)
    signs = ["a", "the", "'s", "'", "I'll", "\n", "\t", "\x1c", "\x85", "\u3000", "7", "!", "--", "é", "ř" * 40, "語" * 30, "x" * 70, "<|endoftext|>", " ", "  ", " ", " ", "word", "Zz.", "\n\n", "\U0001f600"]
    batch = ["", " ", "end\n", "end\n more", " start", *("".join(rng.choice(signs, n)) for n in rng.integers(1, 30, 400))]

    def alone(text: str) -> list[int]:
        out = []
        for k, part in enumerate(c.split_special.split(text) if c.split_special else [text]):
            out += [c.special[part]] if k % 2 else [i for w in c.pretokens(part) for i in bpe.merge_all([c.byte_id[b] for b in w.encode()], c.pairs)]
        return out

    for lo in range(0, len(batch), 20):
        c.learn(batch[lo : lo + 20])
        for t in batch[lo : lo + 20]:
            assert c.encode(t) == alone(t), t


def test_bpe_pairs_are_found():
    for pairs in ({}, {0: (0, 7)}, {(k * 7919 % 1000) << 32 | k: (k, 1000 + k) for k in range(3_000)}):
        table = bpe.PairTable(pairs, np.arange(256))
        keys = np.array([*pairs, 5 << 32 | 999_999, 3], dtype=np.int64)
        got = table.rank(keys >> 32, keys & 0xFFFFFFFF)
        assert got.tolist() == [pairs[k][0] if k in pairs else bpe.NO_RANK for k in keys.tolist()]
        assert (table.rank(np.array([-1, 0, -1]), np.array([0, -1, -1])) == bpe.NO_RANK).all()
        for left in (0, 7, 255):
            assert table.byte_ranks[left * 256 : left * 256 + 256].tolist() == [pairs.get(left << 32 | k, (bpe.NO_RANK,))[0] for k in range(256)]


def test_decontamination_takes_one_python_worker_a_task(spark):
    """The digest is made where the last block is searched: a second worker for each core would stay with its memory."""
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, "x y"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([("i", "b c d e f g h i j k"), ("k", "x y")], "item_id string, text string")
    out = decontaminate.contamination(docs, items)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in out.collect()} == {(1, 11, 10, 1, True), (2, 2, 2, 1, True), (3, 0, 0, 0, False)}
    several = decontaminate.contamination(docs, items, block=1)
    assert sorted(map(str, several.collect())) == sorted(map(str, out.collect()))
