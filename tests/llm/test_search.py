"""Ranked and exact search and vector codes against brute force: nulls, ties, repeated rows, odd vectors, empty tables."""

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from regisight.llm import covertree, lexical, topk

VECTORS = "vec_id long, embedding array<float>, label string, v int, block string, code string"
NAN, INF = float("nan"), float("inf")
rng = np.random.default_rng(5)


BASE_VECTORS = [[float(x) for x in r] for r in rng.normal(0, 0.3, (60, 7)).astype(np.float32)]


def plain_rows():
    base = BASE_VECTORS
    rows = [(k, x, "abc"[k % 3]) for k, x in enumerate(base)]
    rows += [(100 + k, base[3], "a") for k in range(40)]  # one common vector
    rows += [(20, base[20], "c")] * 3  # repeated rows
    rows += [(40, base[0], None), (None, base[1], None), (None, base[1], None), (200, [], "e"), (201, [0.5], "e"), (202, [1e30, -1e30], "e"),
             (203, None, "e"), (204, [1.0, None], "e"), (205, [NAN] * 7, "e"), (206, [0.1, INF], "e"), (220, [0.0] * 7, None)]
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([(*r, 1, "b", "c") for r in plain_rows()], VECTORS).repartition(5)


def integers(x, scale, dim):
    got = [max(-(2**26), min(2**26, math.floor(min(max(float(np.float32(c)) * scale, -1e18), 1e18)))) for c in x]
    return tuple(got + [0] * (dim - len(got)))


def usable():
    return [r for r in plain_rows() if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]


@pytest.mark.parametrize("block_rows, query_group", [(16384, 256), (9, 3)])
def test_top_inner_products(vectors, block_rows, query_group):
    rows = {(i, integers(x, 64, 7)) for i, x, _ in usable()}
    want = collections.Counter()
    for i, q in rows:
        if i is not None and i % 20 == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j is None, j or 0, v) for j, v in rows if (j, v) != (i, q))[:5]
            want.update((i, r, None if null else j, -s) for r, (s, null, j, _) in enumerate(found, 1))
    got = topk.top_inner_products(vectors, F.pmod("vid", F.lit(20)) == 0, k=5, block_rows=block_rows, query_group=query_group)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    ids = collections.Counter((r.query_id, r["rank"], r.score) for r in got.collect())
    assert ids == collections.Counter((q, r, s) for q, r, _, s in want.elements())
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect() if r.query_id != 40} == {x for x in want if x[0] != 40}


def test_top_of_few_and_none(spark, vectors):
    few = vectors.filter("vec_id in (20, 21)")
    assert {(r.query_id, r["rank"], r.vec_id) for r in topk.top_inner_products(few, F.col("vid") == 20, k=5).collect()} == {(20, 1, 21)}
    assert topk.top_inner_products(vectors.limit(0), F.col("vid") == 20).isEmpty()
    assert topk.top_inner_products(vectors, F.col("vid") == -1).isEmpty()
    zero = spark.createDataFrame([(k, [0.0, 0.0], "", 0, "", "") for k in range(6)], VECTORS)
    assert [(r["rank"], r.vec_id, r.score) for r in topk.top_inner_products(zero, F.col("vid") == 2, k=3).orderBy("rank").collect()] == [(1, 0, 0), (2, 1, 0), (3, 3, 0)]


def test_sums_and_choice_of_slices():
    values = rng.integers(-50, 50, (300, 5)).astype(np.int32)
    values[:, 3] = 7  # no slice at all
    slices, low, width = topk.slices_of(values)
    block = topk.Block(list(range(300)), 300, low, width, slices.tobytes())
    assert (block.values(np.arange(300)) == values).all()
    for query in ([3, -7, 0, 5, 63], [0, 0, 0, 4, 0], [1 << 26, -(1 << 26), 1, 0, 0]):
        score = values.astype(object) @ np.array(query, dtype=object)
        best = sorted(((-s, k) for k, s in enumerate(score) if k != 9))[:20]
        assert sorted((-s, r) for r, s in block.best(query, 9, 20)) == best
    assert all(sum(s << p for p, s in topk.digits(n)) == n for n in range(-300, 300))


def lloyd(rows, scale, parts, entries, rounds):
    dim = max(len(x) for _, x, _ in rows)
    width = -(-dim // parts)
    ints = [integers(x, scale, parts * width) for _, x, _ in rows]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, [c for c in ints[k]][: len(rows[k][1])]))[:entries]
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    books = [[cut(ints[k])[p] for k in order] for p in range(parts)]
    d = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda: [[min(range(len(books[p])), key=lambda e: (d(cut(v)[p], books[p][e]), e)) for p in range(parts)] for v in ints]
    for _ in range(rounds):
        near = nearest()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(v)[p] for v, c in zip(ints, near, strict=True) if c[p] == e]
                if own:
                    books[p][e] = tuple(sum(col) // len(own) for col in zip(*own, strict=True))
    near = nearest()
    error = [sum(d(cut(v)[p], books[p][c[p]]) for p in range(parts)) for v, c in zip(ints, near, strict=True)]
    by_label = collections.Counter()
    for (_, _, label), e in zip(rows, error, strict=True):
        by_label[label] += e
    return collections.Counter((r[0], "".join(f"{c:02x}" for c in codes), e, by_label[r[2]]) for r, codes, e in zip(rows, near, error, strict=True)), books


@pytest.mark.parametrize("parts, entries, rounds, chunk_rows, wide", [(3, 8, 2, 8192, True), (2, 12, 3, 16, False), (7, 256, 1, 30, False)])
def test_codes(vectors, parts, entries, rounds, chunk_rows, wide):
    rows = [r for r in usable() if wide or r[0] != 202]
    want, books = lloyd(rows, 256, parts, entries, rounds)
    coded, codebooks = covertree.compress(vectors if wide else vectors.filter("vec_id is null or vec_id <> 202"), parts=parts, entries=entries, rounds=rounds, chunk_rows=chunk_rows)
    assert codebooks.tolist() == [[list(e) for e in b] for b in books]
    assert collections.Counter((r.vec_id, r.code, r.error, r.label_error) for r in coded.collect()) == want


def test_codes_of_nothing(vectors):
    coded, codebooks = covertree.compress(vectors.filter("vec_id = 203"))
    assert coded.isEmpty() and codebooks.shape[1] == 0 and covertree.digest(codebooks) == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_tree_covers_and_separates():
    points = np.unique(rng.integers(-90, 90, (4000, 3)).astype(np.int32), axis=0)
    tree, order = covertree.CoverTree.build(points, np.ones(len(points), np.int64), np.array([len(points)]))
    assert sorted(order.tolist()) == list(range(len(points))) and len(tree.nodes) > 500
    for (lo, hi, first, end), radius in zip(tree.nodes[:300], tree.radius, strict=False):
        assert math.isclose(math.sqrt(covertree.squared(tree.parts[lo:hi], tree.parts[lo : lo + 1]).max()), radius)
        if end > first:
            kids = tree.nodes[first:end]
            assert kids[0][0] == lo and kids[-1][1] == hi and (kids[1:, 0] == kids[:-1, 1]).all()
            cover = 2.0 ** (math.ceil(math.log2(radius)) - 1)
            assert (tree.radius[first:end] <= cover).all()
            centres = tree.parts[kids[:, 0]].astype(np.int64)
            apart = ((centres[:, None] - centres[None]) ** 2).sum(2) + np.eye(len(kids), dtype=np.int64) * 10**9
            assert (apart > cover * cover).all()
    book = points[:: len(points) // 10][None].astype(np.int64)
    entry, exact = tree.assign(book)
    assert (entry == covertree.distances(tree.parts, book[0]).argmin(1)).all() and exact < 3 * len(points) // 4  # the rest came with their subtrees


DOCS = "doc_id long, text string, n int, item int, bound long, terms string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w.translate(LOWER) for w in TERM.findall(text or "")]


def ranking(docs, items, k):
    n_docs, n_terms = sum(1 for _, t in docs if words(t)), sum(len(words(t)) for _, t in docs)
    df = collections.Counter(w for _, t in docs for w in set(words(t)))
    out = collections.Counter()
    for item, text in set(items):
        scores = []
        for i, t in docs:
            tf = collections.Counter(words(t))
            m = 75 + (25 * len(words(t)) * n_docs) // max(1, n_terms)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 12 * m)) for w in words(text) if tf[w])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out.update((item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k], 1))
    return out


CORPUS = [None, "", "  ", "a", "A a a", "b " * 700, "b c d", "É é ÉCOLE", "x\x00y-z", "9 [a] {b}", "lines\nof a\ttext", " ".join(f"w{k}" for k in range(6000)), "w1 w2 w3 rare", "w1 w2 w3 rare"]
DOCUMENTS = [(k, t) for k, t in enumerate(CORPUS)] + [(50 + k, "copy of w1 and rare") for k in range(30)] + [(6, "b c d")] * 2 + [(None, "b rare"), (None, None)]
ITEMS = [("i1", "a b a"), ("i2", "w1 W2 rare, rare"), ("i3", None), ("i4", "- !"), ("i5", "unknown"), (None, "é É c"), ("i1", "a b a"), ("i1", "copy of"), ("i6", " ".join(f"w{k}" for k in range(300)))]


@pytest.mark.parametrize("bits, block, wave", [((10, 22), 512, 64), ((0, 3), 3, 1)])
def test_lexical_search(spark, monkeypatch, bits, block, wave):
    monkeypatch.setattr(lexical, "SPREAD", bits[0])
    monkeypatch.setattr(lexical, "MAX_BITS", bits[1])
    docs = spark.createDataFrame([(i, t, 1, 2, 3, "t") for i, t in DOCUMENTS], DOCS).repartition(5)
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id string, text string, doc_id int")
    got = lexical.search(docs, items, k=6, items_per_block=block, wave=wave)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert collections.Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got.collect()) == ranking(DOCUMENTS, ITEMS, 6)


def test_lexical_search_of_nothing(spark):
    docs, items = spark.createDataFrame([(1, "a b", 1, 2, 3, "t")], DOCS), spark.createDataFrame([("i", "a")], "item_id string, text string")
    assert lexical.search(docs.limit(0), items).isEmpty() and lexical.search(docs, items.limit(0)).isEmpty()
    assert [tuple(r) for r in lexical.search(docs, items, index=lexical.sketches(docs)).select("item_id", "rank", "doc_id").collect()] == [("i", 1, 1)]


def test_bounds_hold():
    texts = [collections.Counter(rng.integers(0, 400, 300).astype(str).astype("S").tolist()) for _ in range(40)]
    texts[0][b"7"] = 100_000
    df = collections.Counter(w for c in texts for w in c)
    queries = lexical.Queries([collections.Counter({w: 1 + k % 2 for k, w in enumerate(list(c)[:30])}) for c in texts[:9]], df, 40, 12_000)
    made = lexical.folded(texts)
    n = np.array([sum(c.values()) for c in texts])
    bounds = queries.bounds(n, np.array([x[0] for x in made]), [x[1] for x in made], [x[2] for x in made])
    for d, c in enumerate(texts):
        for i in range(9):
            assert bounds[d, i] >= queries.score(i, c, queries.length_part(int(n[d]))) > 0
