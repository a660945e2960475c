"""Operators against brute force on awkward small tables: nulls, empty and long texts, ties, repeated rows, empty
tables and extra columns with clashing names."""

import collections
import hashlib
import itertools
import re

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from regisight.llm import bpe, chat, decontaminate, html, jaccard, linededup, pii, quality, suffix, tokencount

SCHEMA = "doc_id long, text string, n_words long, h long, row string"
PASSAGE = " ".join(f"shared{i}" for i in range(40))
TEXTS = [None, "", " ", "one", "a b c", PASSAGE, PASSAGE + " tail", "head " + PASSAGE, "é ü " * 60, "x" * 5000, "ab " * 700,
         "\n".join(f"line {i} of a block that repeats" for i in range(8)), "new start\n" + "\n".join(f"line {i} of a block that repeats" for i in range(8)) + "\nnew end",
         "mail a.b@c-d.example.org or 1.2.3.4 card 4111 1111 1111 1111 tel +1 (555) 123-4567", "256.1.1.1 and 4111111111111112 +12", "9" * 3000,
         'token = "0123456789abcdef0123"', "<|endoftext|> x <s>", PASSAGE.upper() + "\0"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, 7, 8, "r") for k, t in enumerate(TEXTS)] + [(100, PASSAGE, 7, 8, "r"), (100, PASSAGE, 7, 8, "r"), (None, PASSAGE, 7, 8, "r"), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def text_of(docs):
    return {(r.doc_id, r.text) for r in docs.collect()}


def by_id(df, *columns):
    return collections.Counter((r["doc_id"], *(r[c] for c in columns)) for r in df.collect())


def test_quality(docs, empty):
    def expected(t):
        t = t or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        windows = list(zip(w, w[1:], w[2:]))
        n = collections.Counter(windows)
        covered = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)

    got = by_id(quality.judge(docs), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == collections.Counter((r.doc_id, *expected(r.text)) for r in docs.collect())
    assert quality.filter_documents(docs).columns == docs.columns and quality.filter_documents(empty).isEmpty()


def test_suffix(docs, empty):
    rows = sorted({(r.doc_id is None, r.doc_id or 0, r.text or "") for r in docs.collect()})
    got = {(r.doc_id, r.n_bytes): (r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix.remove_repeats(docs).collect()}
    seen = set()
    for null, i, t in rows:
        b = t.encode()
        if null and t == "":
            continue
        hit = [False] * len(b)
        own = [b[k : k + 100] for k in range(len(b) - 99)]
        for k, w in enumerate(own):
            if w in seen:
                hit[k : k + 100] = [True] * 100
            seen.add(w)
        kept = bytes(x for x, h in zip(b, hit, strict=True) if not h)
        spans = sum(1 for h, _ in itertools.groupby(hit) if h)
        assert got[(None if null else i, len(b))] == (sum(hit), spans, kept), (i, t[:40])
    assert suffix.remove_repeats(empty).isEmpty()


def test_line_dedup(docs, empty):
    out = {(r.doc_id, r.n_removed_lines) for r in linededup.line_counts(docs).collect()}
    assert (11, 0) in out and any(i == 12 and n >= 2 for i, n in out)
    first = {(r.doc_id, r.text) for r in linededup.remove_repeated_lines(docs).collect() if r.doc_id != 12}
    assert first == {x for x in text_of(docs) if x[0] != 12}
    assert linededup.remove_repeated_lines(docs).columns == docs.columns and linededup.line_counts(empty).isEmpty()
    lines = [f"l{i}".encode() for i in range(50)]
    ends = {lines[e - 1] for _, e in linededup.chunks(lines)}
    shifted = {([b"new", *lines])[e - 1] for _, e in linededup.chunks([b"new", *lines])}
    assert len(ends & shifted) >= len(ends) - 3


def test_jaccard(spark, docs, empty):
    words = [f"w{i}" for i in range(60)]
    more = [(200 + k, " ".join(words[: 60 - k] + [f"v{k}_{i}" for i in range(k)]), 1, 1, "") for k in range(0, 24, 3)]
    docs = docs.unionByName(spark.createDataFrame(more, SCHEMA))

    def shingles(t):
        w = (t or "").encode().lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    rows = [(r.doc_id if r.doc_id is not None else 1 << 62, shingles(r.text)) for r in docs.collect()]
    least = [i for i, _ in rows]  # by row: a shared or null id links nothing
    for _ in rows:
        for (x, (_, s)), (y, (_, t)) in itertools.combinations(enumerate(rows), 2):
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                least[x] = least[y] = min(least[x], least[y])
    got = by_id(jaccard.near_duplicates(docs), "n_shingles", "component_id")
    back = lambda i: None if i == 1 << 62 else i
    assert got == collections.Counter((back(i), len(s), back(c)) for (i, s), c in zip(rows, least, strict=True))
    assert jaccard.near_duplicates(empty).isEmpty()
    assert jaccard.keep_representatives(docs).columns == docs.columns


def test_decontamination(spark, docs, empty):
    items = spark.createDataFrame([(1, " ".join(PASSAGE.split()[:12])), (2, None), (3, ""), (4, "One!"), (4, "x"), (None, "shared1 shared2 shared3")], "item_id long, text string")
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

    def words(t):
        return word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    windows = [(r.item_id, tuple(w[k : k + 10])) for r in items.collect() if (w := words(r.text)) for k in range(max(1, len(w) - 9))]

    def expected(t):
        w = words(t)
        hit, found = set(), set()
        for item, p in windows:
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k : k + len(p)]) == p:
                    hit |= set(range(k, k + len(p)))
                    found |= {str(item)} if item is not None else set()
        return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)

    want = collections.Counter((r.doc_id, *expected(r.text)) for r in docs.collect())
    for block in (100_000, 2):
        assert by_id(decontaminate.contamination(docs, items, block=block), "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want
    clean = decontaminate.drop_contaminated(docs, items)
    assert clean.columns == docs.columns and clean.count() == sum(n for k, n in want.items() if not k[-1])
    assert decontaminate.contamination(empty, items).isEmpty() and not decontaminate.contamination(docs, items.limit(0)).filter("contaminated").count()


def test_bpe(docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)

    def expected(t):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()

    assert by_id(bpe.round_trip(docs, path), "n_tokens", "ids_sha256", "decoded_sha256") == collections.Counter((r.doc_id, *expected(r.text)) for r in docs.collect())
    assert bpe.encode_checked(docs, path).filter("not exact").isEmpty() and bpe.round_trip(empty, path).isEmpty()
    assert by_id(bpe.decode_documents(bpe.encode_documents(docs, path), path), "text") == collections.Counter((r.doc_id, r.text or "") for r in docs.collect())


def test_token_counts(docs, empty):
    path = public_tokenizers.path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    want = collections.Counter((r.doc_id, len((r.text or "").encode()), len(lib.encode(r.text or ""))) for r in docs.collect())
    assert by_id(tokencount.count_documents(docs, path), "n_bytes", "n_tokens") == want
    t = tokencount.Transducer(path)
    old, tokencount.CHUNK = tokencount.CHUNK, 7
    try:
        assert all(t.count(x or "") == len(lib.encode(x or "")) for x in TEXTS)
    finally:
        tokencount.CHUNK = old
    assert tokencount.count_documents(empty, path).isEmpty()


def test_html(spark):
    page = ("<html><head><title>t</title></head><body><nav><a href=x>menu</a></nav><article><h1>A &amp; b</h1><p>One <b>two\n three</b><p>short<script>x='</p>'</script></article>"
            "<div class='comments'><p>nice</p></div><footer>f</footer></body></html>")
    rows = [(1, "u", page), (1, "u", page), (None, None, None), (2, "u", ""), (3, "u", "a < b"), (4, "u", "<article><p>" + "long " * 50000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r.page_id, r.text) for r in html.extract_pages(pages).collect()}
    assert (1, "A & b\n\nOne two three\n\nshort") in got and (None, "") in got and (2, "") in got and (4, ("long " * 50000).strip()) in got
    assert html.extract_pages(pages).count() == len(rows) and html.extract_pages(pages.limit(0)).isEmpty()


def test_marginals_are_those_of_all_labellings():
    nodes, _ = html.parse("<body><div class=content><p>some words</p><ul><li>x</ul></div><footer>f</footer></body>")
    import math

    m = html.Model.fit({})
    total, share = 0.0, [0.0] * len(nodes)
    for y in itertools.product((0, 1), repeat=len(nodes)):
        w = math.log((0.9, 0.1)[y[0]])
        for k, v in enumerate(nodes):
            w += sum(m.node.get(f, (0, 0))[y[k]] for f in html.seen(v))
            if k:
                like = (f"{v.kind},{v.name}", "container,boiler" if v.name == "boiler" else f"{v.kind},none", "any")
                w += next(m.edge[x] for x in like if x in m.edge)[y[v.parent]][y[k]]
        total += math.exp(w)
        for k in range(len(nodes)):
            share[k] += math.exp(w) * y[k]
    assert m.marginals(nodes) == pytest.approx([s / total for s in share])


def test_pii(docs, empty):
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]

    def good(k, s):
        d = re.sub("[^0-9]", "", s)
        if k == 1:
            return all(int(x) <= 255 for x in s.split("."))
        if k == 2:
            return 12 <= len(d) <= 19 and sum(sum(divmod(int(x) * (1 + i % 2), 10)) for i, x in enumerate(reversed(d))) % 10 == 0
        return k == 0 or 9 <= len(d) <= 15

    def expected(t):
        found = sorted((m.start(), k, m.end()) for k, p in enumerate(patterns) for m in re.finditer(p, t or "") if good(k, m[0]))
        return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in found)

    got = by_id(pii.find_spans(docs).select("doc_id", pii.joined(F.col("base")).alias("base")), "base")
    assert got == collections.Counter((r.doc_id, expected(r.text)) for r in docs.collect())
    assert pii.find_spans(empty).isEmpty()


def test_boosting_separates():
    trees = pii.boost([(0b01, False, 50), (0b10, False, 50), (0b11, True, 40), (0b00, False, 60)], 2)
    assert pii.scored(trees, 0b11) > 0 > max(pii.scored(trees, p) for p in (0, 1, 2))
    assert pii.scored(trees, 0b11) >= pii.threshold(trees, [(0b11, True, 10), (0b01, False, 10)]) > pii.scored(trees, 0b01)


def test_quotations(spark):
    rows = [(1, 0, "user", "Hello there\nsecond line"), (1, 1, "assistant", "> Hello   THERE\nanswer"), (1, 2, "user", ">> hello there\n> answer\nmore"), (1, 3, "user", "> never said\nx"),
            (1, 1, "assistant", "> Hello   THERE\nanswer"), (2, 0, "user", None), (None, 0, "user", "> Hello there"), (3, 5, "user", "")]
    talk = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = collections.Counter((r.conv_id, r.turn, r.parent_turn, r.thread, r.depth, r.text) for r in chat.reply_order(talk).collect())
    assert got == collections.Counter([(1, 0, None, 0, 0, "Hello there\nsecond line"), (1, 1, 0, 0, 1, "answer"), (1, 1, 0, 0, 1, "answer"), (1, 2, 1, 0, 2, "more"), (1, 3, None, 3, 0, "x"),
                                       (2, 0, None, 0, 0, ""), (None, 0, None, 0, 0, ""), (3, 5, None, 5, 0, "")])
    assert chat.reply_order(talk.limit(0)).isEmpty()


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert 0 < out.count() < docs.count() and out.filter("not exact").isEmpty()
    d = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        d = stage(spark, d, sf)
        assert d.isEmpty()


def test_suffix_moves_no_text_key_where_ids_are_unique(spark):
    passage = "abcdefghij" * 12
    for rows, unique in ([(1, passage), (2, "x " + passage)], True), ([(1, passage), (1, "x " + passage)], False):
        out = suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert ("xxhash64(coalesce(text" in plan) != unique and "lane#" not in plan
        assert sum(r.n_removed > 0 for r in out.collect()) == 2
