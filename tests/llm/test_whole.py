"""Cases in which an operator did less than its whole job."""

import collections
import itertools
import random
import re

import numpy as np

from regisight.llm import chat, jaccard, linededup

SCHEMA = "doc_id long, text string"


def test_jaccard_null_and_shared_ids_link_nothing(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(12)) for k in "abc")
    rows = [(1, a), (2, b), (None, a + " more"), (None, b), (3, a), (3, c), (None, "alone with no id at all"), (4, " "), (4, None)]
    got = collections.Counter((r.doc_id, r.component_id) for r in jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == collections.Counter([(1, 1), (2, 2), (None, 1), (None, 2), (3, 1), (3, 3), (None, None), (4, 4), (4, 4)])


def test_jaccard_pairs_leave_one_of_their_cells(spark):
    """Members of two components that share 60 groups, in several blocks, with lists shorter than the groups: each pair once."""
    same = jaccard.parity(np.arange(1, 101, dtype=np.uint64))
    members = [(g, x, 100 + x % 7, 3000, x % 2) for g in range(60) for x in range(24) if g != x]
    m = spark.createDataFrame(members, "gid long, x long, n long, m long, c long")
    bits = spark.createDataFrame([(x, 100 + x % 7, same) for x in range(24)], "x long, n long, bits binary")
    got = [(r.a, r.b) for r in jaccard._cells(m, bits, 75).collect()]
    assert sorted(got) == [(a, b) for a in range(24) for b in range(a + 1, 24) if a % 2 != b % 2]


def test_jaccard_of_few_words_alone(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    assert len(long) > 1 << 20
    rows = [(1, "a b"), (2, long), (3, "c d e"), (4, long + " end"), (5, "A  B")]
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect())
    assert got == collections.Counter([(1, 1, 1), (2, 199_996, 2), (3, 1, 3), (4, 199_997, 2), (5, 1, 1)])
    for text in (b"a b", b"c d e"):
        assert [len(x) for x in jaccard.shingle_sets(np.frombuffer(text, np.uint8), np.array([0, len(text)]))] == [1]


def test_jaccard_equal_groups_of_buckets_become_rows_once(spark, monkeypatch):
    """Documents that share passages meet in every bucket: their groups are stored once, those of one smallest document united."""
    kept = collections.defaultdict(list)
    write = jaccard.materialise

    def watched(df, name):
        kept[name].append(write(df, name))
        return kept[name][-1]

    monkeypatch.setattr(jaccard, "materialise", watched)
    monkeypatch.setattr(jaccard, "BUCKET_TOKENS", 40)
    passages = [[f"p{k}_{i}" for i in range(40)] for k in range(4)]
    texts = {d: [f"own{d}_{i}" for i in range(70)] + passages[d % 4] + passages[(d // 4) % 4] for d in range(24)}
    texts |= {100: texts[0][:-1], 101: texts[5], 102: [*texts[7], "end"]}
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in texts.items()], SCHEMA)
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
    assert got == {d: {100: 0, 101: 5, 102: 7}.get(d, d) for d in texts}
    groups = collections.defaultdict(set)
    for r in kept["members"][0].collect():
        groups[r.gid].add(r.x)
    assert len(groups) > 4 and len({frozenset(g) for g in groups.values()}) == len(groups)
    shared = kept["groups"][1]
    united = collections.defaultdict(set)
    for r in shared.collect():
        united[r.gid].add(r.x)
    pairs = lambda of: {p for g in of.values() for p in itertools.combinations(sorted(g), 2)}
    assert pairs(groups) <= pairs(united) and shared.count() < sum(map(len, groups.values()))


def test_jaccard_groups_of_little_in_common_stay_apart(spark):
    """A document that is the smallest of many groups without other common members doesn't unite them; near equal groups are united."""
    rows = [(g, x) for g in range(30) for x in [1, *range(100 * g + 10, 100 * g + 15)]]
    rows += [(g, x) for g in range(50, 60) for x in [2, *range(5000, 5020)] if x != 5000 + g - 50]
    got = collections.defaultdict(set)
    for r in jaccard._merged_groups(spark.createDataFrame([(g, x, 50) for g, x in rows], "gid long, x long, n long")).collect():
        got[r.gid].add(r.x)
    want = {frozenset([1, *range(100 * g + 10, 100 * g + 15)]) for g in range(30)} | {frozenset([2, *range(5000, 5020)])}
    assert {frozenset(g) for g in got.values()} == want and len(got) == 31


def test_jaccard_bitmaps_are_as_wide_as_the_bound_needs():
    """Never more bits than 3.2 for a shingle above 40, and unrelated sets of one or two steps of sizes stay apart when they are folded."""
    rng = np.random.default_rng(5)
    for n in (45, 100, 255, 256, 300, 1000, 5000):
        for m in (n, n * 5 // 4, n * 4 // 3):
            s, t = (rng.integers(0, 1 << 63, k).astype(np.uint64) for k in (n, m))
            assert 8 * len(jaccard.parity(s)) <= 3.2 * n and not jaccard.may_link(jaccard.parity(s), jaccard.parity(t), n, m, 75)
            near = np.concatenate([s[: n - n // 10], t[: n // 20]])
            assert jaccard.may_link(jaccard.parity(s), jaccard.parity(near), n, len(near), 75)


def without_repeats(rows):
    """Brute force of line dedup for distinct ids: lines of a pair that an earlier place has, pairs skip blank lines."""
    first, out = {}, {}
    for i, text in sorted(rows):
        lines = text.split("\n")
        full = [k for k, x in enumerate(lines) if x.strip()]
        gone = set()
        for a, b in zip(full, full[1:]):
            place = first.setdefault("\n".join(lines[a : b + 1]), (i, a, b))
            if place != (i, a, b) and not (place[0] == i and a <= place[2]):
                gone |= set(range(a, b + 1))
        for k in range(len(lines)):
            if not lines[k].strip() and gone:
                above, below = [x for x in full if x < k], [x for x in full if x > k]
                if (not above or above[-1] in gone) and (not below or below[0] in gone):
                    gone.add(k)
        out[i] = (len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def test_line_dedup_finds_every_repeated_run(spark):
    own = lambda k, n: [f"own line {k} {j} of this document" for j in range(n)]
    source = [f"passage line {j} of the source" for j in range(30)]
    rows = [(0, "\n".join(source))]
    for k, (a, n) in enumerate([(0, 2), (3, 2), (5, 3), (9, 2), (12, 4), (17, 2), (20, 3), (28, 2), (11, 1), (0, 30), (0, 29)], 1):
        rows.append((k, "\n".join(own(k, k % 4) + source[a : a + n] + own(-k, (k + 1) % 3))))
    rows += [(20, "a\nb\na\nb\na"), (21, "z\nz\nz\nz\nz"), (22, "p\n\nq\n\n\nr"), (23, "x\np\n\nq\n"), (24, "\np\n\nq\n\n\nr\n \n"), (25, ""), (26, "\n\n"), (27, "\n\n"), (12, rows[0][1])]
    want = without_repeats(rows)
    assert [want[k][0] for k in (1, 2, 3, 8, 9, 10, 11)] == [2, 2, 3, 2, 0, 30, 29] and want[12] == (30, "")
    got = {r.doc_id: (r.n_removed_lines, r.text) for r in linededup.line_counts(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert got == want


def parents(rows):
    """Brute force of quotation linking: (conv_id, turn) -> parent, one text per turn."""
    def lines_of(text):
        cut = [re.match(r"^\s*(?:>\s?)+", x) for x in text.split("\n")]
        levels = [m[0].count(">") if m else 0 for m in cut]
        bodies = [" ".join(x[m.end() if m else 0 :].lower().split()) for x, m in zip(text.split("\n"), cut)]
        for lev, run in itertools.groupby(zip(levels, bodies), key=lambda x: x[0]):
            run = [b for _, b in run]
            whole = " ".join(b for b in run if b)
            for full, part in itertools.groupby(run, key=bool):
                part = list(part)
                if full:
                    for b in part:
                        yield lev, b, {b, " ".join(part), whole}

    out = {}
    for c, t, text in rows:
        mine = collections.defaultdict(set)
        for lev, b, keys in lines_of(text):
            if lev:
                mine[lev, b] |= keys
        votes = []
        for c2, p, other in rows:
            if c2 == c and p < t:
                held = set().union(*(k for lev, _, k in lines_of(other) if not lev))
                hit = [lev for (lev, _), k in mine.items() if k & held]
                if hit:
                    votes.append((hit.count(1), len(hit), p))
        out[c, t] = max(votes)[2] if votes else None
    return out


def test_quotations_by_most_lines(spark):
    rows = [(1, 0, "text\nRegards\nBob"), (1, 1, "other\nRegards\nBob"), (1, 2, "> text\n> Regards\n> Bob\nfine"),
            (2, 0, "a long line that the mail client\nwraps\n\nnext"), (2, 1, "wraps\nnext to it"), (2, 2, "> a long line that\n> the mail client wraps\nyes"), (2, 3, "> Regards\nno")]
    pick = random.Random(5)
    said = [f"s{k}" for k in range(12)] + ["Regards", "Bob", "a b", "b", "a"]
    for c in range(3, 9):
        texts = []
        for t in range(9):
            quote = []
            for other in pick.sample(texts, min(len(texts), pick.randint(0, 2))):
                flat = " ".join(other).split() if pick.random() < 0.3 else other
                at = pick.randint(0, max(0, len(flat) - 1))
                quote += ["> " * (1 + pick.randint(0, 1)) + x if x else ">" for x in flat[at : at + pick.randint(1, 6)]]
            own = [pick.choice([*said, ""]) for _ in range(pick.randint(1, 4))] + ["Regards", "Bob"]
            texts.append(own)
            rows.append((c, t, "\n".join(quote + own)))
    want = parents(rows)
    assert want[1, 2] == 0 and want[2, 2] == 0 and want[2, 3] is None and sum(p is not None for p in want.values()) > 30
    talk = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): r.parent_turn for r in chat.reply_order(talk).select("conv_id", "turn", "parent_turn").collect()}
    assert got == want


def test_representatives_by_row(spark):
    words = [f"w{i}" for i in range(60)]
    near = " ".join([*words[:58], "x", "y"])
    rows = [(1, " ".join(words), "a"), (None, near, "b"), (None, "an unrelated text of its own", "c"), (None, "another one that nobody else has", "d"), (5, "first text of a shared id", "e"),
            (5, "and the second text of it", "f"), (7, "in full the same row here", "g"), (7, "in full the same row here", "g"), (None, "a copy under two null ids", "h"), (None, "a copy under two null ids", "h"),
            (9, "IN FULL the same row here", "i"), (None, None, "j"), (None, "", "k"), (3, " ", "l"), (3, " ", "l")]
    docs = spark.createDataFrame(rows, SCHEMA + ", source string").repartition(3)
    kept = jaccard.keep_representatives(docs)
    assert kept.columns == docs.columns and sorted(r.source for r in kept.collect()) == list("acdefghjkll")


def test_pipeline_drops_whole_repeats(spark):
    import corpus_pipeline

    text = "\n".join(f"line {k} of a text that is copied" for k in range(6))
    docs = spark.createDataFrame([(1, text, 5), (2, text, 5), (3, "own\n" + text, 5), (4, "one line", 5), (5, None, 5), (6, "", 5)], SCHEMA + ", n_chars long")
    out = {(r.doc_id, r.text, r.n_chars) for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert out == {(1, text, len(text)), (3, "own", 3), (4, "one line", 8), (5, None, None), (6, "", 0)}
