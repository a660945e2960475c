"""Personal data by boosted trees over candidate spans (native).

Base spans come from four formats with exact checks. Besides, generators of high recall propose overlapping
candidate spans (anything like an address, a dotted or grouped number, an assigned secret). Each candidate is
described by yes/no features of its format and of the characters before it, packed into one integer. A
histogram over all candidates of the corpus (2^14 patterns at most, whatever the input's size) trains boosted trees
of depth two on weak labels: a candidate that passes an exact check of its format is personal. One half of the
documents trains, the other half calibrates: the threshold is the lowest score at which the held-out candidates
above it are personal at the wanted precision. The trees are compiled into one SQL expression. Everything on the
data is a DataFrame expression; the driver sees the histogram only.

Candidates that reach the threshold and don't overlap a base span are added to the base spans.

Defined results: a null text is empty and has no spans; matches are leftmost and non-overlapping per kind; offsets
are code points, the end exclusive; repeated rows are judged each by itself; an empty table gives an empty table;
other columns are ignored. Patterns are possessive, so digit or letter runs of any length take linear time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regisight.llm.common import materialise

KINDS = ("email", "ip", "card", "phone")
_RUN = "[A-Za-z0-9._%+-]"
#: The base formats (possessive forms of the stated patterns that match the same strings).
BASE = {
    "email": rf"(?:\G|(?<!{_RUN})){_RUN}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must contain for the pattern to be tried at all.
NEEDS = {"email": "@", "phone": "+"}
#: Candidate generators: kind reported for an added span, pattern.
GENERATORS = {
    "email": r"(?<![^\s<>\"'(),;])[^\s@<>\"'(),;]++@[^\s@<>\"'(),;]++",
    "number": r"(?<![0-9A-Za-z])[+(]?[0-9](?:[ ().-]{0,2}[0-9]){6,40}+(?![0-9A-Za-z])",
    "ip": r"(?<![0-9.])[0-9]++(?:\.[0-9]++){2,5}+",
    "secret": r"(?i)\b(?:token|key|secret|password|passwd|pwd)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9+/_-]{6,200}+",
}
ROUNDS, RATE, PRECISION = 30, 0.5, 0.95
CONTEXT = 24
_BLOCK = 64


def _sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda a, x: a + x)


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _found(text: Column, pattern: str, kind: int) -> Column:
    """Matches as structs (start, kind, end, s). Starts are running sums of the lengths of gaps and matches,
    taken over blocks of a fixed size, so that many matches in one text stay cheap."""

    def build(gaps: Column, hits: Column) -> Column:
        steps = F.transform(hits, lambda h, i: F.length(h) + F.length(F.get(gaps, i)))

        def placed(lens: Column) -> Column:
            blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(lens) / _BLOCK).cast("int")), lambda k: _sum(F.slice(lens, k * _BLOCK + 1, _BLOCK)))
            return _let(blocks, lambda bs: F.transform(hits, lambda h, i: _let(
                _sum(F.slice(bs, F.lit(1), F.floor(i / _BLOCK).cast("int"))) + _sum(F.slice(lens, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK)) + F.length(F.get(gaps, i)),
                lambda start: F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(h)).alias("end"), h.alias("s")))))

        return _let(steps, placed)

    empty = F.array().cast("array<struct<start:int,kind:int,end:int,s:string>>")
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(F.rlike(text, F.lit(pattern)), _let(F.split(text, pattern, -1), lambda g: _let(hits, lambda h: build(g, h)))).otherwise(empty)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _octets(s: Column) -> Column:
    return F.forall(F.split(s, "\\."), lambda p: _let(F.ltrim(p, F.lit("0")), lambda q: (F.length(q) < 3) | ((F.length(q) == 3) & (q <= "255"))))


def _luhn(s: Column) -> Column:
    """Doubling every second digit from the right, digit sums add up to a multiple of ten."""
    values = F.transform(F.split(F.reverse(_digits(s)), ""), lambda c, i: _let(F.coalesce(c.cast("int"), F.lit(0)) * (1 + i % 2), lambda v: v - F.when(v > 9, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def _passes(kind: str, s: Column) -> Column:
    n = F.length(_digits(s))
    return {"email": F.lit(True), "ip": _octets(s), "card": n.between(12, 19) & F.when(n.between(12, 19), _luhn(s)), "phone": n.between(9, 15)}[kind]


def _valid(kind: str):
    return lambda x: F.coalesce(_passes(kind, x["s"]), F.lit(False))


def base_spans(text: Column) -> Column:
    """All base spans by start, then kind."""
    parts = []
    for k, kind in enumerate(KINDS):
        hits = F.filter(_found(text, BASE[kind], k), _valid(kind))
        parts.append(F.when(F.contains(text, F.lit(NEEDS[kind])), hits).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int,s:string>>")) if kind in NEEDS else hits)
    return F.sort_array(F.concat(*parts))


def _features(text: Column, start: Column, s: Column) -> dict[str, Column]:
    """Yes/no features of a candidate; at most 14 of them."""
    before = F.lower(F.substring(text, F.greatest(start - CONTEXT + 1, F.lit(1)), F.least(start, F.lit(CONTEXT))))
    n = F.length(_digits(s))
    return {
        "at": F.contains(s, F.lit("@")),
        "host": F.rlike(s, F.lit(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}\W*$")),
        "plus": F.startswith(s, F.lit("+")),
        "dots": F.rlike(s, F.lit(r"^[0-9]+(?:\.[0-9]+){3}$")),
        "octets": F.rlike(s, F.lit(r"^[0-9.]+$")) & F.contains(s, F.lit(".")) & _octets(s),
        "digits_phone": n.between(9, 15),
        "digits_card": n.between(12, 19),
        "luhn": F.coalesce(F.when(n.between(12, 19), _luhn(s)), F.lit(False)),
        "groups": F.rlike(s, F.lit(r"[0-9][ ().-]+[0-9]")),
        "assigned": F.rlike(s, F.lit("[=:]")),
        "long_mixed": F.rlike(s, F.lit(r"(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{12,}")),
        "said": F.rlike(before, F.lit(r"(tel|phone|call|mobile|mail|contact|card|visa|iban|account|host|ip|token|key|secret)\W{0,4}$")),
    }


def _weak_label(s: Column) -> Column:
    """Whether a candidate as a whole passes an exact check of its format."""
    whole = [F.rlike(s, F.lit(f"^(?:{BASE[k]})$")) & F.coalesce(_passes(k, s), F.lit(False)) for k in KINDS]
    secret = F.rlike(s, F.lit(r"[=:]\s{0,3}[\"']?(?=[A-Za-z0-9+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}"))
    return whole[0] | whole[1] | whole[2] | whole[3] | secret


def candidates(text: Column) -> Column:
    """Proposed spans as structs (start, kind, end, pattern, label); kind is the generator's number."""

    def described(x: Column) -> Column:
        bits = F.lit(0)
        for i, f in enumerate(_features(text, x["start"], x["s"]).values()):
            bits = bits + F.when(f, 1 << i).otherwise(0)
        return F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), bits.alias("pattern"), _weak_label(x["s"]).alias("label"))

    return F.transform(F.concat(*(_found(text, p, k) for k, p in enumerate(GENERATORS.values()))), described)


def boost(histogram: list[tuple[int, bool, int]], n_features: int, rounds: int = ROUNDS, rate: float = RATE) -> list[tuple[int, int, tuple[float, float, float, float]]]:
    """Gradient boosting with logistic loss over (pattern, label, count): trees (bit a, bit b, leaf values for
    a,b = 00, 01, 10, 11)."""
    score = {p: 0.0 for p, _, _ in histogram}
    trees = []
    for _ in range(rounds):
        best = None
        stats = []
        for p, y, n in histogram:
            q = 1 / (1 + math.exp(-score[p]))
            stats.append((p, n * (y - q), n * q * (1 - q)))
        for a in range(n_features):
            for b in range(a, n_features):
                g, h = [0.0] * 4, [1.0] * 4
                for p, x, w in stats:
                    k = 2 * (p >> a & 1) + (p >> b & 1)
                    g[k] += x
                    h[k] += w
                gain = sum(x * x / w for x, w in zip(g, h, strict=True))
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, a, b, tuple(rate * x / w for x, w in zip(g, h, strict=True)))
        if best is None or best[0] < 1e-9:
            break
        _, a, b, leaves = best
        trees.append((a, b, leaves))
        for p in score:
            score[p] += leaves[2 * (p >> a & 1) + (p >> b & 1)]
    return trees


def scored(trees, pattern):
    """Score of a pattern: a Column for a Column, a number for a number."""
    if isinstance(pattern, int):
        return sum(leaves[2 * (pattern >> a & 1) + (pattern >> b & 1)] for a, b, leaves in trees)
    total = F.lit(0.0)
    for a, b, leaves in trees:
        has = [pattern.bitwiseAND(F.lit(1 << k)) != 0 for k in (a, b)]
        total = total + F.when(has[0], F.when(has[1], leaves[3]).otherwise(leaves[2])).otherwise(F.when(has[1], leaves[1]).otherwise(leaves[0]))
    return total


def threshold(trees, held_out: list[tuple[int, bool, int]], precision: float = PRECISION) -> float:
    """The lowest score at which held-out candidates at or above it reach the precision."""
    by: dict[float, list[int]] = {}
    for p, y, n in held_out:
        by.setdefault(round(scored(trees, p), 9), [0, 0])[bool(y)] += n
    best, good, bad = math.inf, 0, 0
    for s in sorted(by, reverse=True):
        bad, good = bad + by[s][0], good + by[s][1]
        if good >= precision * (good + bad):
            best = s
    return best


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", precision: float = PRECISION) -> DataFrame:
    """Per row: doc_id, base and added, arrays of structs (start, kind, end, name)."""
    flat = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    some = F.rlike(text, F.lit("[0-9@]|(?i:token|key|secret|passw|pwd)"))
    found = materialise(flat.select(
        "doc_id", F.when(some, base_spans(text)).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int,s:string>>")).alias("base"),
        F.when(some, candidates(text)).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int,pattern:int,label:boolean>>")).alias("cands")), "spans")
    rows = (found.select(F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("half"), F.explode("cands").alias("c"))
            .groupBy("half", "c.pattern", "c.label").agg(F.count(F.lit(1)).alias("n")).collect())  # 2^15 x 2 rows at most
    rows.sort()
    halves = [[(r[1], bool(r[2]), r[3]) for r in rows if r[0] == h] for h in (0, 1)]
    n_features = len(_features(F.lit(""), F.lit(0), F.lit("")))
    trees = boost(halves[0], n_features)
    least = threshold(trees, halves[1], precision) if trees else math.inf
    names = list(GENERATORS)

    def free(base: Column):
        return lambda c: (scored(trees, c["pattern"]) >= least - 1e-9) & ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))

    name = lambda k, of: F.element_at(F.array(*map(F.lit, of)), k + 1)
    base = F.transform("base", lambda b: F.struct(b["start"], b["kind"], b["end"], name(b["kind"], KINDS).alias("name")))
    chosen = F.filter("cands", free(F.col("base"))) if least < math.inf else F.slice("cands", 1, 0)
    added = F.transform(chosen, lambda c: F.struct(c["start"], (c["kind"] + len(KINDS)).alias("kind"), c["end"], name(c["kind"], names).alias("name")))
    return found.select("doc_id", base.alias("base"), F.array_distinct(added).alias("added"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["name"], x["start"].cast("string"), x["end"].cast("string"))), ",")
