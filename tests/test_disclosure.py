import random
from fractions import Fraction
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from regisight.operators import disclosure as D


def expected_status(cells, threshold):
    """Slow restatement of the suppression rules for one breakdown: {code: status}."""
    total = sum(v for _, v, _ in cells if v > 0)
    out = {}
    if total < threshold:
        return {c: ("zero" if v <= 0 else "hidden") for c, v, _ in cells}
    small = {c for c, v, _ in cells if 0 < v < threshold}
    if small and sum(v for c, v, _ in cells if c in small) < threshold:
        large = sorted((p, v, c) for c, v, p in cells if v >= threshold)
        small = small | {large[0][2]}
    for c, v, _ in cells:
        out[c] = "zero" if v <= 0 else "other" if c in small else "published"
    return out


def test_random_breakdowns(spark):
    rng = random.Random(7)
    rows = []
    for g in range(1500):
        for i in range(rng.randint(1, 8)):
            rows.append((g, f"c{i}", rng.choice([0, 1, 2, 5, 9, 10, 11, rng.randint(0, 300)]), rng.random() < 0.3))
    df = spark.createDataFrame(rows, "g int, code string, value int, guard boolean")
    got = {}
    for r in D.suppress(df, ["g"], protected="guard").collect():
        got.setdefault(r.g, {})[r.code] = r.status
    for g, part in groupby(rows, key=lambda r: r[0]):
        cells = [(c, v, p) for _, c, v, p in part]
        assert got[g] == expected_status(cells, 10), cells
        other = [v for c, v, _ in cells if got[g][c] == "other"]
        assert not other or (len(other) >= 2 and sum(other) >= 10)


def test_breakdown_of_a_third_of_all_rows(spark):
    """One hot breakdown with very many cells next to small ones."""
    hot = spark.range(30000).select(F.lit("hot").alias("g"), F.col("id").cast("string").alias("code"), (F.col("id") % 7 + 1).alias("value"))
    cold = spark.range(60000).select((F.col("id") % 20000).cast("string").alias("g"), F.col("id").cast("string").alias("code"), F.lit(12).cast("bigint").alias("value"))
    s = D.suppress(hot.unionByName(cold), ["g"])
    counts = {r.status: r["count"] for r in s.groupBy("status").count().collect()}
    assert counts == {"other": 30000, "published": 60000}


def relations(spark, rows):
    return spark.createDataFrame([("r", k, v, c) for k, v, c in rows], "report_id string, rel_id string, var string, coef int")


def cells(spark, published, hidden):
    rows = [("r", v, 1, True, True) for v in published] + [("r", v, 1, False, True) for v in hidden]
    return spark.createDataFrame(rows, "report_id string, var string, value int, published boolean, protect boolean")


@pytest.mark.parametrize("rel, published, hidden, found", [
    # a lone hidden part of a published total
    ([("t", "t", -1), ("t", "a", 1), ("t", "b", 1)], ["t", "a"], ["b"], ["b"]),
    # two hidden parts merged into a published "other"
    ([("t", "t", -1), ("t", "a", 1), ("t", "b", 1), ("t", "c", 1), ("o", "o", -1), ("o", "b", 1), ("o", "c", 1)], ["t", "a", "o"], ["b", "c"], []),
    # a leak across tables: f1 + f2 = fo, p1 + p2 = po, fo + po = t, f1 + p1 = x
    ([("fo", "fo", -1), ("fo", "f1", 1), ("fo", "f2", 1), ("s", "s", -1), ("s", "f2", 1), ("s", "p1", 1), ("po", "po", -1), ("po", "p1", 1), ("po", "p2", 1)],
     ["fo", "f1", "s", "po", "p2"], ["f2", "p1"], ["f2", "p1"]),
    # chained: knowing b gives c
    ([("1", "t", -1), ("1", "a", 1), ("1", "b", 1), ("2", "u", -1), ("2", "b", 1), ("2", "c", 1)], ["t", "a", "u"], ["b", "c"], ["b", "c"]),
    # a hidden total over published parts
    ([("t", "t", -1), ("t", "a", 1), ("t", "b", 1)], ["a", "b"], ["t"], ["t"]),
    # classification change: both + left and both + joined published only as sums
    ([("a", "n08", -1), ("a", "both", 1), ("a", "left", 1), ("b", "n25", -1), ("b", "both", 1), ("b", "joined", 1)], ["n08", "n25"], ["both", "left", "joined"], []),
])
def test_recomputation(spark, rel, published, hidden, found):
    c, r = cells(spark, published, hidden), relations(spark, rel)
    assert sorted(x.var for x in D.derivable_exactly(c, r).collect()) == sorted(found)
    assert sorted(x.var for x in D.derivable_by_substitution(c, r).collect()) == sorted(found)


def test_only_elimination_finds_combined_relations(spark):
    """a + b and a - b are known: no relation has a single unknown, yet both follow."""
    rel = relations(spark, [("1", "s", -1), ("1", "a", 1), ("1", "b", 1), ("2", "d", -1), ("2", "a", 1), ("2", "b", -1)])
    c = cells(spark, ["s", "d"], ["a", "b"])
    assert D.derivable_by_substitution(c, rel).count() == 0
    assert sorted(x.var for x in D.derivable_exactly(c, rel).collect()) == ["a", "b"]


def rank(rows):
    rows, r = [list(map(Fraction, x)) for x in rows], 0
    for col in range(len(rows[0]) if rows else 0):
        pivot = next((i for i in range(r, len(rows)) if rows[i][col]), None)
        if pivot is None:
            continue
        rows[r], rows[pivot] = rows[pivot], rows[r]
        for i in range(len(rows)):
            if i != r and rows[i][col]:
                k = rows[i][col] / rows[r][col]
                rows[i] = [a - k * b for a, b in zip(rows[i], rows[r])]
        r += 1
    return r


def test_exact_audit_against_rank(spark):
    rng = random.Random(3)
    rel_rows, cell_rows, want = [], [], set()
    for rep in range(40):
        names = [f"v{i}" for i in range(7)]
        published = {n for n in names if rng.random() < 0.4}
        system = []
        for k in range(rng.randint(1, 5)):
            row = {n: rng.choice([-1, 1, 2]) for n in names if rng.random() < 0.5}
            system.append(row)
            rel_rows += [(f"r{rep}", f"k{k}", n, c) for n, c in row.items()]
        hidden = [n for n in names if n not in published]
        matrix = [[row.get(n, 0) for n in hidden] for row in system]
        for i, n in enumerate(hidden):
            unit = [1 if j == i else 0 for j in range(len(hidden))]
            if hidden and rank(matrix + [unit]) == rank(matrix):
                want.add((f"r{rep}", n))
        cell_rows += [(f"r{rep}", n, 1, n in published, True) for n in names]
    c = spark.createDataFrame(cell_rows, "report_id string, var string, value int, published boolean, protect boolean")
    r = spark.createDataFrame(rel_rows, "report_id string, rel_id string, var string, coef int")
    assert {(x.report_id, x["var"]) for x in D.derivable_exactly(c, r).collect()} == want


def test_conflicting_values_are_reported(spark):
    df = spark.createDataFrame([("r", "a", 1), ("r", "a", 2), ("r", "b", 3), ("r", "b", 3)], "report_id string, var string, value int")
    assert [x["var"] for x in D.value_conflicts(df).collect()] == ["a"]
