import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from regisight.functions import fixed as X
from regisight.operators import disclosure as D
from regisight.operators import estimates as E
from regisight.operators import findings as K
from regisight.operators import textcheck as V
from regisight.plans import report as P
from regisight.plans import proxy

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def built(spark):
    return P.build(proxy.subjects(spark, SF), proxy.territories(spark, SF), proxy.population(spark, SF), "section", F.lit(proxy.SNAPSHOT), 1998, 2001)


def test_nothing_hidden_can_be_recomputed(spark, built):
    assert P.audit(built).count() == 0
    assert D.value_conflicts(built.cells).count() == 0


def test_published_counts_reach_the_threshold_and_findings_are_unique(spark, built):
    counts = built.tables.filter(F.col("indicator").isin("REG_POCET", "STRUKTURA_POCET", "ZANIK_PO_STAV", "ZANIK_PO_RES"))
    assert counts.count() > 100 and counts.filter(F.col("value") < 10).count() == 0
    assert built.cells.filter(F.col("published") & (F.col("value") > 0) & (F.col("value") < 10)).count() == 0
    assert K.duplicate_ids(built.findings, ["report_id", "territory"]).count() == 0
    assert built.findings.filter(F.col("strength") < 0.03).filter("NOT coalesce(territory_effect, false)").count() == 0
    assert built.refused.filter("n >= 100").count() == 0


def test_an_injected_leak_is_found(spark, built):
    hidden = built.cells.filter(~F.col("published") & F.col("protect") & (F.col("value") > 0)).orderBy("report_id", "var").first()
    rel = built.relations.filter((F.col("report_id") == hidden.report_id) & (F.col("var") == hidden["var"]) & (F.col("coef") == 1)).first()
    members = [r["var"] for r in built.relations.filter((F.col("report_id") == hidden.report_id) & (F.col("rel_id") == rel.rel_id)).collect()]
    leaking = built.cells.withColumn("published", F.when(
        (F.col("report_id") == hidden.report_id) & F.col("var").isin([m for m in members if m != hidden["var"]]), True).otherwise(F.col("published")))
    found = {(r.report_id, r["var"]) for r in D.derivable_exactly(leaking, built.relations).collect()}
    assert (hidden.report_id, hidden["var"]) in found


def test_a_leak_between_two_reports_is_found(spark, built):
    """A number that one report hides and another one shows, and one that follows from both only."""
    hidden = built.cells.join(built.same, ["report_id", "var"]).filter(~F.col("published") & F.col("protect") & (F.col("value") > 0)).orderBy("name", F.length("report_id"))
    one = hidden.filter("report_id NOT LIKE '%@%'").first()
    at = lambda r: (F.col("report_id") == r[0]) & (F.col("var") == r[1])
    detail = hidden.filter((F.col("name") == one.name) & (F.col("report_id") != one.report_id)).first()
    leaking = built.cells.withColumn("published", F.col("published") | at(detail))
    found = {(r.report_id, r["var"], r.leak) for r in D.derivable_jointly(leaking, built.relations, built.same, built.across).collect()}
    assert (one.report_id, one["var"], D.ELSEWHERE) in found
    assert (one.report_id, one["var"]) not in {(r.report_id, r["var"]) for r in D.derivable_exactly(leaking, built.relations).collect()}  # no single report tells
    from dataclasses import replace

    with pytest.raises(P.ReleaseRefused):
        P.save(replace(built, cells=leaking), "/tmp/not-written/public", "/tmp/not-written/internal")


def test_relations_across_reports(spark):
    cells = spark.createDataFrame([("a", "x", 3, False, True), ("a", "y", 9, True, True), ("a", "t", 12, False, False), ("b", "x", 4, True, True), ("b", "t", 12, True, False),
                                   ("c", "z", 5, False, True)], "report_id string, var string, value int, published boolean, protect boolean")
    relations = spark.createDataFrame([("a", "sum", "x", 1), ("a", "sum", "y", 1), ("a", "sum", "t", -1)], "report_id string, rel_id string, var string, coef int")
    same = spark.createDataFrame([("a", "t", "T"), ("b", "t", "T"), ("c", "z", "Z")], "report_id string, var string, name string")
    leaks = lambda across=None: sorted(map(tuple, D.derivable_jointly(cells, relations, same, across).collect()))
    assert leaks() == [("a", "x", D.DERIVABLE)]  # b shows the total that a hides
    across = spark.createDataFrame([("r", "Z", 1), ("r", "T", -1), ("r", "a#y", 1)], "rel_id string, var string, coef int")
    assert leaks(across) == [("a", "x", D.DERIVABLE), ("c", "z", D.DERIVABLE)]
    assert leaks(across.unionByName(spark.createDataFrame([("r", "unknown rest", 1)], across.schema))) == [("a", "x", D.DERIVABLE)]
    assert D.joint_conflicts(cells, same).isEmpty() and D.joint_conflicts(cells.withColumn("value", F.when(F.col("report_id") == "b", 13).otherwise(F.col("value"))), same).count() == 1


def test_elimination_against_matrix_rank():
    from fractions import Fraction

    import numpy as np

    rng = random.Random(9)
    for _ in range(200):
        n, m = rng.randint(1, 7), rng.randint(1, 6)
        a = [[rng.choice([0, 0, 1, 1, -1, 2]) for _ in range(n)] for _ in range(m)]
        rows = [{f"v{j}": Fraction(x) for j, x in enumerate(r) if x} for r in a]
        rank = np.linalg.matrix_rank(np.array(a))
        want = [f"v{j}" for j in range(n) if np.linalg.matrix_rank(np.array([*a, [int(j == k) for k in range(n)]])) == rank]
        assert D._determined(rows, [f"v{j}" for j in range(n)]) == want


def test_outputs_keep_internal_variables_apart(spark, built, folder):
    with pytest.raises(ValueError):
        P.save(built, folder, f"{folder}/internal")
    P.save(built, f"{folder}/public", f"{folder}/internal")
    assert sorted(os.listdir(f"{folder}/public")) == ["findings", "tables"] and sorted(os.listdir(f"{folder}/internal")) == ["cells", "relations"]
    assert spark.read.json(f"{folder}/public/tables").count() == built.tables.count()


# --- estimates --------------------------------------------------------------------------------------

def test_size_classes(spark):
    rows = [("101", "110"), ("101", "110"), ("101", "210"), ("101", "000"), ("112", "220"), ("112", "510"), ("112", None), ("112", None), ("205", "000")]
    df = spark.createDataFrame([("k", *r) for r in rows], "k string, forma string, katpo string")
    got = {r.cls: (r.basic, r.proportional) for r in E.class_counts(df, ["k"]).collect()}
    assert {c: b for c, (b, _) in got.items()} == {"0-9": 6.0, "10-19": 1.0, "20-49": 1.0, "50-249": 0.0, "GE250": 1.0}
    assert got["0-9"][1] == pytest.approx(2 + 2 / 3) and got["10-19"][1] == pytest.approx(1 + 1 / 3)
    assert got["20-49"][1] == pytest.approx(1 + 3 / 2) and got["GE250"][1] == pytest.approx(1 + 3 / 2)


def test_allocation_sums_to_the_total_and_reproduces_the_survey(spark):
    ent = {"0-9": 1000.0, "10-19": 100.0, "20-49": 50.0, "50-249": 20.0, "GE250": 5.0}
    av = {"0-9": 300.0, "10-19": 100.0, "20-49": 120.0, "50-249": 200.0, "GE250": 400.0}
    counts = spark.createDataFrame([("F", c, ent[c], ent[c]) for c in ent], "section string, cls string, basic double, proportional double")
    inputs = spark.createDataFrame([("F", 0.5, 1120.0)], "section string, active_share double, gva double")
    survey = spark.createDataFrame([("F", c, ent[c], av[c], 3 * av[c]) for c in ent], "section string, cls string, ent double, av double, tur double")
    out = E.allocate(counts, inputs, survey, ["section"], "section").collect()
    assert sum(r.gva_basic for r in out) == pytest.approx(1120.0)
    for r in out:
        assert r.gva_basic == pytest.approx(av[r.cls]) and r.tur_proportional == pytest.approx(3 * av[r.cls])


def merged(counts, threshold):
    groups, open_ = [], []
    for i, n in enumerate(counts):
        open_.append(i)
        if sum(counts[k] for k in open_) >= threshold:
            groups.append(open_)
            open_ = []
    if open_:
        if groups:
            groups[-1] = groups[-1] + open_
        else:
            groups.append(open_)
    return groups


def test_class_merging_against_brute_force(spark):
    rng = random.Random(4)
    cases = {k: [float(rng.choice([0, 1, 5, 9, 10, 30])) for _ in range(5)] for k in range(300)}
    rows = [(k, c, n, n) for k, v in cases.items() for c, n in zip(X.SIZE_CLASSES, v)]
    df = spark.createDataFrame(rows, "k int, cls string, basic double, proportional double")
    got = defaultdict(lambda: defaultdict(list))
    for r in E.publication_groups(df, ["k"]).collect():
        got[r.k][r.grp].append(X.SIZE_CLASSES.index(r.cls))
    for k, v in cases.items():
        assert sorted(sorted(g) for g in got[k].values()) == merged(v, 10), v


# --- findings ---------------------------------------------------------------------------------------

def effect(spark, own, rest, strength=None):
    a, b = own
    oa, ob = rest
    s = strength if strength is not None else abs(a / b - 1)
    df = spark.createDataFrame([(a, b, round(s, 4), oa, ob)], "value double, reference double, strength double, o_value double, o_reference double")
    return K.territory_effect(df).first()


def test_territory_effect_at_its_boundaries(spark):
    r = effect(spark, (6.0, 2.0), (4.0, 2.0))           # others repeat half of the change
    assert r.territory_effect and r.strength == pytest.approx(0.5) and r.original_strength == pytest.approx(2.0)
    assert not effect(spark, (6.0, 2.0), (3.8, 2.0)).territory_effect
    assert not effect(spark, (6.0, 2.0), (1.0, 2.0)).territory_effect            # opposite sign
    assert not effect(spark, (2.1, 2.0), (2.05, 2.0)).territory_effect           # below 3 %
    assert effect(spark, (2.2, 2.0), (6.0, 2.0)).strength <= 0.1                 # never raised
    assert not effect(spark, (6.0, 2.0), (None, 2.0)).territory_effect


def test_trend_of_a_series(spark):
    rows = [("F", "R1", y, r, o) for y, r, o in ((2023, 2.0, 2.0), (2024, 2.0, 2.0), (2025, 6.0, 2.1))]
    rows += [("F", "CZ", y, 2.5, 2.5) for y in (2023, 2024, 2025)]
    f = K.trend_changes(spark.createDataFrame(rows, "section string, territory string, year int, rate double, other double"), ["section"], "rate", "other", "za rok")
    got = {r.subtype.split(": ")[1]: (r.territory, r.value, r.reference, r.territory_effect) for r in f.collect()}
    assert got == {"poslední rok proti předchozím": ("R1", 6.0, 2.0, False), "proti ČR": ("R1", 6.0, 2.5, False), "vývoj proti ČR": ("R1", 3.0, 1.0, False)}


def test_ids_depend_on_content_only(spark):
    df = spark.createDataFrame([("F", "R1", 1.5, 1.0, 9.0, 8.0)], "section string, territory string, lq double, lq_state double, density double, density_state double")
    a = K.assemble([K.deviation_from_state(df, ["section", "territory"])], ["section", "territory"]).collect()
    b = K.assemble([K.deviation_from_state(df.withColumn("lq", F.lit(1.04)), ["section", "territory"])], ["section", "territory"]).collect()
    ids = lambda rows: {r.subtype: r.finding_id for r in rows}
    assert ids(a) == ids(b) and len(set(ids(a).values())) == 2
    assert [r.subtype for r in sorted(a, key=lambda r: r.position)] == ["LQ", "hustota"]
    assert [r.subtype for r in sorted(b, key=lambda r: r.position)] == ["hustota", "LQ"]


# --- texts ------------------------------------------------------------------------------------------

def test_banned_vocabulary(spark):
    texts = ["Firmy a firemní data", "aktivní podniky rostou", "neaktivní subjekt", "AKTIVNI_PODIL_KRAJ, firemni_kod", "subjekty", "Aktivní  subjekty", "aktivních podnikatelů"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: r.words for r in V.banned_vocabulary(df, "id", "text").collect()}
    assert got == {0: ["Firmy", "firemní"], 2: ["neaktivní"], 5: ["Aktivní"]}


def test_numbers_of_a_text(spark):
    text = "Strana 3 z 12. Podle tab. 4 je 1 234,50 subjektů, tj. −5,8 % a 007; graf 2, 12."
    df = spark.createDataFrame([(1, text)], "id int, text string")
    assert sorted(df.select(F.explode(V.numbers_in(F.col("text")))).toPandas().iloc[:, 0]) == ["12", "1234.5", "5.8", "7"]
    data = spark.createDataFrame([(-5.8, "na 1 234,5 obyvatel"), (12.0, "x 7 y")], "v double, t string")
    allowed = V.source_numbers(data, ["v"], ["t"])
    assert V.ungrounded_numbers(df, "id", "text", allowed).count() == 0
    changed = df.withColumn("text", F.replace("text", F.lit("5,8"), F.lit("5,9")))
    assert [r.number for r in V.ungrounded_numbers(changed, "id", "text", allowed).collect()] == ["5.9"]
