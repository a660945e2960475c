from datetime import date

from pyspark.sql import functions as F

from regisight.functions import fixed as X
from regisight.operators import crosswalk as C
from regisight.operators import history as H
from regisight.plans.classify import classify
from regisight.sources import tables as B
from tests.test_codes import closure, empty_history

D1, D2, U = date(2026, 9, 15), date(2026, 10, 15), date(2020, 1, 1)
SNAP = "ico string, snapshot date, updated date, closed date, nace string, nace2025 string"


def snapshot(spark, day, changed=False):
    """30 dual-coded subjects, five with the old code only, one that changes its code."""
    rows = [(f"{i:08d}", day, U, None, "41", "51" if i < 28 else "52") for i in range(30)]
    rows += [(f"{i:08d}", day, U, None, "41", None) for i in range(30, 35)]
    rows.append(("00000099", day, date(2026, 10, 1) if changed else U, None, "42" if changed else "41", "51"))
    return spark.createDataFrame(rows, SNAP)


def test_snapshots_to_interface(spark, folder):
    old = closure(spark, [("F", 1, None), ("41", 2, "F"), ("42", 2, "F")])
    new = closure(spark, [("G", 1, None), ("51", 2, "G"), ("52", 2, "G")])
    links = C.link_types(spark.createDataFrame([(2, "41", "51"), (2, "41", "52"), (1, "F", "G")], "level int, code_2008 string, code_2025 string"))
    acts = spark.createDataFrame([("00000001", "80004", "42"), ("00000001", "80004", "41"), ("00000002", "80143", "52")], "ico string, kodcis string, hodn string")
    out = classify(spark, folder, empty_history(spark), snapshot(spark, D1), acts, old, new, links, 1)
    got = {r.ico: r for r in out.collect()}
    assert len(got) == 36 and got["00000001"].source == X.OFFICIAL
    derived = got["00000032"]                      # 29 of 31 dual-coded subjects went to 51
    assert (derived.source, derived.code_2025, float(derived.certainty_division), derived.auto_link) == (X.DERIVED, "51", 0.9355, True)
    history = B.current(spark, folder, "code_history").select(*H.CODE_COLUMNS)
    assert history.filter(F.col("kind") == X.SECONDARY).count() == 2
    first = sorted(map(str, history.collect()))
    classify(spark, folder, history, snapshot(spark, D1), acts, old, new, links, 2)      # the same snapshot again
    assert sorted(map(str, B.current(spark, folder, "code_history").select(*H.CODE_COLUMNS).collect())) == first
    classify(spark, folder, history, snapshot(spark, D2, changed=True), acts, old, new, links, 3)
    rows = B.current(spark, folder, "code_history").filter("ico = '00000099' AND version = 2008").orderBy("start").collect()
    assert [(r.code, r.start, r.end, r.close_reason) for r in rows] == [
        ("41", U, date(2026, 10, 1), X.REASON_DROPPED), ("42", date(2026, 10, 1), None, None)]
    assert {r.state for r in B.batches(spark, folder).collect()} == {"OK"}
