from datetime import date

import pytest
from pyspark.sql import functions as F

from regisight.functions import fixed as X
from regisight.operators import crosswalk as C
from regisight.operators import history as H
from regisight.operators import interface as N

LIST = "code string, level int, parent string, pseudo boolean"


def closure(spark, rows):
    return C.hierarchy(spark.createDataFrame([(*r, False) for r in rows], LIST))


def test_hierarchy_and_its_errors(spark):
    rows = [("F", 1, None), ("41", 2, "F"), ("412", 3, "41"), ("4120", 4, "412"), ("41201", 5, "4120")]
    items = C.with_pseudo_codes(spark.createDataFrame(rows, "code string, level int, parent string"))
    got = {r.code: (r.section, r.division, r.grp, r.cls, r.pseudo) for r in C.hierarchy(items).collect()}
    assert got["41201"] == ("F", "41", "412", "4120", False)
    assert got["F"] == ("F", None, None, None, False)
    assert got["00"] == ("Y", "00", None, None, True)
    assert C.hierarchy_errors(items).count() == 0
    bad = spark.createDataFrame([(*r, False) for r in rows] + [("412", 3, "41", False), ("999", 3, "98", False)], LIST)
    errors = {(r.code, r.error) for r in C.hierarchy_errors(bad).collect()}
    assert {("412", "duplicate code"), ("999", "unknown parent"), ("999", "no section")} <= errors


def test_pairs_from_all_sheets(spark):
    two = "level int, a string, b string"
    fwd = spark.createDataFrame([(4, "01.11", "01.11"), (4, "01.12", "01.12"), (3, "01.1", "01.1"), (4, "46.88", "*")], two)
    back = spark.createDataFrame([(4, "01.13", "01.12"), (4, "46.89", "*")], two)
    sheet = "a string, b string"
    old5 = spark.createDataFrame([("01.47.1 (částečně)", "01.47.2")], sheet)
    new5 = spark.createDataFrame([("01.47.2", "01.47.1"), ("01.48.0", None)], sheet)
    codes = lambda rows: spark.createDataFrame([(c, 5) for c in rows], "code string, level int")
    got = {(r.level, r.code_2008, r.code_2025, r.partial) for r in C.assemble_pairs(fwd, back, old5, new5, codes(["01110", "01471"]), codes(["01110", "01120"])).collect()}
    assert got == {(4, "0111", "0111", False), (4, "0112", "0112", False), (4, "0112", "0113", False), (3, "011", "011", False),
                   (5, "01110", "01110", False), (5, "01471", "01472", True)}


def test_link_types(spark):
    rows = [(4, "a", "A"), (4, "b", "B"), (4, "b", "C"), (4, "d", "D"), (4, "e", "D"), (4, "f", "F"), (4, "f", "G"), (4, "g", "G"), (5, "a", "Z")]
    got = {(r.level, r.code_2008, r.code_2025): r.link for r in C.link_types(spark.createDataFrame(rows, "level int, code_2008 string, code_2025 string")).collect()}
    assert got == {(4, "a", "A"): "1:1", (4, "b", "B"): "1:N", (4, "b", "C"): "1:N", (4, "d", "D"): "N:1", (4, "e", "D"): "N:1",
                   (4, "f", "F"): "1:N", (4, "f", "G"): "N:M", (4, "g", "G"): "N:1", (5, "a", "Z"): "1:1"}


def rules(spark, links, matrix):
    old = closure(spark, [("F", 1, None), ("41", 2, "F"), ("411", 3, "41"), ("42", 2, "F"), ("421", 3, "42"), ("422", 3, "42")])
    new = closure(spark, [("G", 1, None), ("H", 1, None), ("51", 2, "G"), ("511", 3, "51"), ("52", 2, "H"), ("521", 3, "52"), ("522", 3, "52")])
    cw = spark.createDataFrame(links, "code_2008 string, code_2025 string, link string")
    m = spark.createDataFrame(matrix or [("zz", 9, "x", 1, 1)], "code_2008 string, level int, code_2025 string, count bigint, base bigint")
    return {(r.code_2008, r.level): (r.code_2025, None if r.certainty is None else float(r.certainty), r.method, r.candidates, r.crosswalk_target)
            for r in C.derivation_rules(old, new, cw, m).collect()}


def test_rule_by_a_1_to_1_link_of_the_code_or_its_ancestor(spark):
    r = rules(spark, [("41", "51", "1:1"), ("411", "511", "1:N"), ("411", "521", "N:M")], [])
    assert r[("41", 2)][:3] == ("51", 1.0, "prevodnik_1:1")
    assert r[("411", 2)][:3] == ("51", 1.0, "prevodnik_1:1")    # through the ancestor 41
    assert r[("411", 3)][2:4] == ("nejednoznacne", ["511", "521"])


def test_rule_by_a_single_candidate(spark):
    r = rules(spark, [("421", "521", "N:1"), ("422", "521", "N:1")], [])
    assert r[("421", 3)][:3] == ("521", 1.0, "prevodnik_jediny_cil")
    assert r[("421", 1)][:3] == ("H", 1.0, "prevodnik_jediny_cil")


@pytest.mark.parametrize("base, method", [(19, "nejednoznacne"), (20, "empiricky")])
def test_rule_needs_a_base(spark, base, method):
    r = rules(spark, [("411", "511", "1:N"), ("411", "521", "1:N")], [("411", 3, "521", base - 5, base), ("411", 3, "511", 5, base)])
    assert r[("411", 3)][2] == method
    assert r[("411", 3)][0] == ("521" if method == "empiricky" else None)


@pytest.mark.parametrize("share, method", [(89, "prevodnik_1:1"), (90, "empiricky_rozpor")])
def test_conflict_needs_nine_tenths(spark, share, method):
    r = rules(spark, [("411", "511", "1:1")], [("411", 3, "521", share, 100), ("411", 3, "511", 100 - share, 100)])
    code, certainty, got, _, target = r[("411", 3)]
    assert got == method
    assert (code, target) == (("521", "511") if method == "empiricky_rozpor" else ("511", None))
    assert certainty == (0.9 if method == "empiricky_rozpor" else 1.0)


def test_top_target_takes_the_smallest_code_on_ties(spark):
    m = spark.createDataFrame([("411", 3, "522", 7, 14), ("411", 3, "521", 7, 14)], "code_2008 string, level int, code_2025 string, count bigint, base bigint")
    assert C.top_targets(m).first().top == "521"


# --- history from snapshots -------------------------------------------------------------------------

SNAP = "ico string, snapshot date, updated date, closed date, nace string, nace2025 string"
D1, D2 = date(2026, 9, 15), date(2026, 10, 15)


def empty_history(spark):
    return spark.createDataFrame([], "ico string, version int, code string, level int, kind string, source string, detail string, certainty decimal(5,4), "
                                     "flag string, candidates array<string>, derived_from string, start date, end date, close_reason string, batch_id int")


def load(history, snap, batch=1):
    return H.apply_codes(history, H.staged_main(snap, 2008, "nace"), H.snapshot_scope(snap), 2008, X.MAIN, F.lit("s"), F.lit(batch))


def view(df):
    return sorted((r.ico, r.code, r.start, r.end, r.close_reason, r.action) for r in df.collect())


def test_code_history_over_two_snapshots(spark):
    u = date(2020, 1, 1)
    first = spark.createDataFrame([("1", D1, u, None, "41", None), ("2", D1, u, None, "42", None), ("3", D1, None, date(2024, 5, 5), None, None),
                                   ("4", D1, u, date(2019, 1, 1), "43", None)], SNAP)
    h1 = load(empty_history(spark), first)
    assert view(h1) == [("1", "41", u, None, None, "insert"), ("2", "42", u, None, None, "insert"),
                        ("4", "43", date(2019, 1, 1), date(2019, 1, 1), X.REASON_CLOSED, "insert")]
    again = load(h1.drop("action"), first)
    assert {r.action for r in again.collect()} == {"keep"} and again.count() == 3
    second = spark.createDataFrame([("1", D2, date(2026, 10, 1), None, "45", None), ("2", D2, u, date(2026, 10, 2), None, None)], SNAP)
    assert view(load(h1.drop("action"), second, 2)) == [
        ("1", "41", u, date(2026, 10, 1), X.REASON_DROPPED, "close"), ("1", "45", date(2026, 10, 1), None, None, "insert"),
        ("2", "42", u, date(2026, 10, 2), X.REASON_CLOSED, "close"),        # closed without codes: the reason is the closure
        ("4", "43", date(2019, 1, 1), date(2019, 1, 1), X.REASON_CLOSED, "keep")]


def test_2025_codes_start_in_2025(spark):
    snap = spark.createDataFrame([("1", D1, date(2019, 1, 1), None, None, "41"), ("2", D1, date(2019, 1, 1), date(2020, 1, 1), None, "41")], SNAP)
    got = sorted((r.ico, r.start, r.end) for r in H.staged_main(snap, 2025, "nace2025").collect())
    assert got == [("1", date(2025, 1, 1), None), ("2", date(2025, 1, 1), date(2025, 1, 1))]


def test_secondary_codes_are_all_but_the_main_one(spark):
    snap = spark.createDataFrame([("1", D1, D1, None, "41", None)], SNAP)
    acts = spark.createDataFrame([("1", "41"), ("1", "62"), ("1", "62"), ("1", None)], "ico string, code string")
    assert [r.code for r in H.staged_secondary(snap, acts, 2008, "nace").collect()] == ["62"]


def test_record_codes_and_end_of_dual_coding(spark):
    rec = spark.createDataFrame([("1", "41", ["41", "62", "43"], date(2019, 1, 1), None)], "ico string, main string, codes array<string>, updated date, closed date")
    main, secondary = H.staged_from_record(rec, 2025)
    assert [(r.code, r.start) for r in main.collect()] == [("41", date(2025, 1, 1))]
    assert sorted(r.code for r in secondary.collect()) == ["43", "62"]
    assert H.staged_from_record(rec, 2008, end_dual=True)[0].count() == 0
    snap = spark.createDataFrame([("1", date(2029, 1, 1), None, None, "41", None)], SNAP)
    assert spark.range(1).select(H.dual_coding_ended(snap).alias("e")).first().e is True
    assert spark.range(1).select(H.dual_coding_ended(spark.createDataFrame([("1", D1, None, None, None, "41")], SNAP)).alias("e")).first().e is True
    assert spark.range(1).select(H.dual_coding_ended(spark.createDataFrame([("1", D1, None, None, "41", "41")], SNAP)).alias("e")).first().e is False


def test_code_audit(spark):
    snap = spark.createDataFrame([("1", D1, D1, None, "41", None), ("2", D1, D1, None, "42", None), ("3", D1, D1, None, "43", None)], SNAP)
    before = load(empty_history(spark), snap).drop("action")
    allowed = H.end_dual_coding(before)
    assert H.audit_codes(before, allowed, ["ico"]).count() == 0
    mutated = before.filter("ico <> '1'").withColumn("code", F.when(F.col("ico") == "2", "99").otherwise(F.col("code")))
    assert {(r.ico, r.violation) for r in H.audit_codes(before, mutated, ["ico"]).collect()} == {("1", "deleted"), ("2", "changed")}
    reopened = allowed.withColumn("end", F.lit(None).cast("date"))
    assert H.audit_codes(allowed, reopened, ["ico"]).count() == 3


def test_request_validation(spark):
    codes = closure(spark, [("F", 1, None), ("41", 2, "F"), ("412", 3, "41"), ("4120", 4, "412"), ("41201", 5, "4120"), ("G", 1, None)])
    asked = spark.createDataFrame([(1, "f"), (1, "g"), (2, "41"), (2, "4120"), (3, "41201"), (4, "zz"), (4, "F")], "request_id int, code string")
    good, bad = N.validate_requests(asked, codes)
    assert {(r.request_id, r.code) for r in good.collect()} == {(1, "F"), (1, "G")}
    assert {(r.request_id, r.code, r.reason) for r in bad.collect()} == {
        (2, "4120", "inside another requested code"), (3, "41201", "deeper than a class"), (4, "ZZ", "unknown code")}


def test_interface_prefers_official_codes_and_keeps_one_row_per_subject(spark):
    old = closure(spark, [("F", 1, None), ("41", 2, "F")])
    new = closure(spark, [("G", 1, None), ("51", 2, "G"), ("52", 2, "G")])
    base = dict(kind=X.MAIN, detail="x", flag=None, candidates=None, derived_from=None, end=None, close_reason=None, batch_id=1)
    row = lambda ico, version, code, level, source, certainty, start, **k: {**base, "ico": ico, "version": version, "code": code, "level": level, "source": source, "certainty": certainty, "start": start, **k}
    from decimal import Decimal as Dec
    rows = [row("1", 2008, "41", 2, X.OFFICIAL, Dec(1), D1), row("1", 2025, "52", 2, X.OFFICIAL, Dec(1), D1),
            row("1", 2025, "51", 2, X.DERIVED, Dec("0.9"), D1, derived_from="41"),
            row("2", 2008, "41", 2, X.OFFICIAL, Dec(1), D1), row("2", 2025, "G", 1, X.DERIVED, Dec("0.95"), D1, derived_from="41"),
            row("2", 2025, "51", 2, X.DERIVED, Dec("0.79"), D1, derived_from="41"),
            row("3", 2008, "41", 2, X.OFFICIAL, Dec(1), D1), row("3", 2025, "G", 1, X.DERIVED, Dec("0.95"), D1, derived_from="41"),
            row("3", 2025, None, 2, X.DERIVED, None, D1, derived_from="41", flag=X.AMBIGUOUS, candidates=["51", "52"])]
    h = spark.createDataFrame(rows, empty_history(spark).schema)
    got = {r.ico: r for r in N.company_interface(h, old, new).collect()}
    assert len(got) == 3
    assert (got["1"].source, got["1"].code_2025, got["1"].auto_link, got["1"].code_2008) == ("RES", "52", True, "41")
    assert (got["2"].code_2025, float(got["2"].certainty), got["2"].auto_link, got["2"].status) == ("51", 0.79, False, X.DERIVED_UNSURE)
    assert {k: float(v) for k, v in got["2"].certainties.items()} == {1: 0.95, 2: 0.79}
    assert (got["3"].code_2025, got["3"].level_2025, got["3"].flag, got["3"].candidates) == ("G", 1, X.AMBIGUOUS, ["51", "52"])
