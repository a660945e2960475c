import json
import os

import pytest
from pyspark.sql import functions as F

from regisight.operators import quality as Q
from regisight.sources import codelists as L
from regisight.sources import jsonstat as J
from regisight.sources import published as P
from regisight.sources import snapshot_csv as S
from regisight.sources import tables as B


def write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def metadata(folder, contract, drop=0, extra_date=None):
    cols = [{"name": c, "datatype": "date" if c in contract.dates or c == extra_date else "string"} for c in contract.columns]
    return write(folder, f"{contract.name}-meta.json", json.dumps({"tableSchema": {"columns": cols[drop:]}}, indent=1))


def subject_csv(folder, rows, header=None, name="s.csv"):
    lines = [",".join(header or S.SUBJECTS.columns)]
    for r in rows:
        lines.append(",".join(r.get(c, "") for c in S.SUBJECTS.columns))
    return write(folder, name, "\r\n".join(lines) + "\r\n")


ROWS = [
    {"ICO": "00000001", "FIRMA": '"A, ""B"" s.r.o."', "DDATVZN": "2010-01-01", "DATPLAT": "2026-09-15", "NACE": '""'},
    {"ICO": "00000002", "FIRMA": '"dva\r\nřádky"', "DATPLAT": "2026-09-15"},
    {"ICO": "00000003", "DDATZAN": "2024-05-05", "DATPLAT": "2026-09-15"},
]


def test_awkward_csv(spark, folder):
    df = S.typed(S.read_snapshot(spark, S.SUBJECTS, subject_csv(folder, ROWS)), S.SUBJECTS)
    got = {r.ico: r for r in df.collect()}
    assert len(got) == 3
    assert got["00000001"].firma == 'A, "B" s.r.o.' and got["00000001"].nace is None and str(got["00000001"].ddatvzn) == "2010-01-01"
    assert got["00000002"].firma == "dva\r\nřádky"
    assert got["00000003"].firma is None and str(got["00000003"].ddatzan) == "2024-05-05"


def test_load_skip_refuse(spark, folder):
    path, meta, root = subject_csv(folder, ROWS), metadata(folder, S.SUBJECTS), os.path.join(folder, "t")
    assert S.load_snapshot(spark, S.SUBJECTS, path, meta, root, "a") == ("2026-09-15", 3, True)
    assert S.load_snapshot(spark, S.SUBJECTS, path, meta, root, "b") == ("2026-09-15", 3, False)
    lf = write(folder, "lf.csv", open(path, encoding="utf-8", newline="").read().replace("řádky", "řádkY").replace("2026-09-15", "2026-08-15").replace("\r\n", "\n"))
    assert S.load_snapshot(spark, S.SUBJECTS, lf, meta, root, "lf") == ("2026-08-15", 3, True)
    assert {r.firma for r in S.snapshots(spark, S.SUBJECTS, root).filter("snapshot = date'2026-08-15'").collect()} == {'A, "B" s.r.o.', "dva\nřádkY", None}
    changed = subject_csv(folder, [{**ROWS[0], "FORMA": "101"}, *ROWS[1:]], name="c.csv")
    with pytest.raises(B.LoadRefused, match="other content"):
        S.load_snapshot(spark, S.SUBJECTS, changed, meta, root, "b")
    two_days = subject_csv(folder, [ROWS[0], {**ROWS[1], "DATPLAT": "2026-10-15"}], name="d.csv")
    with pytest.raises(B.LoadRefused, match="validity days"):
        S.load_snapshot(spark, S.SUBJECTS, two_days, meta, root, "b")
    undated = subject_csv(folder, [ROWS[0], {"ICO": "00000009"}], name="u.csv")
    with pytest.raises(B.LoadRefused, match="validity day"):
        S.load_snapshot(spark, S.SUBJECTS, undated, meta, root, "b")
    with pytest.raises(B.LoadRefused, match="validity day"):
        S.load_snapshot(spark, S.SUBJECTS, subject_csv(folder, [], name="n.csv"), meta, root, "b")
    short = write(folder, "short.csv", open(path, encoding="utf-8", newline="").read() + "00000004,only,three\r\n")
    with pytest.raises(B.LoadRefused, match="1 rows without the columns"):
        S.load_snapshot(spark, S.SUBJECTS, short, meta, root, "b")
    with pytest.raises(B.LoadRefused, match="1 rows with malformed dates"):
        S.load_snapshot(spark, S.SUBJECTS, subject_csv(folder, [{**ROWS[0], "DDATVZN": "soon"}], name="m.csv"), meta, root, "b")
    assert B.latest_snapshot(spark, root, "res_data") == "2026-09-15"
    assert S.snapshots(spark, S.SUBJECTS, root).filter("snapshot = date'2026-09-15'").count() == 3


def test_a_snapshot_is_parsed_once_and_pruned_by_day(spark, folder):
    meta, root = metadata(folder, S.SUBJECTS), os.path.join(folder, "t")
    for k, day in enumerate(("2026-07-15", "2026-08-15")):
        S.load_snapshot(spark, S.SUBJECTS, subject_csv(folder, [{**r, "DATPLAT": day} for r in ROWS], name=f"{k}.csv"), meta, root, f"b{k}")
    one = S.snapshots(spark, S.SUBJECTS, root).filter("snapshot = date'2026-08-15'")
    assert [os.path.basename(os.path.dirname(f)) for f in one.select("ico").inputFiles()] and one.count() == 3
    scan = [x for x in one._jdf.queryExecution().executedPlan().toString().split("\n") if "PartitionFilters" in x]
    assert scan and all("load" in x.split("PartitionFilters")[1] for x in scan)


def test_fingerprint_sees_a_value_that_moves(spark, folder):
    meta, root = metadata(folder, S.SUBJECTS), os.path.join(folder, "t")
    S.load_snapshot(spark, S.SUBJECTS, subject_csv(folder, [{"ICO": "1", "DATPLAT": "2026-09-15", "NACE": "41"}]), meta, root, "a")
    with pytest.raises(B.LoadRefused, match="other content"):
        S.load_snapshot(spark, S.SUBJECTS, subject_csv(folder, [{"ICO": "1", "DATPLAT": "2026-09-15", "NACE2025": "41"}], name="m.csv"), meta, root, "b")
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    prints = {(r.hash, r.hash2) for r in (B.fingerprint(df.filter("x = 'a'")).first(), B.fingerprint(df.filter("y = 'a'")).first())}
    assert len(prints) == 2 and all(a != b for a, b in prints)


def test_contract_refusals(spark, folder):
    path = subject_csv(folder, ROWS)
    with pytest.raises(B.LoadRefused, match="other columns"):
        S.check_structure(spark, S.SUBJECTS, metadata(folder, S.SUBJECTS, drop=1), path)
    with pytest.raises(B.LoadRefused, match="date columns"):
        S.check_structure(spark, S.SUBJECTS, metadata(folder, S.SUBJECTS, extra_date="NACE"), path)
    wrong = subject_csv(folder, ROWS, header=["X", *S.SUBJECTS.columns[1:]], name="w.csv")
    with pytest.raises(B.LoadRefused, match="header"):
        S.check_structure(spark, S.SUBJECTS, metadata(folder, S.SUBJECTS), wrong)
    with pytest.raises(Exception):
        S.read_snapshot(spark, S.SUBJECTS, wrong).select(*S.SUBJECTS.columns).collect()


def test_ingest_and_gate(spark, folder):
    from regisight.plans.ingest import ingest_snapshot

    rows = [{"ICO": f"{i:08d}", "DATPLAT": "2026-09-15", "NACE": "41", "OKRESLAU": "CZ01" if i else ""} for i in range(4)]
    acts = "\r\n".join([",".join(S.ACTIVITIES.columns), "00000001,1,80004,41,2026-09-15,2020-01-01,"]) + "\r\n"
    files = {"subjects": (subject_csv(folder, rows), metadata(folder, S.SUBJECTS)),
             "activities": (write(folder, "a.csv", acts), metadata(folder, S.ACTIVITIES))}
    code = lambda *c: spark.createDataFrame([(x,) for x in c], "code string")
    lists = {"nace": code("41").withColumn("pseudo", F.lit(False)), "districts": code("CZ01"), "sizes": code("110"), "forms": code("101")}
    with pytest.raises(Q.QualityGateError, match="bez_kraje"):
        ingest_snapshot(spark, f"{folder}/root", files, lists)
    stored = ingest_snapshot(spark, f"{folder}/root", files, lists, limit=0.3)   # loaded already, only the gate differs
    assert {r["count"] for r in stored.filter("metric = 'bez_kraje' AND base = 'bez_zaniku'").collect()} == {1}
    assert {r.state for r in B.batches(spark, f"{folder}/root").collect()} == {"OK"}
    other = {**files, "activities": (write(folder, "b.csv", acts.replace("2026-09-15", "2026-10-15")), files["activities"][1])}
    with pytest.raises(B.LoadRefused):
        ingest_snapshot(spark, f"{folder}/other", other, lists)
    assert [r.state for r in B.batches(spark, f"{folder}/other").collect()] == ["error"]


def test_code_lists(spark, folder):
    head = "﻿CHODNOTA,TEXT,ZKRTEXT,ADMPLOD,ADMNEPO\r\n"
    items = L.read_list(spark, write(folder, "l.csv", head + 'CZ0511,"Česká Lípa",CL,2000-01-01,\r\nCZ0512,Jablonec,JN,,\r\n'))
    assert [tuple(r)[:2] for r in L.plain_list(items).orderBy("code").collect()] == [("CZ0511", "Česká Lípa"), ("CZ0512", "Jablonec")]
    link = spark.createDataFrame([("109", "CZ0511", "108", "CZ051"), ("109", "CZ0512", "108", "CZ051")], "kodcis1 string, chodnota1 string, kodcis2 string, chodnota2 string")
    assert {r.region for r in L.districts(items, link).collect()} == {"CZ051"}
    with pytest.raises(B.LoadRefused, match="without a region"):
        L.districts(items, link.limit(1))
    with pytest.raises(B.LoadRefused, match="unexpected link"):
        L.districts(items, link.withColumn("kodcis2", F.lit("100")))
    with pytest.raises(B.LoadRefused, match="empty"):
        L.read_list(spark, write(folder, "e.csv", head))
    assert L.legal_forms(items, 56).first().list_id == 56


def json_stat(value, status=None):
    return json.dumps({"id": ["geo", "time", "unit", "nace_r2"], "dimension": {
        "geo": {"category": {"index": {"CZ051": 1, "CZ": 0}}}, "time": {"category": {"index": {"2023": 0, "2024": 1}}},
        "unit": {"category": {"index": {"CP_MNAC": 0}}}, "nace_r2": {"category": {"index": {"F": 0, "TOTAL": 1}}}},
        "value": value, "status": status or {}, "updated": "2026-01-01"})


@pytest.mark.parametrize("dense", [False, True])
def test_json_stat(spark, dense):
    values = {0: 1.5, 3: 2.0, 7: 9.0}
    value = [values.get(i) for i in range(8)] if dense else {str(k): v for k, v in values.items()}
    docs = spark.createDataFrame([(json_stat(value, {"3": "p"}),)], "value string")
    got = {(r.geo, r.year, r.nace, r.indicator, r.level): (r.value, r.status) for r in J.accounts(J.decode(docs), "nama_10r_3gva").collect()}
    assert got == {("CZ", 2023, "F", "HPH_CP", "STAT"): (1.5, ""), ("CZ", 2024, "TOTAL", "HPH_CP", "STAT"): (2.0, "p"),
                   ("CZ051", 2024, "TOTAL", "HPH_CP", "KRAJ"): (9.0, "")}


def test_wages_and_hierarchies(spark):
    wage, other = "Průměrná hrubá měsíční mzda na přepočtené počty zaměstnanců (Kč)", "Index"
    rows = [(wage, "CZ051", None, None, None, "F", "2024", "40000", None), (wage, None, "CZ05", "CZ051", "CZ", None, "2025", "41000", "p"),
            (wage, None, "CZ05", None, "CZ", None, "2025", "1", None), (wage, None, None, None, "CZ", None, "2025", "42000", None),
            (other, "CZ051", None, None, None, "F", "2024", "1", None), (wage, "CZ051", None, None, None, "F", "2024", "", None)]
    names = ["Ukazatel", "Uz2.Polozka", "Uz0123vm.REGION.Polozka", "Uz0123vm.KRAJ.Polozka", "Uz0123vm.STAT.Polozka", "CZNACEMZDY.Polozka", "CasR.Polozka", "Hodnota", "OBS_STATUS"]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(9))).toDF(*names)
    got = {(r.territory, r.level, r.nace, r.year, r.indicator, r.value, r.preliminary) for r in P.wages(df, "MZDRT5").collect()}
    assert got == {("CZ051", "KRAJ", "F", 2024, "MZDA_PREP", 40000.0, False), ("CZ051", "KRAJ", "0", 2025, "MZDA_PREP", 41000.0, True),
                   ("CZ", "STAT", "0", 2025, "MZDA_PREP", 42000.0, False)}
    pop = spark.createDataFrame([("Obyv", "0", "CZ0511", "CZ051", "CZ", "Česká Lípa", "2024", "100"), ("Obyv", "1", "CZ0511", "CZ051", "CZ", "x", "2024", "50"),
                                 ("Obyv", "0", None, None, "CZ", "", "2024", "9")], ", ".join(f"c{i} string" for i in range(8))).toDF(
        "Ukazatel", "POHL2.Polozka", "Uz0123h2.OKRES.Polozka", "Uz0123h2.KRAJ.Polozka", "Uz0123h2.STAT.Polozka", "Území-Okres", "CasR.Polozka", "Hodnota")
    assert {(r.territory, r.level, r.name, r.value) for r in P.population(pop, {"Obyv": "2406K2"}).collect()} == {
        ("CZ0511", "OKRES", "Česká Lípa", 100.0), ("CZ", "STAT", "CZ", 9.0)}


def test_tables(spark, folder):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    B.publish(df, folder, "x", "b1", ["k"])
    B.publish(df.withColumn("v", F.col("v") + 1), folder, "x", "b2", ["k"])
    assert {tuple(r) for r in B.current(spark, folder, "x").collect()} == {("a", 2), ("b", 3)}
    with pytest.raises(B.LoadRefused, match="duplicates"):
        B.publish(df.unionByName(df), folder, "x", "b3", ["k"])
    assert B.current(spark, folder, "x").count() == 2     # the refused version never became current
    a, b = (B.fingerprint(x).first() for x in (df, df.orderBy(F.desc("k"))))
    assert (a.rows, a.hash) == (b.rows, b.hash)
    years = lambda *r: spark.createDataFrame(list(r), "year int, v int")
    assert B.replace_by_key(years((2023, 1), (2024, 2), (None, 3)), folder, "years", ["year"], "b1") == 3
    held = B.read_keyed(spark, folder, "years")
    assert B.replace_by_key(years((2024, 5), (2024, 6)), folder, "years", ["year"], "b2") == 1 and B.replace_by_key(years((1, 1)).limit(0), folder, "years", ["year"], "b3") == 0
    assert {(r.year, r.v) for r in B.read_keyed(spark, folder, "years").collect()} == {(2023, 1), (2024, 5), (2024, 6), (None, 3)}
    assert {(r.year, r.v) for r in held.collect()} == {(2023, 1), (2024, 2), (None, 3)}  # a reader that began before sees what was there
    with pytest.raises(B.LoadRefused):
        B.read_keyed(spark, folder, "nothing")
