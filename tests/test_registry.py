import copy
import json
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from regisight.functions.text import with_role
from regisight.sources import registry as R
from regisight.sources import buckets as T
from regisight.sources import tables as B

BASE = {"ico": "12345678", "obchodniJmeno": "Nová s.r.o.", "pravniForma": "112", "datumVzniku": "2010-01-01", "datumAktualizace": "2026-01-02",
        "dic": "CZ12345678", "czNace": ["620", "41"], "sidlo": {"kodAdresnihoMista": 1, "textovaAdresa": "Ulice 1, Praha", "kodStatu": "CZ", "psc": 11000,
                                                              "cisloDomovni": 7, "typCisloDomovni": 1, "cisloOrientacni": 3, "cisloOrientacniPismeno": "a"},
        "adresaDorucovaci": {"radekAdresy1": "Ulice 1", "radekAdresy2": "Praha"}, "seznamRegistraci": {"stavZdrojeIr": "AKTIVNI"}}
PERSON = {"jmeno": "Jan", "prijmeni": "Novák", "datumNarozeni": "1970-01-01"}


def history(**fields):
    z = {"primarniZaznam": True, "obchodniJmeno": [{"datumZapisu": "2010-01-01", "hodnota": "Nová s.r.o."}],
         "pravniForma": [{"datumZapisu": "2010-01-01", "hodnota": "112"}]}
    z.update(fields)
    return {"icoId": "12345678", "zaznamy": [{"primarniZaznam": False, "obchodniJmeno": [{"datumZapisu": "2000-01-01", "hodnota": "cizí"}]}, z]}


def run(spark, *pairs):
    raw = spark.createDataFrame([(json.dumps(b), json.dumps(h)) for b, h in pairs], "base_json string, history_json string")
    return {k: v.collect() for k, v in R.map_subjects(raw).items()}


def organ(*members, kind="STATUTARNI_ORGAN", name="Statutární orgán"):
    return [{"typOrganu": kind, "nazevOrganu": name, "clenoveOrganu": list(members)}]


def test_versions(spark):
    h = history(obchodniJmeno=[{"datumZapisu": "2010-01-01", "datumVymazu": "2015-01-01", "hodnota": "Stará s.r.o."},
                               {"datumZapisu": "2015-01-01", "hodnota": "Nová s.r.o. v likvidaci"}],
                zakladniKapital=[{"datumZapisu": "2010-01-01", "vklad": {"typObnos": "KORUNY", "hodnota": "200000;00"}}],
                spisovaZnacka=[{"datumZapisu": "2010-01-01", "oddil": "C", "vlozka": "1", "soud": "MSPH"}])
    got = sorted(run(spark, (BASE, h))["versions"], key=lambda r: r.start)
    assert [(r.name, r.start, r.end) for r in got] == [("Stará s.r.o.", date(2010, 1, 1), date(2015, 1, 1)), ("Nová s.r.o. v likvidaci", date(2015, 1, 1), None)]
    old, new = got
    assert (old.in_liquidation, old.insolvent, old.tax_id, old.nace) == (False, None, None, None)
    assert (new.in_liquidation, new.insolvent, new.tax_id, new.nace) == (True, True, "CZ12345678", ["41", "620"])
    assert (new.capital, new.currency, new.file_mark, new.state) == (Decimal("200000.00"), "CZK", "C 1/MSPH", "AKTIVNI")


def test_liquidators_and_closing_cut_the_life(spark):
    liquidator = {"datumZapisu": "2014-01-01", "datumVymazu": "2016-01-01", "fyzickaOsoba": PERSON}
    h = history(statutarniOrgany=organ(liquidator, kind="LIKVIDATOR", name="Likvidátor"))
    got = sorted(run(spark, ({**BASE, "datumZaniku": "2018-01-01"}, h))["versions"], key=lambda r: r.start)
    assert [(r.start.year, r.in_liquidation, r.state) for r in got] == [(2010, False, "AKTIVNI"), (2014, True, "AKTIVNI"), (2016, False, "AKTIVNI"), (2018, False, "ZANIKLY")]


def test_base_record_only(spark):
    missing = {"kod": "NENALEZENO"}
    out = run(spark, (BASE, missing), ({**BASE, "ico": "00000001", "datumVzniku": None}, missing), ({"icoId": "9"}, missing))
    got = {r.ico: r for r in out["versions"]}
    assert (got["12345678"].start, got["12345678"].form_code) == (date(2010, 1, 1), "112")
    assert got["00000001"].start is None
    assert len(out["rejected"]) == 1 and len(out["versions"]) == 2


def test_seats(spark):
    seat = lambda text, start, end=None: {"typAdresy": "SIDLO", "datumZapisu": start, "datumVymazu": end, "adresa": {"textovaAdresa": text}}
    out = run(spark, (BASE, history(adresy=[seat("A", "2010-01-01"), seat("Ulice 1, Praha", "2012-01-01"), {"typAdresy": "JINA", "datumZapisu": "2010-01-01"}])))
    got = sorted((r.kind, r.start, r.end, r.original) for r in out["seats"])
    assert got == [("SIDLO", date(2010, 1, 1), date(2012, 1, 1), "A"), ("SIDLO", date(2012, 1, 1), None, "Ulice 1, Praha")]   # delivery address repeats the seat
    notes = sorted(r.note for r in out["notes"])
    assert notes[0].startswith("overlapping seats") and notes[1] == "unknown kind of address: JINA"
    other = copy.deepcopy(BASE)
    other["adresaDorucovaci"] = {"radekAdresy2": "Brno", "radekAdresy1": "Jiná 2"}
    out = run(spark, (other, history()))
    rows = {r.kind: r for r in out["seats"]}
    assert rows["DORUCOVACI"].original == "Jiná 2, Brno"
    assert (rows["SIDLO"].house, rows["SIDLO"].registration, rows["SIDLO"].orientation, rows["SIDLO"].zip) == ("7", None, "3a", "11000")


def test_repeated_registrations_merge(spark):
    job = {"funkce": {"nazev": "jednatel", "vznikFunkce": "2010-01-01"}}
    first = {"datumZapisu": "2010-01-05", "datumVymazu": "2012-01-01", "clenstvi": job, "fyzickaOsoba": PERSON}
    again = {"datumZapisu": "2012-01-01", "clenstvi": job, "fyzickaOsoba": {**PERSON, "jmeno": "JAN", "titulPredJmenem": "Ing."}}
    got = run(spark, (BASE, history(statutarniOrgany=organ(first, again))))["relations"]
    assert len(got) == 1
    r = got[0]
    assert (r.role_code, r.start, r.end, r.registered, r.deleted, r.title_before) == ("JEDNATEL", date(2010, 1, 1), None, date(2010, 1, 5), None, "Ing.")


def test_adjoining_rows_merge_and_gaps_stay(spark):
    job = lambda s, e: {"datumZapisu": s, "clenstvi": {"funkce": {"nazev": "jednatel", "vznikFunkce": s, "zanikFunkce": e}}, "fyzickaOsoba": PERSON}
    got = run(spark, (BASE, history(statutarniOrgany=organ(job("2010-01-01", "2012-01-01"), job("2012-01-01", "2014-01-01"), job("2015-01-01", None)))))["relations"]
    assert sorted((r.start, r.end) for r in got if r.end) == [(date(2010, 1, 1), date(2014, 1, 1))] and len(got) == 2


def test_owners_members_and_skipped(spark):
    owner = lambda who, *shares: {"datumZapisu": "2010-01-01", "osoba": who, "podil": list(shares)}
    share = {"datumZapisu": "2011-01-01", "vklad": {"typObnos": "KORUNY", "hodnota": "100000"}, "velikostPodilu": {"typObnos": "ZLOMEK", "hodnota": "1/3"},
             "splaceni": {"typObnos": "PROCENTA", "hodnota": "100"}}
    text = {**share, "velikostPodilu": {"typObnos": "TEXT", "hodnota": "polovina"}}
    firm = lambda **k: {"pravnickaOsoba": k}
    h = history(spolecnici=[
        {"typOrganu": "SPOLECNIK", "nazevOrganu": "Společníci", "spolecnik": [
            owner(firm(obchodniJmeno="Foreign Ltd", adresa={"kodStatu": "GB"}), share), owner(firm(ico="87654321"), text),
            owner(firm(ico="12345678")), owner(firm(ico="12")), owner(firm(obchodniJmeno="Bez státu")), owner({"fyzickaOsoba": {"jmeno": "X"}})]},
        {"typOrganu": "VKLAD_CLEN_DRUZSTVA_SEKCE", "spolecnik": [{}, {}]}],
        statutarniOrgany=organ({"clenstvi": {"funkce": {"nazev": "zástupce"}}, "fyzickaOsoba": PERSON}))
    out = run(spark, (BASE, h))
    got = {r.member_kind: r for r in out["relations"]}
    assert len(out["relations"]) == 2
    named = got["POJMENOVANY"]
    assert (named.member_name, named.member_state, named.start, named.deposit, named.share_percent, named.paid_percent) == (
        "Foreign Ltd", "GB", date(2011, 1, 1), Decimal("100000.00"), Decimal("33.3333"), Decimal("100.0000"))
    assert (got["SUBJEKT"].member_ico, got["SUBJEKT"].share_text, got["SUBJEKT"].share_percent) == ("87654321", "polovina", None)
    notes = sorted(r.note.split(" / ")[0] for r in out["notes"] if "seat" not in r.note)
    assert notes == ["invalid id of a member", "legal person without an id and without a name or state", "member is the subject itself",
                     "out of scope, cooperative members: 2", "person without a surname", "unknown role"]


def test_inconsistent_function_dates_fall_back_to_registration(spark):
    m = {"datumZapisu": "2010-01-01", "datumVymazu": "2012-01-01", "clenstvi": {"funkce": {"nazev": "jednatel", "vznikFunkce": "2015-01-01", "zanikFunkce": "2011-01-01"}}, "fyzickaOsoba": PERSON}
    r = run(spark, (BASE, history(statutarniOrgany=organ(m))))["relations"][0]
    assert (r.start, r.end) == (date(2010, 1, 1), date(2012, 1, 1))


def test_import_twice_changes_nothing(spark, folder):
    from regisight.plans.core import import_records

    h = history(statutarniOrgany=organ({"datumZapisu": "2010-01-01", "clenstvi": {"funkce": {"nazev": "jednatel"}}, "fyzickaOsoba": PERSON}))
    raw = lambda base: spark.createDataFrame([(json.dumps(base), json.dumps(h)), ("{broken", "{}")], "base_json string, history_json string")
    side = import_records(spark, folder, raw(BASE))
    assert side["rejected"].count() == 1 and side["broken"].count() == 0 and side["overlaps"].count() == 0
    names = ("subject_versions", "subject_seats", "relations", "person_versions")
    first = {n: sorted(map(str, T.versions(spark, folder, n).collect())) for n in names}
    import_records(spark, folder, raw(BASE))
    assert {n: sorted(map(str, T.versions(spark, folder, n).collect())) for n in names} == first
    assert T.read_part(spark, folder, "addresses", T.ROWS).count() == 1 and T.read_part(spark, folder, "subjects", T.ROWS).count() == 1
    import_records(spark, folder, raw({**BASE, "dic": "CZ87654321"}))
    v = T.versions(spark, folder, "subject_versions")
    assert v.count() == 2 and v.filter("recorded_to IS NULL").first().tax_id == "CZ87654321"
    assert {r.state for r in B.batches(spark, folder).collect()} == {"OK"}


def test_feed_imports_arrivals_once(spark, folder):
    from regisight.streaming.feed import import_arrivals

    incoming, root, mark = f"{folder}/in", f"{folder}/root", f"{folder}/mark"
    df = spark.createDataFrame([(json.dumps(BASE), json.dumps(history()))], "base_json string, history_json string")
    df.write.json(incoming)
    import_arrivals(spark, incoming, root, mark)
    import_arrivals(spark, incoming, root, mark)
    assert B.batches(spark, root).count() == 1
    assert T.versions(spark, root, "subject_versions").count() == 1


def test_filter_on_a_role_repeats_no_text(spark):
    df = spark.createDataFrame([("STATUTARNI_ORGAN", "Orgán", "jednatel", "112")], "t string, o string, j string, f string")
    plan = with_role(df, "t", "o", "j", "f").filter("role_code is null")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 2  # one for the organ, one for the function


def test_each_record_is_parsed_once(spark):
    raw = spark.createDataFrame([(json.dumps(BASE), json.dumps(history()), 1)], "b string, h string, k int")
    joined = raw.groupBy("k").agg(F.max("b").alias("base_json"), F.max("h").alias("history_json"))
    good, _ = R.parse(joined)
    assert good._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 2


def test_subjects_are_never_broadcast(spark):
    raw = spark.createDataFrame([(json.dumps(BASE), json.dumps(history()))], "base_json string, history_json string")
    subjects = R.store(R.parse(raw)[0])
    v, _ = R.versions(subjects)
    r, skipped = R.relations(subjects, subjects.select("ico", F.lit("112").alias("form_code")))
    for df in (v, r, skipped):
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
