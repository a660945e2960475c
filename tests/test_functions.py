import hashlib
import math
import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from regisight.functions import codes as C
from regisight.functions import numbers as N
from regisight.functions import text as T


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


def lit(v, kind="string"):
    return F.lit(v).cast(kind)


def test_check_digit(spark):
    for ico, ok in (("27074358", True), ("27074359", False), ("00006947", True), ("1234567", False), ("abcdefgh", False), (None, False)):
        assert one(spark, T.valid_id(lit(ico))) is ok, ico


def test_normalisers(spark):
    assert one(spark, T.plain_text(lit("  Žluťoučký   KŮŇ-x "))) == "zlutoucky kun-x"
    assert one(spark, T.plain_text(lit(None))) == ""
    assert one(spark, T.plain_words(lit("Předs. představenstva, a.s."))) == "preds predstavenstva a s"
    assert one(spark, T.person_key(lit("Jan"), lit("Novák"), lit(None, "date"))) == "jan|novak|?"


def test_row_hash_is_independent_of_column_order_and_sees_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    h = [r[0] for r in df.select(T.row_hash(["x", "y"])).collect()]
    g = [r[0] for r in df.select(T.row_hash(["y", "x"])).collect()]
    assert h == g and h[0] != h[1]


def test_finding_id_is_base_26_of_the_digest(spark):
    key = "odchylka_od_cr|LQ|T02/a/lq"
    n, letters = int(hashlib.sha256(key.encode()).hexdigest(), 16), ""
    for _ in range(4):
        n, r = divmod(n, 26)
        letters += chr(65 + r)
    assert one(spark, T.finding_id(lit("OD"), lit(key))) == f"ZOD-{letters}"


@pytest.mark.parametrize("organ_type, organ, job, form, role", [
    ("PROKURA", None, None, None, "PROKURISTA"),
    ("AKCIONAR", "x", None, None, "JEDINY_AKCIONAR"),
    ("DOZORCI_RADA", "Dozorčí rada", "předseda dozorčí rady", None, "PREDSEDA_DOZORCI_RADY"),
    ("DOZORCI_RADA", "Dozorčí rada", None, None, "CLEN_DOZORCI_RADY"),
    ("DOZORCI_RADA", "Dozorčí rada", "ředitel", None, None),
    ("KONTROLNI_KOMISE", None, "místopředseda", None, "MISTOPREDSEDA_KONTROLNI_KOMISE"),
    ("STATUTARNI_ORGAN", "Statutární orgán - představenstvo", "předs. představenstva", "121", "PREDSEDA_PREDSTAVENSTVA"),
    ("STATUTARNI_ORGAN", "Statutární orgán", "generální ředitel", "121", None),
    ("STATUTARNI_ORGAN", "Správní rada", "místopředseda správní rady", None, None),
    ("STATUTARNI_ORGAN", "Správní rada", "člen správní rady", None, "CLEN_SPRAVNI_RADY"),
    ("STATUTARNI_ORGAN", "Statutární orgán", "jednatel", "112", "JEDNATEL"),
    ("STATUTARNI_ORGAN", "Statutární orgán", None, "112", "JEDNATEL"),
    ("STATUTARNI_ORGAN", "Statutární ředitel", None, "121", "STATUTARNI_REDITEL"),
    ("STATUTARNI_ORGAN", "Statutární orgán", "předseda družstva", "205", "PREDSEDA_DRUZSTVA"),
    ("STATUTARNI_ORGAN", "Statutární orgán - společník", None, "111", "SPOLECNIK"),
    ("JINY", "x", "y", None, None),
])
def test_roles(spark, organ_type, organ, job, form, role):
    df = spark.createDataFrame([(organ_type, organ, job, form)], "t string, o string, j string, f string")
    assert T.with_role(df, "t", "o", "j", "f").first().role_code == role


@pytest.mark.parametrize("text, value", [("8000;00", "8000"), ("1 234,5", "1234.5"), ("x", None), ("", None), (None, None), ("-3", "-3")])
def test_numbers(spark, text, value):
    got = one(spark, N.parse_number(lit(text)))
    assert got == (Decimal(value) if value is not None else None)


@pytest.mark.parametrize("kind, text, value", [
    ("PROCENTA", "33;33", "33.3300"), ("PROCENTA", "101", None), ("ZLOMEK", "1/3", "33.3333"), ("ZLOMEK", "1;4", "25.0000"), ("TEXT", "12,5 %", "12.5000"),
    ("TEXT", "3/4", "75.0000"), ("ZLOMEK", "12 %", None), ("ZLOMEK", "1/0", None), ("TEXT", "polovina", None), ("KORUNY", "50", None), ("PROCENTA", None, None)])
def test_shares(spark, kind, text, value):
    assert one(spark, N.share_percent(lit(kind), lit(text))) == (Decimal(value) if value else None)


def test_money(spark):
    assert one(spark, N.money_amount(lit("KORUNY"), lit("200000;00"))) == Decimal("200000.00")
    assert one(spark, N.money_amount(lit("TEXT"), lit("200000;00"))) is None
    assert one(spark, N.money_currency(lit("EURA"))) == "EUR"


def test_codes_and_dates(spark):
    assert one(spark, C.clean_code(lit("01.47.0 (částečně)"))) == "01470"
    assert one(spark, C.is_partial(lit("01.47.0 (částečně)"))) is True
    assert [one(spark, C.code_level(lit(c))) for c in ("A", "41", "412", "41201")] == [1, 2, 3, 5]
    assert one(spark, C.quarter_end(lit("2024-Q1"))) == date(2024, 3, 31)
    assert one(spark, C.start_2025(lit(None, "date"))) == date(2025, 1, 1)
    assert one(spark, C.end_2025(lit(None, "date"))) is None
    assert one(spark, C.end_2025(lit("2020-05-05", "date"))) == date(2025, 1, 1)
    assert [one(spark, C.size_class(lit(k))) for k in ("110", "000", "510", None)] == ["0-9", None, "GE250", None]
    assert [one(spark, C.size_band(lit(k))) for k in ("110", "130", "240", "999", None)] == ["110", "1-9", "50-249", "jiné", "000"]
    assert one(spark, C.person_type(lit("424"))) == "FO" and one(spark, C.person_type(lit(None))) == "PO"
    assert one(spark, C.closure_mode(lit(None))) == "jiny"


def test_age_band_edges(spark):
    day = F.lit(date(2026, 9, 15))
    for founded, band in ((date(2026, 9, 15), "0-2"), (date(2023, 9, 15), "3-5"), (date(2023, 9, 16), "0-2"), (date(1990, 1, 1), "31+")):
        assert one(spark, C.age_band(F.lit(founded), day)) == band, founded


def test_bounds(spark):
    assert one(spark, N.rate_upper_bound(F.lit(4), F.lit(300), 10)) == 3.4
    assert one(spark, N.rate_upper_bound(F.lit(12), F.lit(300), 10)) is None
    b = one(spark, N.share_bound(F.lit(95), F.lit(100), 10))
    assert (b.kind, b.value) == ("aspoň", 91)
    b = one(spark, N.share_bound(F.lit(3), F.lit(100), 10))
    assert (b.kind, b.value) == ("nejvýš", 9)
    assert one(spark, N.verbal(F.lit(102.0), F.lit(100.0))) == "srovnatelné"
    assert one(spark, N.verbal(F.lit(90.0), F.lit(100.0))) == "nižší"


def poisson_by_summing(mean, p):
    """Smallest k with P(X <= k) >= p, summed from far below the mean."""
    k = max(0, int(mean - 12 * math.sqrt(mean) - 12))
    term = math.exp(k * math.log(mean) - mean - math.lgamma(k + 1)) if mean > 0 else 1.0
    total = term
    while total < p:
        k += 1
        term *= mean / k
        total += term
    return k


def test_poisson_matches_the_documented_interval(spark):
    from regisight.functions.poisson import with_poisson_quantiles
    from regisight.operators.dynamics import INTERVALS

    rng = random.Random(3)
    means = [43.1, 45.6, 0.0, 1e-9, 0.025, 0.7, 1.0, 7.6, 4095.9, 4096.0, 9000.5] + [rng.uniform(0, 10 ** rng.uniform(-2, 4)) for _ in range(300)]
    df = spark.createDataFrame([(i, m, "x") for i, m in enumerate(means)] + [(1000, None, "x"), (1001, -2.0, "x")], "i int, m double, bin string")
    out = with_poisson_quantiles(df, "m", INTERVALS)
    assert out.columns == ["i", "m", "bin", *INTERVALS] and "Python" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.i: tuple(r[n] for n in INTERVALS) for r in out.collect()}
    assert got[0] == (31, 56, 23, 66) and got[1] == (33, 59, 25, 69) and got[1000] == got[1001] == (None,) * 4
    assert {i: tuple(poisson_by_summing(m, p) for p in INTERVALS.values()) for i, m in enumerate(means)} == {i: got[i] for i in range(len(means))}
    assert with_poisson_quantiles(df.filter("i = 1000"), "m", INTERVALS).first().low95 is None and with_poisson_quantiles(df.limit(0), "m", INTERVALS).isEmpty()

