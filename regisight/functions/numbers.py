"""Parsing of numbers and rounding rules. Rounding is half-up everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regisight.functions import fixed as X

PLAIN_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)$"


def parse_number(text: Column) -> Column:
    """'8000;00', '1 234,5' -> decimal; anything else -> NULL."""
    t = F.replace(F.translate(F.btrim(text), ";,", ".."), F.lit(" "), F.lit(""))
    return F.when(t.rlike(PLAIN_NUMBER), t).try_cast("decimal(30,8)")


def money_currency(kind: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in X.MONEY_TYPES.items() for x in pair])
    return F.when(kind.isin(*X.MONEY_TYPES), known[kind])


def money_amount(kind: Column, value: Column) -> Column:
    return F.when(kind.isin(*X.MONEY_TYPES), parse_number(value).cast("decimal(18,2)"))


def percent(kind: Column, value: Column) -> Column:
    p = parse_number(value)
    return F.when((kind == "PROCENTA") & p.between(0, 100), p)


def share_percent(kind: Column, value: Column) -> Column:
    """Share in percent from 'PROCENTA', a fraction a/b or a;b, or a text 'x %'; free text -> NULL."""
    t = F.btrim(value)
    pct = r"^(\d+(?:[.,]\d+)?)\s*%$"
    frac = r"^(\d+)\s*[/;]\s*(\d+)$"
    top = F.regexp_extract(t, frac, 1).try_cast("decimal(18,0)")
    bottom = F.regexp_extract(t, frac, 2).try_cast("decimal(18,0)")
    p = (
        F.when(kind == "PROCENTA", parse_number(t))
        .when((kind == "TEXT") & t.rlike(pct), parse_number(F.regexp_extract(t, pct, 1)))
        .when(kind.isin("ZLOMEK", "TEXT") & t.rlike(frac) & (bottom > 0), top * 100 / F.nullif(bottom, F.lit(0)))
    )
    return F.when(p.between(0, 100), F.round(p, 4).cast("decimal(7,4)"))


def ratio(part: Column, whole: Column, digits: int, scale: float = 1.0) -> Column:
    """round(scale * part / whole), NULL on an empty base."""
    base = whole.cast("double")
    return F.when(base != 0, F.round(F.lit(float(scale)) * part.cast("double") / base, digits))


def pct(part: Column, whole: Column, digits: int = 1) -> Column:
    return ratio(part, whole, digits, 100.0)


def relative(a: Column, b: Column) -> Column:
    return F.when(b.cast("double") != 0, a.cast("double") / b.cast("double") - 1)


def verbal(a: Column, b: Column) -> Column:
    """Comparison in words with the 3 % rule."""
    r = relative(a, b)
    return (
        F.when(F.abs(r) < X.FINDING_MIN, F.lit("srovnatelné"))
        .when(r > 0, F.lit("vyšší"))
        .when(r < 0, F.lit("nižší"))
    )


def rate_upper_bound(count: Column, stock: Column, threshold: int) -> Column:
    """Upper bound in percent (0.1 up) of a rate whose count is below the threshold."""
    return F.when((count < threshold) & (stock > 0), F.ceil(F.lit(1000 * threshold) / stock) / F.lit(10.0))


def share_bound(part: Column, whole: Column, threshold: int) -> Column:
    """struct(kind, value): 'at least' / 'at most' percent when exactly one side is below the threshold."""
    rest = whole - part
    return F.when(
        (part >= threshold) & (rest < threshold),
        F.struct(F.lit("aspoň").alias("kind"),
                 F.floor(F.lit(100) * (whole - threshold + 1) / whole).cast("bigint").alias("value")),
    ).when(
        (part < threshold) & (rest >= threshold),
        F.struct(F.lit("nejvýš").alias("kind"),
                 F.ceil(F.lit(100 * (threshold - 1)) / whole).cast("bigint").alias("value")),
    )
