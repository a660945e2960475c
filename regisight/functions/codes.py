"""Codes of classifications, sizes, ages and closures as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regisight.functions import fixed as X


def clean_code(value: Column) -> Column:
    """Code without dots and spaces, without a bracketed remark."""
    bare = F.btrim(F.substring_index(F.btrim(F.translate(value, "\n", " ")), "(", 1))
    return F.regexp_replace(bare, "[. ]", "")


def is_partial(value: Column) -> Column:
    return F.coalesce(F.contains(value, F.lit("částečně")), F.lit(False))


def code_level(code: Column) -> Column:
    """1 for a section letter, otherwise the number of characters."""
    return F.when(code.rlike("^[A-Z]$"), F.lit(1)).otherwise(F.length(code))


def is_natural(form: Column) -> Column:
    return form.isin(*X.NATURAL_FORMS)


def person_type(form: Column) -> Column:
    """FO for natural persons, PO for all other forms, also an unknown one."""
    return F.when(is_natural(form), F.lit("FO")).otherwise(F.lit("PO"))


def closure_mode(code: Column) -> Column:
    return F.when(code.isin("01", "04"), code).otherwise(F.lit("jiny"))


def size_class(code: Column) -> Column:
    """Survey class of an employee-size code. Unknown ('000' or NULL) stays NULL; a NULL is
    an unknown size here, not the largest class."""
    known = F.create_map(*[F.lit(x) for pair in X.SIZE_CODE_TO_CLASS.items() for x in pair])
    return F.when(code.isNotNull() & (code != X.SIZE_UNKNOWN), F.coalesce(known[code], F.lit("GE250")))


def size_band(code: Column) -> Column:
    """Band of the size profile; codes outside all bands are kept as 'jiné'."""
    pick = F.when(code.isNull(), F.lit("000"))
    for band, members in X.SIZE_BANDS:
        pick = pick.when(code.isin(*members), F.lit(band))
    return pick.otherwise(F.lit("jiné"))


def age_years(founded: Column, day: Column) -> Column:
    return F.date_diff(day, founded).cast("double") / F.lit(365.25)


def age_band(founded: Column, day: Column) -> Column:
    age = age_years(founded, day)
    pick = None
    for low, high, name in X.AGE_BANDS:
        inside = (age >= low) if high is None else (age >= low) & (age < high)
        pick = F.when(inside, F.lit(name)) if pick is None else pick.when(inside, F.lit(name))
    return pick


def quarter_end(period: Column) -> Column:
    """'YYYY-Qn' -> last day of the quarter."""
    year = F.substring(period, 1, 4).cast("int")
    quarter = F.substring(period, 7, 1).cast("int")
    return F.last_day(F.make_date(year, quarter * 3, F.lit(1)))


def start_2025(day: Column) -> Column:
    """Start of a 2025 code: not before 2025-01-01, an unknown start becomes that day."""
    return F.greatest(day, F.lit(X.START_2025))


def end_2025(day: Column) -> Column:
    return F.when(day < F.lit(X.START_2025), F.lit(X.START_2025)).otherwise(day)


def valid_at(start: Column, end: Column, day: Column) -> Column:
    """Half-open [start, end); an unknown bound is open."""
    return (start.isNull() | (start <= day)) & (end.isNull() | (day < end))


def comparable_period(day: Column, snapshot: Column) -> Column:
    """Month and day not after those of the snapshot."""
    return F.date_format(day, "MMdd") <= F.date_format(snapshot, "MMdd")
