"""Checks of whole texts: banned vocabulary and grounding of numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regisight.functions import fixed as X

BANNED = r"fir(?:m|em)|aktivn"


def banned_words(text: Column, stem: str = BANNED, allowed_start: str = "aktivn", allowed_next: str = "podnik") -> Column:
    """Words with a banned stem, in order of appearance. Words with an underscore are exempt, and so is
    a word starting with allowed_start followed by allowed_next."""
    pattern = (rf"(?iU)(?<!\w)(?!\w*_)(?!{allowed_start}\w*\s+{allowed_next})\w*(?:{stem})\w*")
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def banned_vocabulary(texts: DataFrame, key: str, text: str, **rule: str) -> DataFrame:
    """Texts with banned words and those words. One pass, no shuffle."""
    return texts.select(key, banned_words(F.col(text), **rule).alias("words")).filter(F.size("words") > 0)


def normal_number(raw: Column) -> Column:
    """Thousands marks out, decimal comma to point, trailing zeros out."""
    t = F.translate(F.regexp_replace(raw, "[\\s\u00a0\u202f]", ""), ",", ".")
    head = F.regexp_replace(F.regexp_extract(t, r"^(\d+)", 1), r"^0+(?=\d)", "")
    tail = F.regexp_replace(F.regexp_extract(t, r"\.(\d+)$", 1), "0+$", "")
    return F.when(tail == "", head).otherwise(F.concat_ws(".", head, tail))


def numbers_in(text: Column) -> Column:
    """Normalised numbers of a text, without page marks and references to tables and charts."""
    bare = F.regexp_replace(F.regexp_replace(text, X.PAGE_MARK, " "), X.TABLE_REFERENCE, " ")
    return F.array_distinct(F.transform(F.regexp_extract_all(bare, F.lit(X.TYPESET_NUMBER), F.lit(0)), normal_number))


def source_numbers(values: DataFrame, numeric: list[str], textual: list[str]) -> DataFrame:
    """Allowed numbers of the data: numeric columns without their sign, numbers inside text columns."""
    parts = [F.array(normal_number(F.abs(F.col(c)).cast("decimal(38,9)").cast("string"))) for c in numeric]
    parts += [F.transform(F.regexp_extract_all(F.col(c), F.lit(p), F.lit(0)), normal_number)
              for c in textual for p in (X.TYPESET_NUMBER, X.SPACED_NUMBER)]
    return values.select(F.explode(F.array_compact(F.array_distinct(F.concat(*parts)))).alias("number")).distinct()


def ungrounded_numbers(texts: DataFrame, key: str, text: str, allowed: DataFrame) -> DataFrame:
    """Numbers of a text that do not occur in the data.

    Numbers are first reduced to the distinct ones, those are checked, and only the failing ones go
    back to their texts, so a number found in very many texts costs one lookup."""
    found = texts.select(F.col(key), F.explode(numbers_in(F.col(text))).alias("number"))
    missing = found.select("number").distinct().join(allowed, "number", "left_anti")
    return found.join(missing, "number").select(key, "number")
