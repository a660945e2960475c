"""Text keys and fingerprints as column expressions."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _accent_map() -> tuple[str, str]:
    """Accented Latin letters and their base letters, derived from Unicode decomposition."""
    source, target = [], []
    for point in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        letter = chr(point)
        base = "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c))
        if len(base) == 1 and base != letter:
            source.append(letter)
            target.append(base)
    return "".join(source), "".join(target)


_ACCENTED, _PLAIN = _accent_map()


def without_accents(text: Column) -> Column:
    """Latin letters without accents; also drops free-standing combining marks."""
    return F.regexp_replace(F.translate(text, _ACCENTED, _PLAIN), r"\p{Mn}+", "")


def plain_text(text: Column) -> Column:
    """Key form of a name: no accents, trimmed, lower case, single spaces, NULL -> ''."""
    return F.lower(F.regexp_replace(F.btrim(without_accents(F.coalesce(text, F.lit("")))), r"\s+", " "))


def plain_words(text: Column) -> Column:
    """Like plain_text, but every run of other characters becomes one space."""
    return F.btrim(F.regexp_replace(F.lower(without_accents(F.coalesce(text, F.lit("")))), "[^a-z0-9]+", " "))


def person_key(first: Column, last: Column, born: Column) -> Column:
    return F.concat_ws(
        "|", plain_text(first), plain_text(last), F.coalesce(F.date_format(born, "yyyy-MM-dd"), F.lit("?"))
    )


def address_fingerprint(
    street: Column, house: Column, registration: Column, orientation: Column, town: Column,
    town_part: Column, zip_code: Column, country: Column, original: Column,
) -> Column:
    """md5 over the nine normalised parts of an address."""

    def soft(c: Column) -> Column:
        return F.lower(F.btrim(F.coalesce(c, F.lit(""))))

    parts = [soft(c) for c in (street, house, registration, orientation, town, town_part)]
    parts.append(F.replace(F.coalesce(zip_code, F.lit("")), F.lit(" "), F.lit("")))
    parts.append(F.upper(F.coalesce(country, F.lit(""))))
    parts.append(soft(original))
    return F.md5(F.concat_ws("|", *parts))


def row_hash(columns: list[str]) -> Column:
    """Content hash of the named columns; NULL and '' differ, column order does not matter."""
    return F.md5(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}))


def valid_id(ico: Column) -> Column:
    """Eight digits whose last one is the modulo-11 check digit; anything else is false."""
    weighted = sum((F.substring(ico, i, 1).cast("int") * (9 - i) for i in range(1, 8)), F.lit(0))
    rest = weighted % 11
    digit = F.when(rest == 0, 1).when(rest == 1, 0).otherwise(11 - rest)
    return F.when(ico.rlike("^[0-9]{8}$"), F.substring(ico, 8, 1).cast("int") == digit).otherwise(F.lit(False))


def finding_id(prefix: Column, key: Column) -> Column:
    """Z + kind + four letters: base-26 digits, lowest first, of the SHA-256 of the key."""
    base = 26 ** 4
    digest = F.sha2(key, 256)
    value = F.lit(0).cast("bigint")
    for i in range(0, 64, 8):
        part = F.conv(F.substring(digest, i + 1, 8), 16, 10).cast("bigint")
        value = (value * F.lit(16 ** 8).cast("bigint") + part) % base
    letters = [F.chr(F.lit(65) + F.floor(value / (26 ** i)).cast("bigint") % 26) for i in range(4)]
    return F.concat(F.lit("Z"), prefix, F.lit("-"), *letters)


# --- fixed values: rank words of a function text, first match wins ------------
RANK_WORDS = (("MISTOPREDSEDA", r"\bmistop"), ("PREDSEDA", r"\bpredsed|\bpreds\b|\bpred\b"), ("CLEN", r"\bclen|^$"))
RANKS = tuple(code for code, _ in RANK_WORDS)


@dataclass(frozen=True)
class Body:
    """A body of the role code list: the organ types it is registered under and what else tells it. Any one of its marks is
    enough, none means the organ type alone. With ranks a role reads rank_code, without them the code is the role."""

    code: str
    organ_type: str
    in_organ: str = ""
    in_function: str = ""
    forms: tuple[str, ...] = ()
    only_without_function: bool = False  # the legal form tells it only where no function is named
    ranks: tuple[str, ...] = ()
    needs_rank: bool = False  # without one of its ranks it is another body


_STATUTORY = "STATUTARNI_ORGAN"
# --- fixed values: bodies and their marks, of several that are told the first one ----
BODIES = (
    Body("PROKURISTA", "PROKURA"),
    Body("LIKVIDATOR", "LIKVIDATOR"),
    Body("KOMPLEMENTAR", "KOMPLEMENTAR"),
    Body("SPOLECNIK", "SPOLECNIK"),
    Body("KOMANDITISTA", "KOMANDITISTA"),
    Body("JEDINY_AKCIONAR", "AKCIONAR"),
    Body("DOZORCI_RADY", "DOZORCI_RADA", ranks=RANKS),
    Body("KONTROLNI_KOMISE", "KONTROLNI_KOMISE", ranks=RANKS),
    Body("KOMPLEMENTAR", _STATUTORY, in_organ="komplementar"),
    Body("SPOLECNIK", _STATUTORY, in_organ="spolecnik"),
    Body("STATUTARNI_REDITEL", _STATUTORY, in_organ="statutarni reditel", in_function="statutarni reditel"),
    Body("SPRAVNI_RADY", _STATUTORY, in_organ="spravni rada", in_function="spravni rad", ranks=("PREDSEDA", "CLEN")),
    Body("JEDNATEL", _STATUTORY, in_function="jednatel", forms=("112",), only_without_function=True),
    Body("DRUZSTVA", _STATUTORY, in_function="druzstv", ranks=("PREDSEDA", "MISTOPREDSEDA"), needs_rank=True),
    Body("PREDSTAVENSTVA", _STATUTORY, in_organ="predstav", in_function="predstav", forms=("121", "205"), ranks=RANKS),
)


def with_role(df: DataFrame, organ_type: str, organ_name: str, function: str, form: str, name: str = "role_code") -> DataFrame:
    """Adds the role of a member, read from the organ and the free-text function; NULL when it cannot be
    told. Of the bodies that are told the first one in the table gives the role, or none
    where the member's rank is not one of the body's. Normalised texts and the rank are columns of their own steps, so
    each is computed once."""
    c = F.col
    # generated rows: a filter on the role is not pushed below them, which would repeat the texts in each place that reads them
    worded = df.select("*", F.inline(F.array(F.struct(plain_words(c(organ_name)).alias("_organ"), plain_words(c(function)).alias("_job")))))
    ranked = worded.withColumn("_rank", F.coalesce(*[F.when(c("_job").rlike(pattern), F.lit(code)) for code, pattern in RANK_WORDS]))

    def told(b: Body) -> Column:
        marks = [c(text).contains(word) for text, word in (("_organ", b.in_organ), ("_job", b.in_function)) if word]
        if b.forms:
            marks.append(c(form).isin(*b.forms) & (c("_job") == "" if b.only_without_function else F.lit(True)))
        needed = [c(organ_type) == b.organ_type, *([reduce(or_, marks)] if marks else [])]
        if b.needs_rank:
            needed.append(c("_rank").isin(*b.ranks))
        return reduce(and_, needed)

    def role(b: Body) -> Column:
        return F.when(c("_rank").isin(*b.ranks), F.concat(c("_rank"), F.lit(f"_{b.code}"))) if b.ranks else F.lit(b.code)

    (first, *others) = BODIES
    chosen = reduce(lambda chain, b: chain.when(told(b), role(b)), others, F.when(told(first), role(first)))
    return ranked.select("*", F.inline(F.array(F.struct(chosen.alias(name))))).drop("_organ", "_job", "_rank")
