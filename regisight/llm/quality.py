"""Quality rules: a threshold table compiled into one projection (native).

Every measure is a built-in expression over one row, every rule a row of RULES, and the verdict one boolean
column. Defined results: a null text has no words and fails the base rules; an empty table gives an empty
table; repeated rows are judged each by itself; other columns are kept by filter_documents and ignored else.
Texts of any length are judged whole: repeats are found by sorting, never by comparing all windows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent function words of the corpus languages.
STOP_WORDS = (
    "the of and to in is that for it was on are with as be this by from or a an at not "
    "der die das und ist von mit den dem des zu im für nicht sich auf ein eine als auch "
    "de la le les et en un une du que qui est dans pour par sur au pas "
    "el los las y del se con por para su al lo como no una"
).split()

#: Patterns of the base measures.
SPACE, SYMBOLS = "[\\x20\\x09-\\x0D]+", "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: The threshold table. Ratios are per word or per line; a document is kept if all rules hold.
RULES = (
    Rule("word_length", "mean_word_length", 2.0, 20.0),
    Rule("symbols", "symbol_ratio", None, 0.2),
    Rule("stop_words", "stop_word_ratio", 0.02, None),
    Rule("duplicate_lines", "duplicate_line_ratio", None, 0.6),
)
BASE_WORDS, BASE_REPEAT_PERCENT = 50, 50


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice. Texts without an equal pair of window hashes
    have none. Else the windows are sorted by hash with their positions, neighbours whose words are equal
    give the repeated positions, and sorted positions p cover min(3, next - p) words."""

    def hash_at(x: Column, i: Column) -> Column:
        return F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2))

    def same(x: Column, y: Column) -> Column:
        i, j = x["i"], y["i"]
        return (x["g"] == y["g"]) & (F.get(words, i) == F.get(words, j)) & (F.get(words, i + 1) == F.get(words, j + 1)) & (F.get(words, i + 2) == F.get(words, j + 2))

    def repeated(s: Column) -> Column:
        return F.sort_array(F.filter(F.transform(s, lambda x, k: F.when(
            F.coalesce(same(x, F.get(s, k - 1)), F.lit(False)) | F.coalesce(same(x, F.get(s, k + 1)), F.lit(False)), x["i"])), lambda p: p.isNotNull()))

    full = F.size(words) - 2
    windows = F.sort_array(F.filter(F.transform(words, lambda x, i: F.struct(hash_at(x, i).alias("g"), i.alias("i"))), lambda x: x["i"] < full))
    covered = _let(windows, lambda s: _let(repeated(s), lambda at: F.aggregate(
        F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x)))
    distinct = F.size(F.array_distinct(F.slice(F.transform(words, hash_at), F.lit(1), full)))
    return F.when(full < 2, F.lit(0).cast("long")).when(distinct == full, F.lit(0).cast("long")).otherwise(covered)


def _let(value: Column, body) -> Column:
    """body over value evaluated once: a lambda over a one-element array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def measures(text: Column) -> Column:
    """The measures of a text (not null) as one struct; words and lines are bound once."""

    def of(words: Column, lines: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeat_words(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: w.isin(*STOP_WORDS, *(x.capitalize() for x in STOP_WORDS)))).cast("long").alias("n_stop_words"))

    all_words = F.filter(F.split(text, SPACE, -1), lambda w: w != "")
    all_lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, " \t\n\x0b\f\r", "")) > 0)
    return _let(all_words, lambda words: _let(all_lines, lambda lines: of(words, lines)))


def verdict(m: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """(base_failed, kept) of a struct of measures."""
    n = F.greatest(m["n_words"], F.lit(1)).cast("double")
    ratios = {
        "mean_word_length": m["word_chars"] / n,
        "symbol_ratio": m["n_symbols"] / n,
        "stop_word_ratio": m["n_stop_words"] / n,
        "duplicate_line_ratio": m["n_dup_lines"] / F.greatest(m["n_lines"], F.lit(1)),
    }
    base = (m["n_words"] < BASE_WORDS) | (F.lit(100) * m["n_repeat_words"] > F.lit(BASE_REPEAT_PERCENT) * m["n_words"])
    holds = ~base
    for r in rules:
        if r.least is not None:
            holds = holds & (ratios[r.measure] >= r.least)
        if r.most is not None:
            holds = holds & (ratios[r.measure] <= r.most)
    return base, holds


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Id, measures, base_failed and kept of every row."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    m = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text")).select("doc_id", measures(F.col("text")).alias("m"))
    base, kept = verdict(F.col("m"), rules)
    return m.select("doc_id", "m.*", base.alias("base_failed"), kept.alias("kept"))


def filter_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that are kept, with all their columns; one filter over the row itself, without a join."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.filter(_let(measures(text), lambda m: verdict(m, rules)[1]))
