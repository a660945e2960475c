"""Snapshot quality, comparison with published counts, intersection summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regisight.functions import fixed as X
from regisight.functions.codes import quarter_end
from regisight.operators import territory as T
from regisight.plans.sizing import small_side

# --- fixed values: quality metrics in their order ------------------------------
METRICS = (
    (1, "radky"), (2, "se_zanikem"), (3, "bez_zaniku"), (4, "zanik_jen_ico"), (10, "nace_prazdne"),
    (11, "nace_pseudokod"), (12, "nace_mimo_ciselnik"), (13, "bez_nace_sekce"), (14, "nace2025_prazdne"),
    (20, "uzemi_prazdne"), (21, "uzemi_mimo_ciselnik"), (22, "bez_kraje"), (30, "katpo_prazdne"),
    (31, "katpo_neuvedeno"), (32, "katpo_mimo_ciselnik"), (33, "bez_kategorie_pracovniku"), (40, "forma_prazdna"),
    (41, "forma_mimo_ciselnik"), (42, "vznik_prazdny"), (43, "adresni_misto_prazdne"),
)
GATED = ("bez_nace_sekce", "bez_kraje")


class QualityGateError(ValueError):
    """The share of unassignable living subjects exceeds the limit."""


def label(df: DataFrame, lists: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """Left joins to code lists: (list, fact column, list key). Unmatched codes keep NULL labels."""
    for codes, column, key in lists:
        df = df.join(small_side(codes), F.col(column) == F.col(key), "left").drop(key)
    return df


def quality_metrics(snapshot: DataFrame, nace: DataFrame, districts: DataFrame, sizes: DataFrame,
                    forms: DataFrame) -> DataFrame:
    """Quality of a snapshot in three bases: all, living (bez_zaniku), closed (se_zanikem).

    snapshot(snapshot, ico, name, founded, closed, forma, district, nace, nace2025, katpo, address_code),
    nace(code, pseudo), the other lists (code). The snapshot is read once; the base "all" is the sum
    of the two aggregated halves."""
    known = label(
        snapshot,
        [(nace.select(F.col("code").alias("_n"), F.col("code").alias("n_code"), "pseudo"), "nace", "_n"),
         (districts.select(F.col("code").alias("_d"), F.col("code").alias("d_code")), "district", "_d"),
         (sizes.select(F.col("code").alias("_s"), F.col("code").alias("s_code")), "katpo", "_s"),
         (forms.select(F.col("code").alias("_f"), F.col("code").alias("f_code")), "forma", "_f")],
    )
    c = F.col
    closed = c("closed").isNotNull()
    no_nace, pseudo, off_nace = c("nace").isNull(), F.coalesce("pseudo", F.lit(False)), c("nace").isNotNull() & c("n_code").isNull()
    no_place, off_place = c("district").isNull(), c("district").isNotNull() & c("d_code").isNull()
    no_size, size_000 = c("katpo").isNull(), F.coalesce(c("katpo") == X.SIZE_UNKNOWN, F.lit(False))
    off_size = c("katpo").isNotNull() & c("s_code").isNull()
    flags = {
        "radky": F.lit(True), "se_zanikem": closed, "bez_zaniku": ~closed,
        "zanik_jen_ico": closed & c("founded").isNull() & c("forma").isNull() & no_place & no_nace & c("name").isNull(),
        "nace_prazdne": no_nace, "nace_pseudokod": pseudo, "nace_mimo_ciselnik": off_nace,
        "bez_nace_sekce": no_nace | pseudo | off_nace, "nace2025_prazdne": c("nace2025").isNull(),
        "uzemi_prazdne": no_place, "uzemi_mimo_ciselnik": off_place, "bez_kraje": no_place | off_place,
        "katpo_prazdne": no_size, "katpo_neuvedeno": size_000, "katpo_mimo_ciselnik": off_size,
        "bez_kategorie_pracovniku": no_size | size_000 | off_size, "forma_prazdna": c("forma").isNull(),
        "forma_mimo_ciselnik": c("forma").isNotNull() & c("f_code").isNull(),
        "vznik_prazdny": c("founded").isNull(), "adresni_misto_prazdne": c("address_code").isNull(),
    }
    halves = known.groupBy("snapshot", closed.alias("gone")).agg(*[F.count_if(f).alias(m) for m, f in flags.items()])
    bases = F.array(F.lit("vse"), F.when(c("gone"), F.lit("se_zanikem")).otherwise(F.lit("bez_zaniku")))
    wide = halves.withColumn("base", F.explode(bases)).groupBy("snapshot", "base").agg(
        *[F.sum(m).alias(m) for m in flags]
    )
    rows = F.array(*[
        F.struct(F.lit(order).alias("ord"), F.lit(m).alias("metric"), c(m).alias("count")) for order, m in METRICS
    ])
    total = c("radky")
    share = F.round(c("count").cast("double") / F.nullif(c("denominator"), F.lit(0)), 6)
    return wide.select("snapshot", "base", total.alias("denominator"), F.inline(rows)).withColumn("share", share)


def exceeded(metrics: DataFrame, limit: float = X.MISSING_LIMIT) -> DataFrame:
    return metrics.filter((F.col("base") == "bez_zaniku") & F.col("metric").isin(*GATED) & (F.col("share") > limit))


def quality_gate(metrics: DataFrame, limit: float = X.MISSING_LIMIT) -> None:
    """Stops the load when a gated share exceeds the limit."""
    bad = exceeded(metrics, limit).select("metric", "share").collect()  # at most two rows per snapshot
    if bad:
        raise QualityGateError("; ".join(f"{r.metric}: {r.share}" for r in bad))


def region_section_counts(snapshot: DataFrame) -> DataFrame:
    """Living subjects per snapshot, region and section; NULL = cannot be placed."""
    return snapshot.filter(F.col("closed").isNull()).groupBy("snapshot", "region", "section").agg(
        F.count(F.lit(1)).alias("n")
    )


def compare_with_published(snapshot: DataFrame, published: DataFrame, selection: str, category: Column) -> DataFrame:
    """Own counts (region x industry category, with totals) against the latest published quarter.

    published(selection, indicator, territory, nace, period, value), indicators 'reg' and 'akt'.
    The reference period is a scalar subquery, all cells of either side are kept."""
    chosen = published.filter(F.col("selection") == selection)
    period = chosen.agg(F.max("period").alias("p")).select("p").scalar()
    until = quarter_end(period)
    tagged = snapshot.select(
        "region", category.alias("nace"), F.col("closed").isNull().alias("living"),
        F.coalesce((F.col("founded") <= until) & (F.col("closed").isNull() | (F.col("closed") > until)), F.lit(False))
        .alias("existed"),
    ).filter(F.col("living") | F.col("existed"))
    # counted per cell first: the cube then expands a code-list sized input
    cells = tagged.groupBy("region", "nace").agg(
        F.count_if("living").alias("living"), F.count_if("existed").alias("existed")
    )
    own = cells.cube("region", "nace").agg(
        F.sum("living").alias("own_living"), F.sum("existed").alias("own_existing"),
        F.grouping("region").alias("gr"), F.grouping("nace").alias("gn"),
    ).select(
        F.when(F.col("gr") == 1, T.STATE_CODE).otherwise(F.coalesce("region", F.lit("?"))).alias("territory"),
        F.when(F.col("gn") == 1, "0").otherwise(F.col("nace")).alias("nace"), "own_living", "own_existing",
    )
    theirs = chosen.filter(F.col("period") == period).groupBy("territory", "nace").agg(
        F.max(F.when(F.col("indicator") == "reg", F.col("value"))).alias("registered"),
        F.max(F.when(F.col("indicator") == "akt", F.col("value"))).alias("active"),
    )
    j = theirs.join(own, ["territory", "nace"], "full_outer")
    living = F.coalesce("own_living", F.lit(0))
    existing = F.coalesce("own_existing", F.lit(0))
    reg = F.col("registered")
    base = F.nullif(reg, F.lit(0)).cast("double")
    return j.select(
        "territory", "nace", living.alias("own_living"), existing.alias("own_existing"),
        reg.cast("bigint").alias("registered"), F.col("active").cast("bigint").alias("active"),
        (living - reg.cast("bigint")).alias("difference"),
        F.round(100.0 * (living - reg) / base, 2).alias("difference_pct"),
        F.round(100.0 * (existing - reg) / base, 2).alias("difference_existing_pct"),
        F.when(reg.isNull() | (reg == 0), living > 0)
        .otherwise(F.abs(living - reg) > X.PUBLISHED_GAP * reg).alias("over_10_pct"),
        F.round(100.0 * F.col("active") / base, 1).alias("active_share_pct"),
    )


def intersection_summary(snapshot: DataFrame, threshold: int = X.MIN_CELL) -> DataFrame:
    """Living subjects of every section x region: total, by form, by size, by founding year; counts
    below the threshold are flagged and not publishable. One scan with grouping sets."""
    s = snapshot.filter(F.col("closed").isNull()).select(
        "section", "region", "forma", "katpo", F.year("founded").cast("string").alias("year")
    ).groupBy("section", "region", "forma", "katpo", "year").agg(F.count(F.lit(1)).alias("n"))
    sets = [["section", "region"], ["section", "region", "forma"], ["section", "region", "katpo"],
            ["section", "region", "year"]]
    g = s.groupingSets(
        [[F.col(c) for c in one] for one in sets],
        "section", "region", "forma", "katpo", "year",
    ).agg(F.sum("n").alias("n"), F.grouping("forma").alias("gf"), F.grouping("katpo").alias("gk"),
          F.grouping("year").alias("gy"))
    by_form, by_size, by_year = F.col("gf") == 0, F.col("gk") == 0, F.col("gy") == 0
    return g.select(
        "section", "region",
        F.when(by_form, "pravni_forma").when(by_size, "kategorie_pracovniku").when(by_year, "rok_vzniku")
        .otherwise("celkem").alias("breakdown"),
        F.when(by_form, 1).when(by_size, 2).when(by_year, 3).otherwise(0).alias("breakdown_order"),
        F.when(by_form, F.col("forma")).when(by_size, F.col("katpo")).when(by_year, F.col("year")).alias("code"),
        "n", (F.col("n") < threshold).alias("below_threshold"),
        F.when(F.col("n") >= threshold, F.col("n")).alias("n_publishable"),
    )


def intersection_order() -> list[Column]:
    """Breakdowns in order, founding years chronologically, the rest by count, then code."""
    return [
        F.col("breakdown_order").asc(),
        F.when(F.col("breakdown") == "rok_vzniku", F.col("code")).asc_nulls_last(),
        F.col("n").desc(),
        F.col("code").asc_nulls_last(),
    ]
