"""Classification lists, the crosswalk between versions, the empirical matrix and derivation rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regisight.functions import fixed as X
from regisight.functions.codes import clean_code, is_partial, start_2025
from regisight.operators.interface import latest_rows
from regisight.plans.sizing import small_side

LEVEL_COLUMNS = ("section", "division", "grp", "cls")


# --- code lists ------------------------------------------------------------------------------------

def with_pseudo_codes(items: DataFrame) -> DataFrame:
    """items(code, level, parent) plus the register's pseudo-codes, marked pseudo."""
    rows = F.array(*[
        F.struct(F.lit(code).alias("code"), F.lit(level).alias("level"), F.lit(parent).cast("string").alias("parent"))
        for code, level, parent in X.PSEUDO_CODES
    ])
    extra = items.sparkSession.range(1).select(F.inline(rows)).withColumn("pseudo", F.lit(True))
    return items.select("code", "level", "parent").withColumn("pseudo", F.lit(False)).unionByName(extra)


def hierarchy(items: DataFrame) -> DataFrame:
    """Ancestors of every code on levels 1-4, its own level being itself. A code list is at most five
    levels deep, so four self-joins reach every root."""
    chain = items.select("code", "level", "parent", "pseudo", F.array(F.struct("level", "code")).alias("path"),
                         F.col("parent").alias("_up"))
    up = items.select(F.col("code").alias("_c"), F.col("level").alias("_l"), F.col("parent").alias("_p"))
    for _ in range(4):
        chain = chain.join(small_side(up), F.col("_up") == F.col("_c"), "left").select(
            "code", "level", "parent", "pseudo",
            F.when(F.col("_c").isNotNull(), F.array_append("path", F.struct(F.col("_l").alias("level"), F.col("_c").alias("code"))))
            .otherwise(F.col("path")).alias("path"),
            F.col("_p").alias("_up"),
        )

    def on(level: int) -> Column:
        hit = F.filter("path", lambda s: s["level"] == level)
        return F.when(F.size(hit) > 0, F.element_at(hit, 1)["code"])

    return chain.select("code", "level", "parent", "pseudo",
                        *[on(i + 1).alias(name) for i, name in enumerate(LEVEL_COLUMNS)])


def hierarchy_errors(items: DataFrame) -> DataFrame:
    """Duplicate codes, unknown parents, codes without a section. Must be empty before loading."""
    twice = items.groupBy("code").count().filter("count > 1").select("code", F.lit("duplicate code").alias("error"))
    known = items.select(F.col("code").alias("parent")).distinct()
    orphan = items.filter(F.col("parent").isNotNull()).join(known, "parent", "left_anti").select(
        "code", F.lit("unknown parent").alias("error")
    )
    rootless = hierarchy(items.dropDuplicates(["code"])).filter(F.col("section").isNull()).select(
        "code", F.lit("no section").alias("error")
    )
    return twice.unionByName(orphan).unionByName(rootless)


def ancestors(codes: DataFrame) -> DataFrame:
    """Long form (code, level, target_level, ancestor) of the closure, target not deeper than the code."""
    steps = F.array(*[
        F.struct(F.lit(i).alias("target_level"),
                 F.when(F.col("level") == i, F.col("code")).when(F.col("level") > i, named).alias("ancestor"))
        for i, named in [*((i + 1, F.col(c)) for i, c in enumerate(LEVEL_COLUMNS)), (5, F.lit(None).cast("string"))]
    ])
    return codes.select("code", "level", F.inline(steps)).filter(F.col("ancestor").isNotNull())


# --- crosswalk -------------------------------------------------------------------------------------

def assemble_pairs(forward: DataFrame, backward: DataFrame, national_old: DataFrame, national_new: DataFrame,
                   old_codes: DataFrame, new_codes: DataFrame) -> DataFrame:
    """Pairs of both converter directions (level, a, b), the national five-digit sheets (a, b) and the
    four-digit pairs lifted to xxxx0 where both five-digit codes exist. Sources without a counterpart
    carry '*' and are skipped; "partial" of the national sheets is OR-ed."""

    def clean(df: DataFrame, old: str, new: str, level: Column, partial: Column, source: int) -> DataFrame:
        return df.filter(F.col("a").isNotNull() & F.col("b").isNotNull()).select(
            clean_code(F.col(old)).alias("code_2008"), clean_code(F.col(new)).alias("code_2025"),
            level.cast("int").alias("level"), partial.alias("partial"), F.lit(source).alias("src"),
        ).filter(~F.col("code_2008").contains("*") & ~F.col("code_2025").contains("*"))

    whole = F.lit(False)
    either = is_partial(F.col("a")) | is_partial(F.col("b"))
    upper = clean(forward, "a", "b", F.col("level"), whole, 1).unionByName(clean(backward, "b", "a", F.col("level"), whole, 1))
    national = clean(national_old, "a", "b", F.lit(5), either, 2).unionByName(
        clean(national_new, "b", "a", F.lit(5), either, 2))
    lifted = (
        upper.filter(F.col("level") == 4).select(
            F.concat("code_2008", F.lit("0")).alias("code_2008"), F.concat("code_2025", F.lit("0")).alias("code_2025"),
            F.lit(5).alias("level"), "partial", F.lit(3).alias("src"))
        .join(old_codes.filter("level = 5").select(F.col("code").alias("code_2008")), "code_2008", "left_semi")
        .join(new_codes.filter("level = 5").select(F.col("code").alias("code_2025")), "code_2025", "left_semi")
    )
    return upper.unionByName(national).unionByName(lifted.select("code_2008", "code_2025", "level", "partial", "src")).groupBy(
        "level", "code_2008", "code_2025").agg(F.bool_or("partial").alias("partial"), F.min("src").alias("src"))


def link_types(pairs: DataFrame) -> DataFrame:
    """1:1, 1:N (the old code splits), N:1 (old codes merge), N:M for unique pairs of a level."""
    targets = pairs.groupBy("level", "code_2008").agg(F.count(F.lit(1)).alias("_t"))
    sources = pairs.groupBy("level", "code_2025").agg(F.count(F.lit(1)).alias("_s"))
    kind = (
        F.when((F.col("_t") == 1) & (F.col("_s") == 1), "1:1").when(F.col("_s") == 1, "1:N")
        .when(F.col("_t") == 1, "N:1").otherwise("N:M")
    )
    return pairs.join(targets, ["level", "code_2008"]).join(sources, ["level", "code_2025"]).withColumn(
        "link", kind).drop("_t", "_s")


def unknown_codes(pairs: DataFrame, old_codes: DataFrame, new_codes: DataFrame) -> DataFrame:
    """Crosswalk codes missing in the list of their version on their level."""

    def missing(column: str, codes: DataFrame, version: int) -> DataFrame:
        known = codes.select(F.col("code").alias("_c"), F.col("level").alias("_l"))
        return pairs.join(known, (F.col(column) == F.col("_c")) & (F.col("level") == F.col("_l")), "left_anti").select(
            F.lit(version).alias("version"), F.col(column).alias("code"), "level").distinct()

    return missing("code_2008", old_codes, 2008).unionByName(missing("code_2025", new_codes, 2025))


# --- empirical matrix ------------------------------------------------------------------------------

def official_main(history: DataFrame, version: int) -> DataFrame:
    rows = history.filter((F.col("version") == version) & (F.col("kind") == X.MAIN) & (F.col("source") == X.OFFICIAL))
    return latest_rows(rows, ["ico"], ["start", "code"], ["code", "start"])


def transition_matrix(history: DataFrame, old_codes: DataFrame, new_codes: DataFrame) -> DataFrame:
    """Counts of dual-coded subjects per (old code or ancestor, target level, new code) with base and share.

    Subjects are counted per pair of full codes first; only these few pairs meet the code lists and are
    unpivoted to 5 x 5 levels."""
    old = official_main(history, 2008).select("ico", F.col("code").alias("c08"), start_2025(F.col("start")).alias("s08"))
    new = official_main(history, 2025).select("ico", F.col("code").alias("c25"), F.col("start").alias("s25"))
    pairs = old.join(new, "ico").filter(F.col("s25").eqNullSafe(F.col("s08"))).groupBy("c08", "c25").agg(
        F.count(F.lit(1)).alias("n"))
    a = ancestors(old_codes).select(F.col("code").alias("c08"), F.col("target_level").alias("level_2008"),
                                    F.col("ancestor").alias("code_2008"))
    b = ancestors(new_codes).select(F.col("code").alias("c25"), F.col("target_level").alias("level"),
                                    F.col("ancestor").alias("code_2025"))
    spread = pairs.join(small_side(a), "c08").join(small_side(b), "c25").filter(F.col("level") <= F.col("level_2008"))
    counts = spread.groupBy("code_2008", "level_2008", "level", "code_2025").agg(F.sum("n").alias("count"))
    base = counts.groupBy("code_2008", "level").agg(F.sum("count").alias("base"))
    return counts.join(base, ["code_2008", "level"]).withColumn(
        "share", F.round(F.col("count").cast("double") / F.col("base"), 4))


def top_targets(matrix: DataFrame) -> DataFrame:
    """Most frequent target per (old code, level); the smallest code on ties."""
    order = F.struct((-F.col("count")).alias("n"), F.col("code_2025").alias("c"))
    return matrix.groupBy("code_2008", "level").agg(
        F.min_by(F.struct("code_2025", "count"), order).alias("t"), F.first("base").alias("base")
    ).select("code_2008", "level", F.col("t.code_2025").alias("top"), F.col("t.count").alias("top_count"), "base")


def derivation_rules(old_codes: DataFrame, new_codes: DataFrame, crosswalk: DataFrame, matrix: DataFrame) -> DataFrame:
    """Rule for every old code and target level, all as one join plan.

    Priority: a 1:1 link of the code itself or of its ancestor on the target level; a single candidate
    of the crosswalk; the most frequent empirical target (base >= MIN_BASE); ambiguous with candidates.
    A different empirical target with share >= CONFLICT_SHARE overrides the crosswalk."""
    c = F.col
    base = ancestors(old_codes).select(c("code").alias("code_2008"), c("target_level").alias("level"), c("ancestor"))
    up = ancestors(new_codes).select(c("code").alias("code_2025"), c("target_level").alias("level"), c("ancestor").alias("target"))
    pairs = crosswalk.select("code_2008", "code_2025", "link")
    single = pairs.groupBy("code_2008").agg(
        F.count(F.lit(1)).alias("n"), F.first("code_2025").alias("code_2025"), F.first("link").alias("link")
    ).filter((c("n") == 1) & (c("link") == "1:1")).select("code_2008", "code_2025")
    direct = single.join(up, "code_2025").select("code_2008", "level", "target")
    candidates = pairs.join(up, "code_2025").groupBy("code_2008", "level").agg(
        F.array_sort(F.collect_set("target")).alias("candidates"))  # bounded by the code list of one level
    j = (
        base.join(direct.withColumnRenamed("target", "own"), ["code_2008", "level"], "left")
        .join(direct.select(c("code_2008").alias("ancestor"), "level", c("target").alias("via")), ["ancestor", "level"], "left")
        .join(candidates, ["code_2008", "level"], "left")
        .join(top_targets(matrix), ["code_2008", "level"], "left")
    )
    n_base = F.coalesce("base", F.lit(0))
    linked = F.coalesce("own", "via")
    only = F.when(F.size("candidates") == 1, F.element_at("candidates", 1))
    proposed = F.coalesce(linked, only)
    share = F.round(c("top_count").cast("double") / c("base"), 4)
    enough = n_base >= X.MIN_BASE
    conflict = F.coalesce(
        proposed.isNotNull() & enough & (c("top") != proposed)
        & (c("top_count").cast("double") / c("base") >= X.CONFLICT_SHARE), F.lit(False))
    method = (
        F.when(conflict, "empiricky_rozpor").when(linked.isNotNull(), "prevodnik_1:1")
        .when(only.isNotNull(), "prevodnik_jediny_cil").when(enough, "empiricky").otherwise(X.AMBIGUOUS)
    )
    return j.withColumn("method", method).select(
        "code_2008", "level",
        F.when(conflict, c("top")).when(proposed.isNotNull(), proposed).when(enough, c("top")).alias("code_2025"),
        F.when(conflict, share).when(proposed.isNotNull(), 1.0).when(enough, share).cast("decimal(5,4)").alias("certainty"),
        "method", n_base.cast("bigint").alias("base"),
        F.when(c("method") == X.AMBIGUOUS, F.coalesce("candidates", F.array().cast("array<string>"))).alias("candidates"),
        F.when(conflict, proposed).alias("crosswalk_target"),
    )


def conflicts(rules: DataFrame) -> DataFrame:
    return rules.filter(F.col("method") == "empiricky_rozpor").select(
        "code_2008", "level", "crosswalk_target", F.col("code_2025").alias("empirical_target"),
        F.col("certainty").alias("share"), "base")


def derived_codes(history: DataFrame, rules: DataFrame) -> DataFrame:
    """One derived 2025 row per level for every official 2008 state without an official 2025 state.
    The result replaces all derived rows."""
    main = history.filter((F.col("kind") == X.MAIN) & (F.col("source") == X.OFFICIAL))
    old = main.filter(F.col("version") == 2008).select("ico", "code", "start", "end")
    new = main.filter(F.col("version") == 2025).select(F.col("ico").alias("_i"), F.col("start").alias("_s"))
    open_states = old.join(
        new, (F.col("ico") == F.col("_i")) & start_2025(F.col("start")).eqNullSafe(F.col("_s")), "left_anti")
    r = rules.select(F.col("code_2008").alias("code"), "level", "code_2025", "certainty", "method", "candidates")
    return open_states.withColumnRenamed("code", "derived_from").join(
        small_side(r.withColumnRenamed("code", "derived_from")), "derived_from"
    ).select(
        "ico", F.lit(2025).alias("version"), F.col("code_2025").alias("code"), "level", F.lit(X.MAIN).alias("kind"),
        F.lit(X.DERIVED).alias("source"), F.col("method").alias("detail"), "certainty",
        F.when(F.col("code_2025").isNull(), X.AMBIGUOUS).alias("flag"), "candidates", "derived_from", "start", "end",
        F.lit(None).cast("string").alias("close_reason"), F.lit(None).cast("int").alias("batch_id"),
    )
