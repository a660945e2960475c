"""One row per subject: its industry in the new classification, with certainty and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regisight.functions import fixed as X
from regisight.operators import territory as T
from regisight.plans.sizing import small_side


def latest_rows(df: DataFrame, keys: list[str], order: list[str], carried: list[str]) -> DataFrame:
    """The row with the largest order values per key, NULLs last. An aggregation instead of a window:
    it combines before the shuffle, so a hot key costs no more than any other."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*carried), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def company_interface(history: DataFrame, old_codes: DataFrame, new_codes: DataFrame) -> DataFrame:
    """Official 2025 code first, else the last derived state with a certainty per level; the 2008 code as
    attribute; automatic link when official or the division certainty is high enough."""
    c = F.col
    main = history.filter(c("kind") == X.MAIN)
    official = c("source") == X.OFFICIAL
    state = F.struct("code", "start", "end")
    order = F.struct("start", "code")

    def last(version: int) -> Column:
        hit = official & (c("version") == version)
        return F.max_by(F.when(hit, state), F.when(hit, order))

    per_subject = main.groupBy("ico").agg(last(2025).alias("r"), last(2008).alias("o8"))
    derived = main.filter(c("source") == X.DERIVED)
    level = {i: c("level") == i for i in range(1, 6)}
    names = ("section", "division", "grp", "cls", "sub")
    states = derived.groupBy("ico", "start").agg(
        F.max("end").alias("end"),
        *[F.max(F.when(level[i], c("code"))).alias(n) for i, n in enumerate(names, 1)],
        *[F.max(F.when(level[i], c("certainty"))).alias(f"q{i}") for i in range(1, 6)],
        F.max_by(F.struct("flag", "candidates"), "level").alias("deepest"),
    )
    # map of certainties by level, as published beside the row
    certainties = F.map_from_entries(F.filter(
        F.array(*[F.struct(F.lit(i).alias("l"), c(f"q{i}").alias("q")) for i in range(1, 6)]), lambda e: e["q"].isNotNull()))
    last_state = states.withColumn("certainties", certainties).groupBy("ico").agg(
        F.max_by(F.struct("start", "end", *names, *[f"q{i}" for i in range(1, 6)], "deepest", "certainties"),
                 F.struct("start")).alias("d"))
    lists = lambda codes, p: codes.select(
        c("code").alias(f"{p}code"), c("level").alias(f"{p}level"), c("section").alias(f"{p}section"),
        c("division").alias(f"{p}division"), c("grp").alias(f"{p}grp"), c("cls").alias(f"{p}cls"), c("pseudo").alias(f"{p}pseudo"))
    j = (
        per_subject.join(last_state, "ico", "left")
        .join(small_side(lists(new_codes, "n_")), c("r.code") == c("n_code"), "left")
        .join(small_side(lists(old_codes, "p_")), c("o8.code") == c("p_code"), "left")
        .join(small_side(new_codes.select(c("code").alias("_sec"), c("pseudo").alias("d_pseudo"))),
              c("d.section") == c("_sec"), "left")
    )
    has_r = c("r").isNotNull()
    has_d = ~has_r & c("d").isNotNull()
    d = lambda f: F.when(has_d, c(f"d.{f}"))
    depth = F.coalesce(*[F.when(d(n).isNotNull(), i) for i, n in reversed(list(enumerate(names, 1)))])
    division_q = F.when(has_r, F.when(c("n_division").isNotNull(), F.lit(1))).otherwise(d("q2")).cast("decimal(5,4)")
    ambiguous = has_d & F.coalesce(c("d.deepest.flag") == X.AMBIGUOUS, F.lit(False))
    sure = F.coalesce(d("q2") >= X.AUTO_LINK_CERTAINTY, F.lit(False))
    return j.select(
        "ico",
        F.when(has_r, X.OFFICIAL).when(has_d, X.DERIVED).alias("source"),
        F.coalesce("n_section", d("section")).alias("section"), F.coalesce("n_division", d("division")).alias("division"),
        F.coalesce("n_grp", d("grp")).alias("grp"), F.coalesce("n_cls", d("cls")).alias("cls"),
        F.when(has_r, F.when(c("n_level") == 5, c("n_code"))).otherwise(d("sub")).alias("sub"),
        F.coalesce("r.code", d("sub"), d("cls"), d("grp"), d("division"), d("section")).alias("code_2025"),
        F.coalesce("n_level", depth).alias("level_2025"),
        F.when(has_r, F.lit(1)).otherwise(F.coalesce(*[
            F.when(depth == i, d(f"q{i}")) for i in range(1, 6)])).cast("decimal(5,4)").alias("certainty"),
        division_q.alias("certainty_division"),
        F.when(has_r, F.lit(1)).otherwise(d("q1")).cast("decimal(5,4)").alias("certainty_section"),
        F.when(has_d, c("d.certainties")).alias("certainties"),
        F.when(ambiguous, X.AMBIGUOUS).alias("flag"),
        F.when(ambiguous, c("d.deepest.candidates")).alias("candidates"),
        F.coalesce("n_pseudo", F.when(has_d, c("d_pseudo")), F.lit(False)).alias("pseudo"),
        c("o8.code").alias("code_2008"), c("p_section").alias("section_2008"), c("p_division").alias("division_2008"),
        F.coalesce("r.start", d("start"), "o8.start").alias("start"),
        F.when(has_r, c("r.end")).when(has_d, c("d.end")).otherwise(c("o8.end")).alias("end"),
        (has_r | sure).alias("auto_link"),
        F.when(has_r, X.OFFICIAL).when(has_d & sure, X.DERIVED).when(has_d, X.DERIVED_UNSURE).alias("status"),
    )


def codes_outside_list(history: DataFrame, codes: DataFrame) -> DataFrame:
    """Codes of subjects missing in the list of their version: codes(version, code)."""
    return history.filter(F.col("code").isNotNull()).groupBy("version", "source", "kind", "code").agg(
        F.count(F.lit(1)).alias("n")).join(codes.select("version", "code"), ["version", "code"], "left_anti")


# --- industry predicates ---------------------------------------------------------------------------

def in_industry(requested: dict[int, list[str]]) -> Column:
    """Subjects of the requested codes on any of the levels 1-4: automatic link, no pseudo-code."""
    hit = F.lit(False)
    for level, column in enumerate(("section", "division", "grp", "cls"), 1):
        if requested.get(level):
            hit = hit | F.coalesce(F.col(column).isin(*requested[level]), F.lit(False))
    return F.col("auto_link") & ~F.col("pseudo") & hit


def in_other_industries(requested: dict[int, list[str]]) -> Column:
    """Assigned subjects outside the requested codes; an unknown level counts as outside."""
    return F.col("auto_link") & ~F.col("pseudo") & ~in_industry(requested)


def validate_requests(requests: DataFrame, codes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """requests(request_id, code) -> (valid, rejected): the code exists, is no pseudo-code, not deeper
    than a class, and no requested code contains another one of the same request."""
    asked = requests.select("request_id", F.upper(F.btrim("code")).alias("code")).distinct()
    j = asked.join(codes.select("code", "level", "section", "division", "grp", "cls", "pseudo"), "code", "left")
    above = F.filter(F.array("section", "division", "grp", "cls"), lambda a: a.isNotNull() & (a != F.col("code")))
    nested = (
        j.select("request_id", F.col("code").alias("inner_code"), F.explode(above).alias("code"))
        .join(asked, ["request_id", "code"], "left_semi").select("request_id", F.col("inner_code").alias("code"))
        .distinct().withColumn("_nested", F.lit(True))
    )
    k = j.join(nested, ["request_id", "code"], "left")
    reason = (
        F.when(F.col("level").isNull(), "unknown code").when(F.col("pseudo"), "pseudo-code")
        .when(F.col("level") > 4, "deeper than a class").when(F.col("_nested"), "inside another requested code")
    )
    checked = k.withColumn("reason", reason)
    bad = checked.filter(F.col("reason").isNotNull())
    good = checked.join(bad.select("request_id").distinct(), "request_id", "left_anti")
    return good.select("request_id", "code", "level", "section"), bad.select("request_id", "code", "reason")


def complement_counts(subjects: DataFrame) -> DataFrame:
    """Living, automatically linked subjects known only to a section, division or group, and those whose
    industry is undetermined (pseudo-code 00), per code and territory."""
    only = F.col("level_2025").between(1, 3) & ~F.col("pseudo")
    kept = subjects.filter(F.col("auto_link") & (only | (F.col("code_2025") == X.UNDETERMINED)))
    return T.count_by_territory(kept, ["code_2025"]).drop("parent")


# --- coverage and change ---------------------------------------------------------------------------

def coverage(snapshot: DataFrame, interface: DataFrame) -> DataFrame:
    """Subjects with an official, derived, ambiguous or no 2025 code, by living / closed."""
    j = snapshot.select("ico", F.col("closed").isNull().alias("living")).join(
        interface.select("ico", "source", "flag", "division"), "ico", "left")
    s = F.col("source")
    return j.groupBy("living").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(s == X.OFFICIAL).alias("official"),
        F.count_if((s == X.DERIVED) & F.col("flag").isNull()).alias("derived"),
        F.count_if((s == X.DERIVED) & F.col("flag").isNotNull()).alias("ambiguous"),
        F.count_if((s == X.DERIVED) & F.col("division").isNotNull()).alias("derived_division"),
        F.count_if(s.isNull()).alias("none"),
    )


def matrix_base(matrix: DataFrame) -> DataFrame:
    """Codes of the matrix per target level, and those with a sufficient base."""
    codes = matrix.groupBy("level", "code_2008").agg(F.max("base").alias("base"))
    return codes.groupBy("level").agg(
        F.count(F.lit(1)).alias("codes"), F.count_if(F.col("base") >= X.MIN_BASE).alias("codes_with_base"))


def derived_by_method(derived: DataFrame) -> DataFrame:
    """Derived states by level and method with their mean certainty."""
    return derived.groupBy("level", F.col("detail").alias("method")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("certainty").cast("double")), 4).alias("mean_certainty"))


def changed_branch(interface: DataFrame, sections: DataFrame) -> DataFrame:
    """Living subjects with both official codes: changed division, section by content, section letter.
    sections(section_2025, section_rev2)."""
    both = interface.filter((F.col("source") == X.OFFICIAL) & F.col("code_2008").isNotNull() & F.col("end").isNull())
    j = both.join(small_side(sections), F.col("section") == F.col("section_2025"), "left")
    known = F.col("division").isNotNull() & F.col("division_2008").isNotNull()
    return j.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(known).alias("n_division"),
        F.count_if(known & (F.col("division") != F.col("division_2008"))).alias("changed_division"),
        F.count_if(~F.coalesce("section_rev2", "section").eqNullSafe(F.col("section_2008"))).alias("changed_section"),
        F.count_if(~F.col("section").eqNullSafe(F.col("section_2008"))).alias("changed_letter"),
    )


def reclassification(subjects: DataFrame, sections: DataFrame, threshold: int = X.MIN_CELL) -> DataFrame:
    """Effect of the new classification on every whole section in every territory.

    subjects(district, region, section, division, auto_link, section_2008, division_2008), living ones;
    sections(section_2025, section_rev2). Published: members by both versions, net change, main division
    of leavers and joiners; flows below the threshold only as "fewer than". The hidden parts (both, left,
    joined) go to the recomputation audit."""
    c = F.col
    counts = subjects.groupBy("district", "region", "section", "division", "auto_link", "section_2008", "division_2008").agg(
        F.count(F.lit(1)).alias("n"))
    s = small_side(sections.filter(c("section_rev2").isNotNull()).select("section_2025", "section_rev2"))
    new_side = counts.join(s, (c("section") == c("section_2025")) & c("auto_link"), "left").select(
        "district", "region", "division", "division_2008", "n", "section_2008",
        c("section_2025").alias("in_new"))
    # a row concerns the section it is in now and every section whose old letter it had
    old_lists = sections.filter(c("section_rev2").isNotNull()).groupBy("section_rev2").agg(
        F.collect_set("section_2025").alias("old_sections"))  # bounded by the section letters
    both = new_side.join(small_side(old_lists), c("section_2008") == c("section_rev2"), "left").withColumn(
        "old_sections", F.coalesce("old_sections", F.array().cast("array<string>")))
    about = F.array_union("old_sections", F.array_compact(F.array("in_new")))
    rows = both.select("district", "region", "division", "division_2008", "n", "in_new", "old_sections",
                       F.explode(about).alias("industry"))
    v08 = F.array_contains("old_sections", c("industry"))
    v25 = F.coalesce(c("in_new") == c("industry"), F.lit(False))
    flow = F.when(v08 & v25, "both").when(v08, "left").otherwise("joined")
    branch = F.when(flow == "left", c("division")).when(flow == "joined", c("division_2008"))
    per_district = rows.groupBy("industry", "district", "region", flow.alias("flow"), branch.alias("branch")).agg(
        F.sum("n").alias("n"))
    cells = T.roll_up(per_district, ["industry", "flow", "branch"], ["n"])

    def total(f: str) -> Column:
        return F.coalesce(F.sum(F.when(c("flow") == f, c("n"))), F.lit(0))

    def main(f: str) -> Column:
        hit = (c("flow") == f) & c("branch").isNotNull()
        return F.min_by(F.when(hit, c("branch")), F.when(hit, F.struct((-c("n")).alias("k"), c("branch").alias("b"))))

    g = cells.groupBy("industry", "level", "territory").agg(
        total("both").alias("both"), total("left").alias("left"), total("joined").alias("joined"),
        main("left").alias("main_left"), main("joined").alias("main_joined"))
    return g.select(
        "industry", "level", "territory", (c("both") + c("left")).alias("n_2008"), (c("both") + c("joined")).alias("n_2025"),
        (c("joined") - c("left")).alias("change"), "main_left", "main_joined",
        (c("left") < threshold).alias("left_below"), (c("joined") < threshold).alias("joined_below"), "both", "left", "joined")
