"""Disclosure control: suppression, cascades, recomputation checks."""

from __future__ import annotations

from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regisight.functions import fixed as X
from regisight.plans.sizing import small_side
from regisight.session import cut_lineage

PUBLISHED, OTHER, HIDDEN, ZERO = "published", "other", "hidden", "zero"


def suppress(cells: DataFrame, group: list[str], code: str = "code", value: str = "value",
             protected: str | None = None, threshold: int = X.MIN_CELL, force_hidden: str | None = None) -> DataFrame:
    """Primary and secondary suppression of each breakdown; adds status and secondary.

    A cell below the threshold goes to "other"; if "other" stays below, the smallest large cell
    joins it (unprotected first). As every large cell reaches the threshold, one is always enough,
    so no loop is needed: the pick is a min over (protected, value, code). A breakdown whose total
    is below the threshold is hidden whole. Group facts come from one aggregation with map-side
    combine and are joined back, so no breakdown is ever collected in one task."""
    guard = F.col(protected).cast("boolean") if protected else F.lit(False)
    v = F.col(value)
    large, small = v >= threshold, (v > 0) & (v < threshold)
    facts = cells.groupBy(*group).agg(
        F.sum(F.when(v > 0, v).otherwise(0)).alias("_total"),
        F.sum(F.when(small, v).otherwise(0)).alias("_small"),
        F.min(F.when(large, F.struct(F.coalesce(guard, F.lit(False)), v, F.col(code)))).alias("_pick"),
        *([F.max(F.col(force_hidden).cast("boolean")).alias("_force")] if force_hidden else []),
    )
    joined = cells.join(facts, group, "left")
    needs_more = (F.col("_small") > 0) & (F.col("_small") < threshold)
    picked = F.coalesce(
        needs_more & large & (F.struct(F.coalesce(guard, F.lit(False)), v, F.col(code)) == F.col("_pick")), F.lit(False)
    )
    gone = F.col("_total") < threshold
    if force_hidden:
        gone = gone | F.coalesce(F.col("_force"), F.lit(False))
    status = (
        F.when(F.coalesce(v, F.lit(0)) <= 0, ZERO).when(gone, HIDDEN).when(small | picked, OTHER).otherwise(PUBLISHED)
    )
    out = joined.withColumn("status", status).withColumn("secondary", picked & ~gone)
    return out.drop("_total", "_small", "_pick", "_force")


def published_breakdown(cells: DataFrame, group: list[str], code: str = "code", value: str = "value") -> DataFrame:
    """Rows a reader sees: published cells, one "other" per breakdown and the total. A breakdown
    with nothing but "other" is dropped, for it would only repeat the total."""
    shown = F.col("status").isin(PUBLISHED, OTHER)
    label = F.when(F.col("status") == PUBLISHED, F.col(code)).otherwise(F.lit("(other)"))
    rows = cells.filter(shown).groupBy(*group, label.alias(code)).agg(
        F.sum(value).alias(value), F.count(F.lit(1)).alias("members")
    )
    totals = cells.filter(shown).groupBy(*group).agg(
        F.sum(value).alias("total"), F.count_if(F.col("status") == PUBLISHED).alias("n_published")
    )
    return rows.join(totals.filter(F.col("n_published") > 0), group).select(
        *group, code, value, "members", F.round(100.0 * F.col(value) / F.col("total"), 1).alias("share")
    )


def cascade(territory_cells: DataFrame, detail_cells: DataFrame, key: list[str], threshold: int = X.MIN_CELL) -> DataFrame:
    """Visibility from territory over person type down to the details.

    territory_cells(key, level, territory, parent, n); detail_cells(key, level, territory, dim, item, n)
    with dims 'fopo', 'forma:FO|PO', 'vel:FO|PO', 'vek'. Order: state, its regions, their districts;
    then FO/PO; then forms, sizes and ages. Forms are merged across FO and PO where FO/PO is hidden,
    sizes are hidden there, everything is hidden in a hidden territory."""
    state = territory_cells.filter(F.col("level") == "CR").select(*key, (F.col("n") >= threshold).alias("state_ok"))
    regions = suppress(
        territory_cells.filter(F.col("level") == "KRAJ").join(state, key, "left")
        .withColumn("hide", ~F.coalesce("state_ok", F.lit(False))),
        key, "territory", "n", None, threshold, "hide")
    region_ok = regions.select(*key, F.col("territory").alias("parent"), (F.col("status") == PUBLISHED).alias("region_ok"))
    districts = suppress(
        territory_cells.filter(F.col("level") == "OKRES").join(region_ok, [*key, "parent"], "left")
        .withColumn("hide", ~F.coalesce("region_ok", F.lit(False))),
        [*key, "parent"], "territory", "n", None, threshold, "hide")
    visible = (
        state.select(*key, F.lit("CR").alias("level"), F.lit("CZ").alias("territory"), F.col("state_ok").alias("visible"))
        .unionByName(regions.select(*key, "level", "territory", (F.col("status") == PUBLISHED).alias("visible")))
        .unionByName(districts.select(*key, "level", "territory", (F.col("status") == PUBLISHED).alias("visible")))
    )
    place = [*key, "level", "territory"]
    types = detail_cells.filter(F.col("dim") == "fopo")
    type_ok = types.groupBy(*place).agg(
        (F.min(F.when(F.col("n") > 0, F.col("n"))) >= threshold).alias("fopo_ok")
    )
    gates = visible.join(type_ok, place, "left").withColumn(
        "fopo_ok", F.coalesce("fopo_ok", F.lit(False)) & F.col("visible")
    )
    d = detail_cells.join(gates, place, "left")
    split_form = F.col("dim").startswith("forma:")
    gated = d.withColumn(
        "breakdown", F.when(split_form & ~F.col("fopo_ok"), F.lit("forma")).otherwise(F.col("dim"))
    ).withColumn(
        "hide",
        ~F.coalesce(F.col("visible"), F.lit(False))
        | ((F.col("dim").startswith("vel:") | (F.col("dim") == "fopo")) & ~F.col("fopo_ok")),
    )
    return suppress(gated, [*place, "breakdown"], "item", "n", None, threshold, "hide").select(
        *place, "breakdown", "dim", "item", "n", "status", "secondary"
    )


# --- recomputation ---------------------------------------------------------------------------------

def value_conflicts(cells: DataFrame) -> DataFrame:
    """Variables of one report with more than one value."""
    return cells.groupBy("report_id", "var").agg(F.min("value").alias("low"), F.max("value").alias("high")).filter(
        F.col("low") != F.col("high")
    )


def sum_relations(parts: DataFrame, group: list[str], whole: str, part: str) -> DataFrame:
    """Relation rows (rel_id, var, coef) of whole = sum(parts): -1 for the whole, 1 for a part."""
    rel = F.concat_ws("=", F.col(whole), *[F.col(g) for g in group])
    up = parts.select("report_id", rel.alias("rel_id"), F.col(whole).alias("var"), F.lit(-1).alias("coef")).distinct()
    down = parts.select("report_id", rel.alias("rel_id"), F.col(part).alias("var"), F.lit(1).alias("coef"))
    return up.unionByName(down)


def derivable_by_substitution(cells: DataFrame, relations: DataFrame) -> DataFrame:
    """Hidden cells that follow from relations with a single unknown, repeated to the fixpoint.

    Each round is one aggregation per relation with map-side combine; a relation of any size needs
    only its count of unknowns. Rounds are cut by a reliable checkpoint."""
    links = relations.filter(F.col("coef") != 0).select("report_id", "rel_id", "var").distinct()
    known = cells.filter(F.col("published")).select("report_id", "var")
    unknown = links.select("report_id", "var").distinct().join(known, ["report_id", "var"], "left_anti")
    derived = None
    while True:  # ends: each round but the last takes at least one cell from the unknown ones
        open_links = links.join(unknown, ["report_id", "var"], "left_semi")
        new = (
            open_links.groupBy("report_id", "rel_id").agg(F.count(F.lit(1)).alias("open"), F.min("var").alias("var"))
            .filter(F.col("open") == 1).select("report_id", "var").distinct()
        )
        new = cut_lineage(new)
        if new.isEmpty():
            break
        derived = new if derived is None else derived.unionByName(new)
        unknown = cut_lineage(unknown.join(new, ["report_id", "var"], "left_anti"))
    found = derived if derived is not None else links.select("report_id", "var").limit(0)
    return found.join(cells.filter(F.col("protect")), ["report_id", "var"], "left_semi")


def _determined(rows: list[dict[str, Fraction]], wanted: list[str]) -> list[str]:
    """Unknowns fixed by a homogeneous-free linear system: after full reduction, the pivots
    whose row holds nothing else."""
    pivots: dict[str, dict[str, Fraction]] = {}
    held_by: dict[str, set[str]] = {}  # unknown -> pivots in whose row it stands
    for row in rows:
        row = dict(row)
        for p in [v for v in row if v in pivots]:
            k = row.get(p)
            if k:
                for v, c in pivots[p].items():
                    row[v] = row.get(v, Fraction(0)) - k * c
        row = {v: c for v, c in row.items() if c}
        if not row:
            continue
        lead = next(iter(row))
        scale = row[lead]
        row = {v: c / scale for v, c in row.items()}
        for p in list(held_by.get(lead, ())):
            other = pivots[p]
            k = other[lead]
            for v, c in row.items():
                left = other.get(v, Fraction(0)) - k * c
                if left:
                    other[v] = left
                    held_by.setdefault(v, set()).add(p)
                elif v in other:
                    del other[v]
                    held_by[v].discard(p)
        pivots[lead] = row
        for v in row:
            held_by.setdefault(v, set()).add(lead)
    return [v for v in wanted if v in pivots and len(pivots[v]) == 1]


def derivable_exactly(cells: DataFrame, relations: DataFrame) -> DataFrame:
    """Hidden protected cells whose unit vector lies in the row space of the relations and the
    published cells (intervals are not judged).

    Published cells drop out of the relations; what remains falls into independent blocks. Blocks
    are the connected components of (relation, unknown), found by label propagation in Spark, and
    only one block at a time reaches a Python task. A block never exceeds one report, whose size is
    given by the code lists (tables x items), not by the number of subjects."""
    facts = cells.groupBy("report_id", "var").agg(F.max("published").alias("published"), F.max("protect").alias("protect"))
    links = (
        relations.groupBy("report_id", "rel_id", "var").agg(F.sum("coef").alias("coef"))
        .filter(F.col("coef") != 0).join(facts, ["report_id", "var"], "left")
        .filter(~F.coalesce("published", F.lit(False)))
        .select("report_id", "rel_id", "var", "coef", F.coalesce("protect", F.lit(False)).alias("protect"))
    )
    links = cut_lineage(links)
    blocks = _components(links)
    work = links.join(blocks, ["report_id", "rel_id"])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [
            {v: Fraction(int(c)) for v, c in zip(g["var"], g["coef"])} for _, g in pdf.sort_values("var").groupby("rel_id")
        ]
        wanted = sorted(pdf.loc[pdf["protect"], "var"].unique())
        found = _determined(rows, wanted)
        report = pd.Series([pdf["report_id"].iloc[0]] * len(found), dtype=object)
        return pd.DataFrame({"report_id": report, "var": pd.Series(found, dtype=object)})

    schema = f"report_id {links.schema['report_id'].dataType.simpleString()}, var string"
    return work.groupBy("report_id", "block").applyInPandas(solve, schema)


ELSEWHERE, DERIVABLE = "published elsewhere", "derivable"


def derivable_jointly(cells: DataFrame, relations: DataFrame, same: DataFrame, across: DataFrame | None = None) -> DataFrame:
    """Hidden protected cells that all reports together give away: (report_id, var, leak).

    same(report_id, var, name) gives variables of several reports their common name; what it does not list
    is a variable of its report alone. across(rel_id, var, coef) relates names of different reports, such as the sum
    over all industries; an unpublished variable that stands in no report may close it. A cell hidden in one
    report leaks when another one publishes it, or when it follows from the relations of all of them: reports
    that share unknowns fall into one block, the others stay apart. A block is bounded by the code lists (industries x
    territories x items), whatever the number of subjects."""
    c = F.col
    own = F.concat_ws("#", c("report_id").cast("string"), c("var"))
    name = F.coalesce(c("name"), own)
    named = cut_lineage(cells.join(same, ["report_id", "var"], "left").withColumn("name", name))
    together = named.groupBy("name").agg(F.max("published").alias("published"), F.max("protect").alias("protect"))
    everywhere = together.select(F.lit("*").alias("report_id"), c("name").alias("var"), "published", "protect")
    rel_id = F.concat_ws("#", c("report_id").cast("string"), c("rel_id"))
    inner = relations.join(same, ["report_id", "var"], "left").select(F.lit("*").alias("report_id"), rel_id.alias("rel_id"), name.alias("var"), "coef")
    unique = inner if across is None else inner.unionByName(across.select(F.lit("*").alias("report_id"), F.concat(F.lit("#"), c("rel_id")).alias("rel_id"), "var", "coef"))
    found = derivable_exactly(everywhere, unique).select(c("var").alias("name"), F.lit(DERIVABLE).alias("leak"))
    shown = together.filter("published").select("name", F.lit(ELSEWHERE).alias("leak"))
    hidden = named.filter(c("protect") & ~c("published")).select("report_id", "var", "name")
    return hidden.join(found.unionByName(shown), "name").select("report_id", "var", "leak").distinct()


def joint_conflicts(cells: DataFrame, same: DataFrame) -> DataFrame:
    """Common names that have different values in different reports."""
    named = cells.join(same, ["report_id", "var"]).select(F.lit("*").alias("report_id"), F.col("name").alias("var"), "value")
    return value_conflicts(named).select(F.col("var").alias("name"), "low", "high")


def _components(links: DataFrame) -> DataFrame:
    """(report_id, rel_id) -> block: smallest relation id reachable over shared unknowns."""
    label = links.groupBy("report_id", "rel_id").agg(F.first("rel_id").alias("block"))
    while True:
        label = cut_lineage(label)
        by_var = links.join(label, ["report_id", "rel_id"]).groupBy("report_id", "var").agg(F.min("block").alias("block"))
        nxt = links.select("report_id", "rel_id", "var").join(by_var, ["report_id", "var"]).groupBy(
            "report_id", "rel_id").agg(F.min("block").alias("next"))
        merged = cut_lineage(label.join(nxt, ["report_id", "rel_id"]))
        if merged.filter(F.col("next") < F.col("block")).isEmpty():
            return label
        label = merged.select("report_id", "rel_id", F.least("block", "next").alias("block"))


def threshold_audit(report_cells: DataFrame, cells: DataFrame, catalogue: DataFrame, others: DataFrame,
                    threshold: int = X.MIN_CELL) -> DataFrame:
    """Violations of the published tables; empty means fit for release.

    report_cells(report_id, tbl, row, col, value, indicator, base_var), cells(report_id, var, value,
    published, protect), catalogue(indicator, kind), others(report_id, var, members)."""
    shown = report_cells.filter(F.col("value").isNotNull())
    c = cells.select("report_id", F.col("var").alias("base_var"), F.col("value").alias("base_value"),
                     F.col("published").alias("base_published"))
    j = shown.join(small_side(catalogue), "indicator", "left").join(c, ["report_id", "base_var"], "left")
    is_count = F.col("kind") == X.COUNT_TYPE
    rules = F.array(
        F.when(F.col("kind").isNull(), F.lit("indicator not in the catalogue")),
        F.when(is_count & (F.col("value") < threshold), F.lit("published count below the threshold")),
        F.when(F.col("kind").isin(*X.DERIVED_TYPES) & F.col("base_var").isNotNull()
               & ~F.coalesce("base_published", F.lit(False)), F.lit("derived value over a hidden count")),
        F.when(is_count & F.col("base_var").isNotNull()
               & ~F.coalesce((F.col("base_value") == F.col("value")) & F.col("base_published"), F.lit(False)),
               F.lit("count differs from its variable")),
    )
    cell_errors = j.select("report_id", F.concat_ws("/", "tbl", "row", "col").alias("place"),
                           F.explode(F.array_compact(rules)).alias("violation"))
    o = others.join(cells.select("report_id", "var", "value", "published"), ["report_id", "var"], "left")
    other_rules = F.array(
        F.when(F.col("members") < 2, F.lit("'other' has a single member")),
        F.when(F.col("published") & (F.col("value") < threshold), F.lit("'other' below the threshold")),
    )
    other_errors = o.select("report_id", F.col("var").alias("place"),
                            F.explode(F.array_compact(other_rules)).alias("violation"))
    return cell_errors.unionByName(other_errors)
