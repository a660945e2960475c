"""The report of every industry in every territory in one run: tables T03 to T09 and T18, their protection, findings of two
kinds (deviations from the state and trends of rates), audit, sink. The other five kinds are queries of the catalog."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regisight.functions import fixed as X
from regisight.operators import disclosure as D
from regisight.operators import dynamics as Y
from regisight.operators import findings as K
from regisight.operators import indicators as I
from regisight.operators import structure as S
from regisight.operators import territory as T
from regisight.session import materialise
from regisight.sources.report_sink import write_report


COUNTS = ("REG_POCET", "STRUKTURA_POCET", "ZANIK_PO_STAV", "ZANIK_PO_RES")
INDICATORS = COUNTS + ("REG_PODIL_CR", "REG_PODIL_OBOR", "LQ", "HUSTOTA", "PORADI_POCET", "PORADI_HUSTOTA", "MIRA_ZANIKU_PO", "MIRA_ZANIKU_PO_OBD",
                       "MIRA_ZANIKU_PO_BEZ04")


@dataclass
class Report:
    cells: DataFrame        # report_id, var, value, published, protect
    relations: DataFrame    # report_id, rel_id, var, coef
    tables: DataFrame       # report_id, tbl, row, col, value, indicator, base_var
    findings: DataFrame
    refused: DataFrame      # cells below the minimum scope with their broader options
    same: DataFrame         # report_id, var, name: variables that several reports share
    across: DataFrame       # rel_id, var, coef: relations between reports
    others: DataFrame       # report_id, var, members: what is shown merged


def _long(df: DataFrame, tbl: str, row: Column, columns: dict[str, str], base: Column | dict[str, Column]) -> DataFrame:
    """Wide published rows to long report cells; hidden values are NULL and drop out. base: the variable a cell shows or
    rests on, one for all columns or one for each."""
    of = lambda c: base[c] if isinstance(base, dict) else base
    cells = F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("value"), F.lit(i).alias("indicator"), of(c).alias("base_var")) for c, i in columns.items()])
    return df.select("report_id", F.lit(tbl).alias("tbl"), row.alias("row"), F.inline(cells)).filter(F.col("value").isNotNull())


def build(subjects: DataFrame, territories: DataFrame, population: DataFrame, industry: str, day: Column, first_year: int, last_year: int,
          threshold: int = X.MIN_CELL) -> Report:
    """subjects(ico, district, region, <industry>, forma, katpo, founded, closed, zpzan).

    One overview report per industry (report_id = industry: state, regions, districts) and one detailed
    report per industry x territory (report_id = industry@level:territory). Each report is protected and
    audited by itself; differences between reports are not judged."""
    c = F.col
    living = subjects.filter(c("closed").isNull())
    by = [industry]
    counts = T.fill_zero(T.count_by_territory(living, by), T.places(territories), by)
    everything = counts.groupBy("level", "territory").agg(F.sum("n").alias("n_all"))
    people = T.roll_up(territories.select("district", "region").join(population, "district", "left"), [], ["inhabitants"])
    cells = materialise(I.basic_indicators(counts, everything, people, by), "cells")

    # T03 / T04: regions of the state, districts of the regions; a hidden parent hides its children
    state = cells.filter(c("level") == T.STATE).select(industry, (c("n") >= threshold).alias("shown"))
    regions = D.suppress(
        cells.filter(c("level") == T.REGION).join(state, industry).withColumn("hide", ~c("shown")).drop("shown"),
        by, "territory", "n", None, threshold, "hide").drop("hide")
    region_ok = regions.select(industry, c("territory").alias("parent"), (c("status") == D.PUBLISHED).alias("shown"))
    districts = D.suppress(
        cells.filter(c("level") == T.DISTRICT).join(region_ok, [industry, "parent"], "left")
        .withColumn("hide", ~F.coalesce("shown", F.lit(False))).drop("shown"),
        [industry, "parent"], "territory", "n", None, threshold, "hide").drop("hide")
    top = cells.filter(c("level") == T.STATE).withColumn("status", F.when(c("n") >= threshold, D.PUBLISHED).otherwise(D.HIDDEN)).withColumn(
        "secondary", F.lit(False))
    safe = materialise(top.unionByName(regions).unionByName(districts).withColumnRenamed(industry, "report_id"), "territories")
    var = F.concat(F.lit("obor@"), c("level"), F.lit(":"), c("territory"))
    shown = c("status").isin(D.PUBLISHED, D.ZERO)
    place_vars = safe.select("report_id", var.alias("var"), c("n").alias("value"), shown.alias("published"), F.lit(True).alias("protect"))
    parents = safe.filter(c("level") != T.STATE)
    whole = F.when(c("level") == T.REGION, F.lit("obor@CR:CZ")).otherwise(F.concat(F.lit("obor@KRAJ:"), c("parent")))
    place_sums = D.sum_relations(parents.select("report_id", whole.alias("whole"), var.alias("part")), [], "whole", "part")
    merged = parents.filter(c("status") == D.OTHER).select("report_id", F.concat(F.lit("ostatni:"), whole).alias("whole"), var.alias("part"), "n")
    other_vars = merged.groupBy("report_id", c("whole").alias("var")).agg(F.sum("n").alias("value")).select(
        "*", F.lit(True).alias("published"), F.lit(True).alias("protect"))
    other_sums = D.sum_relations(merged, [], "whole", "part")
    visible = c("status") == D.PUBLISHED
    t03 = _long(safe.filter(visible), "T03_T04_uzemi", F.concat_ws(":", "level", "territory"), {
        "n": "REG_POCET", "share_of_state": "REG_PODIL_CR", "share_of_territory": "REG_PODIL_OBOR", "lq": "LQ", "density": "HUSTOTA",
        "rank_count": "PORADI_POCET", "rank_density": "PORADI_HUSTOTA"}, var)

    # T05-T09: structure under the cascade
    own_report = F.concat(c(industry), F.lit("@"), c("level"), F.lit(":"), c("territory"))
    details = materialise(D.cascade(
        cells.select(industry, "level", "territory", "parent", "n"), S.structure_cells(living, by, day), by, threshold
    ).withColumn("report_id", own_report), "structure")
    own_total = safe.select(
        F.concat("report_id", F.lit("@"), "level", F.lit(":"), "territory").alias("report_id"), var.alias("var"), c("n").alias("value"),
        shown.alias("published"), F.lit(True).alias("protect"))
    place = F.concat_ws(":", "level", "territory")
    cell_var = F.concat_ws("/", place, "dim", "item")
    detail_vars = details.select("report_id", cell_var.alias("var"), c("n").alias("value"),
                                 c("status").isin(D.PUBLISHED, D.ZERO).alias("published"), F.lit(True).alias("protect"))
    above = F.when(c("dim").contains(":"), F.concat_ws("/", place, F.lit("fopo"), F.split_part("dim", F.lit(":"), F.lit(2)))).otherwise(
        F.concat(F.lit("obor@"), place))
    detail_sums = D.sum_relations(
        details.select("report_id", above.alias("whole"), F.concat_ws("/", place, "dim").alias("group"), cell_var.alias("part")), ["group"], "whole", "part")
    parts = details.filter(c("status") == D.OTHER).select(
        "report_id", F.concat_ws("/", F.lit("ostatni:"), place, "breakdown").alias("whole"), cell_var.alias("part"), "n")
    part_vars = parts.groupBy("report_id", c("whole").alias("var")).agg(F.sum("n").alias("value")).select(
        "*", F.lit(True).alias("published"), F.lit(True).alias("protect"))
    part_sums = D.sum_relations(parts, [], "whole", "part")
    t05 = _long(details.filter(visible), "T05_T09_struktura", cell_var, {"n": "STRUKTURA_POCET"}, cell_var)

    # T18, T29, T30: closures and their rates
    flows = materialise(Y.stock_and_flow(Y.life_counts(subjects, by, day, first_year), by, first_year, last_year), "flows")
    rated = materialise(Y.mode_visibility(Y.rate_visibility(flows, by, "now", last_year, threshold), last_year, threshold), "rated")
    rates = Y.closure_rates(flows, by, last_year)
    public = rated.select(industry, "level", "territory", "year", "show_stock", "show_closed", "show_period", "show_mode").join(
        rates, [*by, "level", "territory", "year"])
    keep = lambda value, *gates: F.when(_all(gates), c(value))
    t18_rows = public.select(
        own_report.alias("report_id"), industry, "level", "territory", "year", keep("stock", "show_stock").alias("stock"),
        keep("closed", "show_closed").alias("closed"), keep("rate", "show_stock", "show_closed").alias("rate"),
        keep("rate_period", "show_stock", "show_period").alias("rate_period"),
        keep("rate_without_04", "show_stock", "show_mode").alias("rate_without_04"))
    flow_vars, flow_sums = rate_relations(rated.withColumn("report_id", own_report), last_year, threshold)
    of_year = lambda kind: F.concat_ws("/", place, F.lit(kind), c("year").cast("string"))
    t18 = _long(t18_rows, "T18_mira_zaniku_po", F.concat_ws(" ", "territory", c("year").cast("string")), {
        "stock": "ZANIK_PO_STAV", "closed": "ZANIK_PO_RES", "rate": "MIRA_ZANIKU_PO", "rate_period": "MIRA_ZANIKU_PO_OBD",
        "rate_without_04": "MIRA_ZANIKU_PO_BEZ04"}, {"stock": of_year("stock"), "closed": of_year("closed"), "rate": of_year("closed"),
                                                     "rate_period": of_year("period"), "rate_without_04": of_year("stock")})

    # findings read published values only
    pairs = safe.filter(visible & (c("level") != T.STATE)).join(
        safe.filter(visible & (c("level") == T.STATE)).select("report_id", c("lq").alias("lq_state"), c("density").alias("density_state")), "report_id")
    shown_rates = t18_rows.filter(c("rate").isNotNull()).select(industry, "level", "territory", "year")
    series = Y.rates_beside_others(flows, industry, last_year, threshold).join(shown_rates, [industry, "level", "territory", "year"]).withColumnRenamed(
        industry, "report_id")
    shown_period = t18_rows.filter(c("rate_period").isNotNull()).select(industry, "level", "territory", "year")
    period = Y.rates_beside_others(flows, industry, last_year, threshold, "period").join(shown_period, [industry, "level", "territory", "year"]).withColumnRenamed(
        industry, "report_id")
    findings = K.assemble([
        K.deviation_from_state(pairs, ["report_id", "territory"]),
        K.trend_changes(series.drop("level"), ["report_id"], "rate", "other_rate", "za rok"),
        K.trend_changes(period.drop("level"), ["report_id"], "rate", "other_rate", "za období"),
    ], ["report_id", "territory"])

    scope = I.scope_check(cells.select(c(industry).alias("section"), c(industry).alias("industry"), "level", "territory", "parent", "n"))
    # what reports share: the total of an industry in a territory; over all industries these add up to a public total
    # with the subjects that have no industry, whose number is not shown
    total = F.concat(F.lit("@"), c("level"), F.lit(":"), c("territory"))
    in_all = safe.filter(c("report_id").isNotNull()).select(
        F.concat_ws("|", "report_id", var).alias("name"), c("report_id").alias("overview"), F.concat("report_id", total).alias("detail"), var.alias("var"), total.alias("total"))
    same = in_all.select("name", "var", F.explode(F.array("overview", "detail")).alias("report_id")).select("report_id", "var", "name")
    places = safe.select(total.alias("total")).distinct()
    term = lambda rows, name, k: rows.select(c("total").alias("rel_id"), name.alias("var"), F.lit(k).alias("coef"))
    across = term(in_all, c("name"), 1).unionByName(term(places, F.concat(F.lit("bez oboru"), c("total")), 1))
    members = lambda rows: rows.groupBy("report_id", c("whole").alias("var")).agg(F.count(F.lit(1)).alias("members"))
    return Report(
        place_vars.unionByName(other_vars).unionByName(own_total).unionByName(detail_vars).unionByName(part_vars).unionByName(flow_vars),
        place_sums.unionByName(other_sums).unionByName(detail_sums).unionByName(part_sums).unionByName(flow_sums),
        t03.unionByName(t05).unionByName(t18), findings, scope.filter("refused"), same, across, members(merged).unionByName(members(parts)))


def rate_relations(rated: DataFrame, last_year: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    """Variables and relations behind the rates of one report: closures = period + rest of the year, and
    stock(y + 1) = stock(y) - closures + births, the last stock being today's legal persons."""
    c = F.col
    place = F.concat_ws(":", "level", "territory")
    y = c("year").cast("string")
    name = lambda kind, year=y: F.concat_ws("/", place, F.lit(kind), year)
    rest = c("closed") - c("period")
    full = c("year") < last_year

    def variable(kind: str, value: Column, published: Column, protect: Column) -> Column:
        return F.struct(name(kind).alias("var"), value.cast("bigint").alias("value"), published.alias("published"), protect.alias("protect"))

    yes, no = F.lit(True), F.lit(False)
    cells = rated.select("report_id", F.inline(F.array_compact(F.array(
        variable("stock", c("stock"), c("show_stock"), yes), variable("closed", c("closed"), c("show_closed"), yes),
        variable("born", c("born"), no, c("born") < threshold),
        F.when(full, variable("period", c("period"), c("show_period"), yes)), F.when(full, variable("rest", rest, no, rest < threshold))))))
    following = F.when(full, name("stock", (c("year") + 1).cast("string"))).otherwise(F.concat_ws("/", place, F.lit("fopo"), F.lit("PO")))
    term = lambda rel, var, coef: F.struct(F.concat_ws("/", place, F.lit(rel), y).alias("rel_id"), var.alias("var"), F.lit(coef).alias("coef"))
    relations = rated.select("report_id", F.inline(F.array_compact(F.array(
        term("move", following, 1), term("move", name("stock"), -1), term("move", name("closed"), 1), term("move", name("born"), -1),
        F.when(full, term("year", name("closed"), 1)), F.when(full, term("year", name("period"), -1)), F.when(full, term("year", name("rest"), -1))))))
    return cells, relations


def _all(gates: tuple[str, ...]) -> Column:
    out = F.lit(True)
    for g in gates:
        out = out & F.col(g)
    return out


def audit(report: Report) -> DataFrame:
    """Hidden protected cells that the published numbers of all reports together give away; must be empty.
    The public total over all industries drops out of its sum as any published number does."""
    return D.derivable_jointly(report.cells, report.relations, report.same, report.across)


def violations(report: Report, threshold: int = X.MIN_CELL) -> DataFrame:
    """(report_id, place, violation): everything that forbids a release; empty when it may go out."""
    c = F.col
    spark = report.cells.sparkSession
    catalogue = spark.createDataFrame([(i, X.COUNT_TYPE if i in COUNTS else X.DERIVED_TYPES[0]) for i in INDICATORS], "indicator string, kind string")
    row = lambda df, place, what: df.select(c("report_id").cast("string").alias("report_id"), place.alias("place"), what.alias("violation"))
    ids = K.duplicate_ids(report.findings, ["report_id", "territory"])
    out = row(audit(report), c("var"), F.concat(F.lit("hidden cell: "), c("leak")))
    out = out.unionByName(row(D.threshold_audit(report.tables, report.cells, catalogue, report.others, threshold), c("place"), c("violation")))
    out = out.unionByName(row(D.value_conflicts(report.cells), c("var"), F.lit("two values of one variable")))
    out = out.unionByName(row(D.joint_conflicts(report.cells, report.same).withColumn("report_id", F.lit("*")), c("name"), F.lit("two values in two reports")))
    return out.unionByName(row(ids, c("finding_id"), F.lit("two findings with one id")))


class ReleaseRefused(ValueError):
    """The report breaks a rule of release."""


def save(report: Report, public: str, internal: str) -> None:
    """Writes the report after its whole audit; one violation refuses all of it."""
    if found := violations(report).take(5):
        raise ReleaseRefused("; ".join(f"{r.report_id} {r.place}: {r.violation}" for r in found))
    write_report(report.tables, report.findings, report.cells, report.relations, public, internal)
