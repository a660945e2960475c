"""Structure of the living population: ages, forms, sizes, and their benchmarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regisight.functions import fixed as X
from regisight.functions.codes import age_band, person_type, size_band
from regisight.functions.numbers import pct
from regisight.operators import disclosure as D
from regisight.operators import territory as T


def structure_cells(subjects: DataFrame, by: list[str], day: Column) -> DataFrame:
    """Living subjects per (by, territory, dim, item): person type, legal form within it, size within
    it, age band. One pass: subjects are first counted per district and attribute combination, then
    the combinations are unpivoted."""
    person = person_type(F.col("forma"))
    counted = (
        subjects.select(*by, "district", "region", "forma", size_band(F.col("katpo")).alias("size"),
                        person.alias("person"), F.coalesce(age_band(F.col("founded"), day), F.lit("?")).alias("age"))
        .groupBy(*by, "district", "region", "forma", "size", "person", "age").agg(F.count(F.lit(1)).alias("n"))
    )

    def item(dim: Column, value: Column) -> Column:
        return F.struct(dim.alias("dim"), value.alias("item"))

    unpivoted = counted.select(
        *by, "district", "region", "n",
        F.inline(F.array(
            item(F.lit("fopo"), F.col("person")),
            item(F.concat(F.lit("forma:"), F.col("person")), F.col("forma")),
            item(F.concat(F.lit("vel:"), F.col("person")), F.col("size")),
            item(F.lit("vek"), F.col("age")),
        )),
    ).groupBy(*by, "district", "region", "dim", "item").agg(F.sum("n").alias("n"))
    return T.roll_up(unpivoted, [*by, "dim", "item"], ["n"]).drop("parent")


def age_statistics(subjects: DataFrame, by: list[str], day: Column) -> DataFrame:
    """Mean and exact median age per (by, territory); n_missing counts subjects without a founding day.

    Ages are whole days, so subjects are counted per age first; the median runs over (age, frequency)
    and its state is bounded by the number of distinct ages, whatever the number of subjects."""
    aged = subjects.groupBy(*by, "district", "region", F.date_diff(day, "founded").alias("days")).agg(
        F.count(F.lit(1)).alias("n")
    )
    spread = aged.select(*by, "days", "n", F.inline(T.memberships(F.col("district"), F.col("region"))))
    known = F.col("days").isNotNull()
    return spread.groupBy(*by, "level", "territory").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("n_missing"),
        F.round(F.sum(F.col("days") * F.col("n")).cast("double") / F.sum(F.when(known, F.col("n"))) / 365.25, 1)
        .alias("mean_age"),
        F.round(F.percentile("days", 0.5, F.col("n")) / 365.25, 1).alias("median_age"),
    )


def with_shares(cells: DataFrame, place: list[str]) -> DataFrame:
    """Share of each item in its dimension, in percent with one decimal."""
    totals = cells.groupBy(*place, "dim").agg(F.sum("n").alias("total"))
    return cells.join(totals, [*place, "dim"]).withColumn("share", pct(F.col("n"), F.col("total"), 1))


def closures_by_year(subjects: DataFrame, by: list[str], first_year: int) -> DataFrame:
    """Closed legal persons per (by, territory, closing year)."""
    closed = subjects.filter(
        (F.year("closed") >= first_year) & F.col("forma").isNotNull() & (person_type(F.col("forma")) == "PO")
    ).withColumn("year", F.year("closed"))
    return T.count_by_territory(closed, [*by, "year"]).drop("parent")


def benchmark(cells: DataFrame, key: list[str], level: str = T.REGION, threshold: int = X.MIN_CELL) -> DataFrame:
    """Item shares of each territory beside those of the state.

    Items merged in the territory are merged in the state beforehand and stay in "other" there;
    the state side gets its own suppression. The difference is taken from rounded shares."""
    group = [*key, "territory", "dim"]
    own = D.suppress(cells.filter(F.col("level") == level), group, "item", "n", None, threshold)
    own = own.select(*group, "item", "n", "status")
    state = cells.filter(F.col("level") == T.STATE).select(*key, "dim", "item", F.col("n").alias("n_state"))
    pairs = own.select(*group).distinct().join(state, [*key, "dim"])
    marked = pairs.join(own, [*group, "item"], "left").withColumn(
        "label", F.when(F.col("status") == D.PUBLISHED, F.col("item")).otherwise(F.lit("(other)"))
    )
    merged = marked.groupBy(*group, "label").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum("n_state").alias("n_state"),
        F.max(F.coalesce(F.col("status") == D.HIDDEN, F.lit(False))).alias("own_hidden"),
    )
    checked = D.suppress(merged, group, "label", "n_state", None, threshold)
    totals = merged.groupBy(*group).agg(F.sum("n").alias("total"), F.sum("n_state").alias("total_state"))
    j = checked.join(totals, group).filter(~F.col("own_hidden"))
    is_other = F.col("label") == "(other)"
    share = F.when((F.col("n") > 0) | ~is_other, pct(F.col("n"), F.col("total"), 1))
    state_share = F.when((F.col("status") == D.PUBLISHED) & ~is_other, pct(F.col("n_state"), F.col("total_state"), 1))
    return j.select(*group, F.col("label").alias("item"), share.alias("share"), state_share.alias("share_state"),
                    F.round(share - state_share, 1).alias("difference"))


def references(places: DataFrame, chosen: list[str]) -> DataFrame:
    """(level, territory, reference): what each region and district is put beside, the state and the chosen regions, but not
    itself, and no region whose only district it is, for the region would then tell the district's hidden cells."""
    c = F.col
    districts = places.filter(c("level") == T.DISTRICT).groupBy("parent").agg(F.count_distinct("territory").alias("districts"))
    asked = places.filter(c("level") != T.STATE).select("level", "territory", "parent", F.explode(F.array(F.lit(T.STATE_CODE), *[F.lit(x) for x in chosen])).alias("reference"))
    alone = (c("level") == T.DISTRICT) & (c("parent") == c("reference")) & (c("districts") == 1)
    return asked.join(districts, "parent", "left").filter((c("reference") != c("territory")) & ~F.coalesce(alone, F.lit(False))).select("level", "territory", "reference")


REST, OTHER_ITEM = "(rest)", "(other)"


def benchmark_regions(cells: DataFrame, key: list[str], places: DataFrame, chosen: list[str], threshold: int = X.MIN_CELL) -> tuple[DataFrame, DataFrame]:
    """(shares, reference cells): item shares of each territory beside those of the state and of chosen regions.

    The territory's own suppression decides the items. In a reference whatever the territory does not publish is merged
    beforehand and stays in "(other)" there; the reference then gets a suppression of its own over these items, which
    may move more of them to "(other)". A breakdown that is hidden in the territory or too small in the reference has
    no shares there; the difference is taken from rounded shares. The reference cells (key, territory, reference, dim, item,
    n, status) are the variables an audit needs."""
    c = F.col
    place = [*key, "territory", "dim"]
    group = [*key, "territory", "reference", "dim"]
    own = D.suppress(cells.filter(c("level") != T.STATE), place, "item", "n", None, threshold).select("level", *place, "item", "n", "status")
    totals = own.groupBy("level", *place).agg(
        F.sum("n").alias("total"), F.coalesce(F.sum(F.when(c("status") == D.OTHER, c("n"))), F.lit(0)).alias("other")).filter(c("total") >= threshold)
    beside = totals.join(references(places, chosen), ["level", "territory"]).drop("level")
    there = cells.filter((c("level") == T.STATE) | c("territory").isin(chosen) & (c("level") == T.REGION)).select(
        *key, c("territory").alias("reference"), "dim", "item", c("n").alias("n_there"))
    shown = own.filter(c("status") == D.PUBLISHED).select(*place, "item", "n")
    items = shown.join(beside.select(*group), place).join(there, [*key, "reference", "dim", "item"], "left").withColumn("n_there", F.coalesce("n_there", F.lit(0)))
    whole = there.groupBy(*key, "reference", "dim").agg(F.sum("n_there").alias("total_there"))
    listed = items.groupBy(*group).agg(F.sum("n_there").alias("listed"))
    rest = beside.select(*group).join(whole, [*key, "reference", "dim"]).join(listed, group, "left").select(
        *group, F.lit(REST).alias("item"), F.lit(None).cast("bigint").alias("n"), (c("total_there") - F.coalesce("listed", F.lit(0))).alias("n_there"))
    checked = D.suppress(items.select(*group, "item", "n", "n_there").unionByName(rest.filter(c("n_there") > 0)), group, "item", "n_there", None, threshold)
    checked = checked.withColumn("status", F.when((c("item") == REST) & (c("status") == D.PUBLISHED), D.OTHER).otherwise(c("status")))
    other_there = checked.filter(c("status") == D.OTHER).groupBy(*group).agg(F.sum("n_there").alias("other_there"))
    facts = beside.join(whole, [*key, "reference", "dim"], "left").join(other_there, group, "left")
    one = checked.filter(c("item") != REST).select(*group, "item", "n", F.when(c("status") == D.PUBLISHED, c("n_there")).alias("n_there")).join(
        facts.select(*group, "total", "total_there"), group)
    merged = facts.filter((c("other") > 0) | (c("other_there") > 0)).select(
        *group, F.lit(OTHER_ITEM).alias("item"), F.nullif("other", F.lit(0)).alias("n"), c("other_there").alias("n_there"), "total", "total_there")
    share, beyond = pct(c("n"), c("total"), 1), pct(c("n_there"), c("total_there"), 1)
    shares = one.unionByName(merged).select(*group, "item", share.alias("share"), beyond.alias("share_reference"), F.round(share - beyond, 1).alias("difference"))
    return shares, checked.select(*group, "item", c("n_there").alias("n"), "status")
