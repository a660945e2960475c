"""Stock, births, closures and closure rates by year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regisight.functions import fixed as X
from regisight.functions.codes import closure_mode, comparable_period, person_type
from regisight.functions.numbers import ratio
from regisight.functions.poisson import with_poisson_quantiles
from regisight.operators import territory as T

MODES = ("04", "01", "jiny")


def life_counts(subjects: DataFrame, by: list[str], snapshot: Column, first_year: int) -> DataFrame:
    """Legal persons counted by founding year (clamped to the year before the window), closing year,
    comparable-period flag and closure mode, per district. Everything later works on these counts."""
    founded = F.greatest(F.coalesce(F.year("founded"), F.lit(0)), F.lit(first_year - 1))
    living = F.col("closed").isNull()
    legal = person_type(F.col("forma")) == "PO"
    kept = subjects.filter(
        legal & ((living) | ((F.year("closed") >= first_year) & F.col("forma").isNotNull()))
    )
    return kept.groupBy(
        *by, "district", "region", founded.alias("born"), F.year("closed").alias("ended"),
        F.when(~living, comparable_period(F.col("closed"), snapshot)).alias("comparable"),
        F.when(~living, closure_mode(F.col("zpzan"))).alias("mode"),
    ).agg(F.count(F.lit(1)).alias("n"))


def stock_and_flow(lives: DataFrame, by: list[str], first_year: int, last_year: int) -> DataFrame:
    """Per (by, territory, year): stock on 1 January, births, closures by mode, the same within the
    comparable period, and whether stock(y+1) = stock(y) - closed(y) + born(y) holds.

    The few years of the window are attached to the already aggregated counts as an array."""
    cells = T.roll_up(lives, [*by, "born", "ended", "comparable", "mode"], ["n"])
    yearly = cells.withColumn("year", F.explode(F.sequence(F.lit(first_year), F.lit(last_year))))
    c, n, y = F.col, F.col("n"), F.col("year")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    ended_now = c("ended") == y
    in_period = ended_now & c("comparable")
    flows = yearly.groupBy(*by, "level", "territory", "year").agg(
        total((c("born") < y) & (c("ended").isNull() | (c("ended") >= y))).alias("stock"),
        total(c("born") == y).alias("born"),
        *[total(ended_now & (c("mode") == m)).alias(f"closed_{m}") for m in MODES],
        *[total(in_period & (c("mode") == m)).alias(f"period_{m}") for m in MODES],
        total(c("ended").isNull()).alias("now"),
    )
    flows = flows.withColumn("closed", sum((c(f"closed_{m}") for m in MODES), F.lit(0))).withColumn(
        "period", sum((c(f"period_{m}") for m in MODES), F.lit(0))
    )
    w = Window.partitionBy(*by, "level", "territory").orderBy("year")  # as many rows as years
    following = F.coalesce(F.lead("stock").over(w), c("now"))
    return flows.withColumn("identity_holds", following == c("stock") - c("closed") + c("born"))


def others(flows: DataFrame, by: str, measures: list[str]) -> DataFrame:
    """"All other industries" of a territory = everything assigned there minus the industry itself;
    no re-scan per industry."""
    w = Window.partitionBy("level", "territory", "year")  # one row per industry code
    return flows.select(by, "level", "territory", "year",
                        *[(F.sum(m).over(w) - F.col(m)).alias(m) for m in measures])


def rates_beside_others(flows: DataFrame, by: str, last_year: int, threshold: int = 0, measure: str = "closed") -> DataFrame:
    """Closure rate of an industry and of all other industries of the territory, in one pass: of whole years (closed) or of
    the comparable period of each year (period), which the last year has too. The others' rate is there only where
    their stock and closures may be shown themselves: `threshold` at least, or no closure at all."""
    w = Window.partitionBy("level", "territory", "year")  # one row per industry code
    c = F.col
    rest = lambda m: F.sum(m).over(w) - c(m)
    f = flows.withColumn("_oc", rest(measure)).withColumn("_os", rest("stock"))
    full = (c("year") < last_year) | F.lit(measure == "period")
    return f.select(by, "level", "territory", "year", F.when(full, ratio(c(measure), c("stock"), 2, 100)).alias("rate"),
                    F.when(full & (c("_os") >= threshold) & ((c("_oc") >= threshold) | (c("_oc") == 0)), ratio(c("_oc"), c("_os"), 2, 100)).alias("other_rate"))


def closure_rates(flows: DataFrame, by: list[str], last_year: int) -> DataFrame:
    """Rates in percent of the stock: whole (complete) years, comparable period, and both without
    mode 04."""
    full = F.col("year") < last_year
    c = F.col
    return flows.select(
        *by, "level", "territory", "year", "stock", "closed", "period",
        F.when(full, ratio(c("closed"), c("stock"), 2, 100)).alias("rate"),
        ratio(c("period"), c("stock"), 2, 100).alias("rate_period"),
        F.when(full, ratio(c("closed") - c("closed_04"), c("stock"), 2, 100)).alias("rate_without_04"),
        ratio(c("period") - c("period_04"), c("stock"), 2, 100).alias("rate_period_without_04"),
    )


def rate_visibility(flows: DataFrame, by: list[str], now: str, last_year: int,
                    threshold: int = X.MIN_CELL) -> DataFrame:
    """Which stocks, closures and period closures may be shown.

    Closures from the threshold up; period closures only when the rest of the year stays safe too;
    a stock is held back when births between two shown stocks could be derived and are few. The
    stock of year y depends on that of y+1: the few years are folded from the last to the first in
    one expression, no loop over rows."""
    place = [*by, "level", "territory"]
    c = F.col
    shown_closed = c("closed") >= threshold
    rest = c("closed") - c("period")
    shown_period = (c("period") >= threshold) & (~shown_closed | (rest >= threshold))
    f = flows.withColumn("show_closed", shown_closed).withColumn(
        "show_period", F.when(c("year") < last_year, shown_period).otherwise(shown_closed)
    )
    per_place = f.groupBy(*place).agg(
        F.reverse(F.array_sort(F.collect_list(F.struct("year", "stock", "born", "show_closed")))).alias("years"),
        (F.max(now) >= threshold).alias("show_now"),
    )
    start = F.struct(c("show_now").alias("next"), F.array().cast("array<struct<year:int,show_stock:boolean>>").alias("out"))

    def step(acc, y):
        show = (y["stock"] >= threshold) & ~(acc["next"] & y["show_closed"] & (y["born"] < threshold))
        return F.struct(show.alias("next"), F.array_append(
            acc["out"], F.struct(y["year"].cast("int").alias("year"), show.alias("show_stock"))).alias("out"))

    folded = per_place.select(*place, F.inline(F.aggregate("years", start, step, lambda acc: acc["out"])))
    return f.join(folded, [*place, "year"])


def mode_visibility(flows: DataFrame, last_year: int, threshold: int = X.MIN_CELL) -> DataFrame:
    """Split by closure mode: 04 against the rest only when both reach the threshold, 01 against the
    others only when both do; the period split also needs safe remainders. Needs show_closed and
    show_period."""
    c = F.col
    without = c("closed") - c("closed_04")
    p_without = c("period") - c("period_04")
    coarse = c("show_closed") & (c("closed_04") >= threshold) & (without >= threshold)
    fine = coarse & (c("closed_01") >= threshold) & (c("closed_jiny") >= threshold)
    rest_04, rest_without = c("closed_04") - c("period_04"), without - p_without
    period = F.when(
        c("year") < last_year,
        c("show_period") & (F.least(c("period_04"), p_without) >= threshold)
        & (~coarse | (F.least(rest_04, rest_without) >= threshold)),
    ).otherwise(coarse)
    return flows.withColumn("show_mode", coarse).withColumn("show_mode_fine", fine).withColumn("show_mode_period", period)


def yearly_sums(quarters: DataFrame, by: list[str]) -> DataFrame:
    """Quarterly births and closures summed per year and person type, pivoted; ok = total is FO + PO.

    quarters(by, period 'YYYY-Qn', person, value) with person in total, FO, PO."""
    q = quarters.withColumn("year", F.substring("period", 1, 4).cast("int"))
    out = q.groupBy(*by, "year").pivot("person", ["total", "FO", "PO"]).agg(F.sum("value"))
    return out.withColumn("ok", F.col("total") == F.coalesce("FO", F.lit(0)) + F.coalesce("PO", F.lit(0)))


#: Ends of the 95 % and 99.9 % intervals.
INTERVALS = {"low95": 0.025, "high95": 0.975, "low999": 0.0005, "high999": 0.9995}


def fluctuation(flows: DataFrame, by: list[str]) -> DataFrame:
    """Closures of a territory against the count expected at the state's rate of the same year, with the
    95 % and 99.9 % intervals of ordinary variation."""
    c = F.col
    state = flows.filter(c("level") == T.STATE).select(
        *by, "year", c("closed").alias("_cs"), c("stock").alias("_ss"))
    j = flows.filter((c("level") != T.STATE) & (c("stock") > 0)).join(state, [*by, "year"])
    expected = j.filter(c("_ss") > 0).withColumn("expected", F.round(c("stock") * c("_cs").cast("double") / c("_ss"), 6))
    out = with_poisson_quantiles(expected.filter(c("expected") > 0).select(*by, "level", "territory", "year", "closed", "expected"), "expected", INTERVALS)
    return out.select(*by, "level", "territory", "year", "closed", "expected", "low95", "high95", "low999", "high999",
                      (~c("closed").between(c("low999"), c("high999"))).alias("beyond"))
