"""Notable deviations, ranked. Findings read published values only; model estimates are no input.

Every detector returns the same columns: the report key, kind, subtype, value, reference, strength and
the references of the numbers used (table/row/column)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regisight.functions import fixed as X
from regisight.functions.numbers import relative
from regisight.functions.text import finding_id

KINDS = tuple(k for k, _ in X.FINDING_KINDS)


def _rank_of_kind() -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))


def compare(df: DataFrame, key: list[str], kind: str, subtype: Column, value: Column, reference: Column,
            sources: Column, strength: Column | None = None, carried: list[str] | None = None) -> DataFrame:
    """Rows whose relative difference (or given strength) reaches the minimum."""
    r = relative(value, reference) if strength is None else F.lit(None).cast("double")
    s = F.abs(r) if strength is None else strength
    return df.filter(value.isNotNull() & reference.isNotNull()).select(
        *key, F.lit(kind).alias("kind"), subtype.alias("subtype"), value.cast("double").alias("value"),
        reference.cast("double").alias("reference"), F.round(s, 4).alias("strength"), s.alias("_exact"),
        F.round(F.abs(100 * r), 1).alias("difference_pct"),
        F.when(r > 0, "vyšší").when(r <= 0, "nižší").alias("direction"), sources.alias("sources"), *(carried or []),
    ).filter(F.col("_exact") >= X.FINDING_MIN).drop("_exact")


def refs(*places: Column) -> Column:
    return F.array_sort(F.array(*places))


def ref(table: str, row: Column, column: str) -> Column:
    return F.concat_ws("/", F.lit(table), row, F.lit(column))


def deviation_from_state(indicators: DataFrame, key: list[str]) -> DataFrame:
    """Location quotient and density of a territory against the state.
    indicators(key, territory, lq, lq_state, density, density_state)."""
    t = F.col("territory")
    out = None
    for name, label in (("lq", "LQ"), ("density", "hustota")):
        one = compare(indicators, key, "odchylka_od_cr", F.lit(label), F.col(name), F.col(f"{name}_state"),
                      refs(ref("T02_srovnani", t, name), ref("T02_srovnani", F.lit("CZ"), name)))
        out = one if out is None else out.unionByName(one)
    return out


def structure_deviation(bench: DataFrame, key: list[str]) -> DataFrame:
    """Structure items against the state, left out when small on both sides.
    bench(key, dim, item, share, share_state)."""
    big = bench.filter((F.col("item") != "(other)") & (
        (F.col("share") >= X.STRUCTURE_MIN_SHARE) | (F.col("share_state") >= X.STRUCTURE_MIN_SHARE)))
    place = F.concat_ws(":", "dim", "item")
    return compare(big, key, "odchylka_od_cr", F.concat(F.lit("struktura: "), F.col("dim")), F.col("share"),
                   F.col("share_state"), refs(ref("T13-T17", place, "uzemi"), ref("T13-T17", place, "cr")))


def cents(x: Column) -> Column:
    """A value with two decimals as a whole number of hundredths."""
    return F.round(x * 100).cast("bigint")


def mean_of_cents(total: Column, n: Column) -> Column:
    """Mean of n values given by the sum of their hundredths, exactly half-up at two decimals."""
    return F.floor((2 * total + n) / (2 * n)) / 100.0


def trend_changes(series: DataFrame, key: list[str], rate: str, other: str, label: str) -> DataFrame:
    """Last year against the earlier ones, against the state, and the development against the state,
    each with the same change of all other industries for the whole-territory rule.

    series(key, territory, year, rate, other): one row per year. The few years of a series become one
    sorted array, the state's array is attached by key, and everything else is array arithmetic: one
    aggregation and one window over the territories of a key."""
    c = F.col
    table = "T18_mira_zaniku_po"
    packed = series.groupBy(*key, "territory").agg(F.array_sort(F.collect_list(
        F.struct("year", c(rate).alias("r"), c(other).alias("o")))).alias("ys"))
    by_key = Window.partitionBy(*key)
    packed = packed.withColumn("state", F.max(F.when(c("territory") == "CZ", c("ys"))).over(by_key))
    packed = packed.withColumn("own", F.filter("ys", lambda y: y["r"].isNotNull())).filter(F.size("own") > 0)
    packed = packed.select("*", F.element_at("own", -1).alias("last"), F.element_at("own", 1).alias("first"),
                           F.slice("own", 1, F.size("own") - 1).alias("before"))

    def state_at(point: str) -> Column:
        return F.get(F.filter("state", lambda y: y["year"] == c(f"{point}.year")), F.lit(0))

    packed = packed.withColumn("s_last", state_at("last")).withColumn("s_first", state_at("first"))
    many = F.size("own") > 1

    def mean(field: str) -> Column:
        complete = ~F.exists("before", lambda y: y[field].isNull())
        total = F.aggregate("before", F.lit(0).cast("bigint"), lambda acc, y: acc + cents(y[field]))
        return F.when(many & complete, mean_of_cents(total, F.size("before")))

    def index(last: Column, first: Column) -> Column:
        return F.when(many & (first != 0) & (last != 0), F.round(last / first, 2))

    o_index = index(c("last.o"), c("first.o"))
    os_index = index(c("s_last.o"), c("s_first.o"))
    place = lambda t, point: F.concat_ws(" ", t, c(f"{point}.year").cast("string"))
    here, state = c("territory"), F.lit("CZ")
    own_first, own_last = ref(table, place(here, "first"), rate), ref(table, place(here, "last"), rate)
    state_first, state_last = ref(table, place(state, "first"), rate), ref(table, place(state, "last"), rate)
    outside = here != "CZ"

    def row(kind: str, keep, value, reference, o_value, o_reference, *sources) -> Column:
        return F.when(keep, F.struct(
            F.lit(f"míra zániku PO {label}: {kind}").alias("subtype"), value.alias("a"), reference.alias("b"),
            o_value.alias("o_value"), o_reference.alias("o_reference"), refs(*sources).alias("src")))

    rows = F.array_compact(F.array(
        row("poslední rok proti předchozím", many, c("last.r"), mean("r"), c("last.o"),
            F.when(c("last.o").isNotNull(), mean("o")), own_first, own_last),
        row("proti ČR", outside, c("last.r"), c("s_last.r"), c("last.o"), c("s_last.o"), own_last, state_last),
        row("vývoj proti ČR", outside, F.when(many & (c("first.r") != 0), F.round(c("last.r") / c("first.r"), 2)), index(c("s_last.r"), c("s_first.r")),
            F.when(os_index.isNotNull(), o_index), F.when(o_index.isNotNull(), os_index),
            own_first, own_last, state_first, state_last),
    ))
    compared = packed.select(*key, "territory", F.inline(rows))
    return territory_effect(compare(compared, [*key, "territory"], "zmena_trendu", c("subtype"), c("a"), c("b"), c("src"),
                                    carried=["o_value", "o_reference"]))


def territory_effect(found: DataFrame) -> DataFrame:
    """Whole-territory rule: when all other industries made the same change (same sign, at least the
    minimum, at least half of the industry's), it is an effect of the territory; the strength is
    lowered to the industry's own part, never raised. Where the others fell to nothing no own part can be
    told, and the strength stays."""
    c = F.col
    r, ro = relative(c("value"), c("reference")), relative(c("o_value"), c("o_reference"))
    effect = F.coalesce(
        (r * ro > 0) & (F.abs(ro) >= X.FINDING_MIN) & (F.abs(ro) >= X.TERRITORY_EFFECT_SHARE * F.abs(r)), F.lit(False))
    lowered = F.round(F.least(c("strength"), F.abs(F.try_divide(1 + r, 1 + ro) - 1)), 4)  # least() passes over NULL
    return found.withColumn("others_difference_pct", F.round(F.abs(100 * ro), 1)).withColumn("territory_effect", effect).withColumn(
        "original_strength", F.when(effect, c("strength"))).withColumn("strength", F.when(effect, lowered).otherwise(c("strength")))


def inside_differences(districts: DataFrame, key: list[str]) -> DataFrame:
    """District density against its region and the state, and the range between districts.
    districts(key, region, district, density, density_region, density_state)."""
    c = F.col
    d = c("district")
    to = [*key, c("region").alias("territory")] if "territory" not in districts.columns else key
    rows = districts.withColumn("territory", c("region"))
    k = [*key, "territory"]
    near = compare(rows, k, "rozdily_uvnitr_uzemi", F.lit("hustota okresu proti kraji"), c("density"), c("density_region"),
                   refs(ref("T04_okresy", d, "hustota"), ref("T02_srovnani", c("region"), "hustota")))
    far = compare(rows, k, "rozdily_uvnitr_uzemi", F.lit("hustota okresu proti ČR"), c("density"), c("density_state"),
                  refs(ref("T04_okresy", d, "hustota"), ref("T02_srovnani", F.lit("CZ"), "hustota")))
    spread = rows.filter(c("density").isNotNull()).groupBy(*k).agg(
        F.count(F.lit(1)).alias("n"), F.max("density").alias("hi"), F.min("density").alias("lo"),
        F.max_by("district", F.struct("density", "district")).alias("hi_d"),
        F.min_by("district", F.struct("density", "district")).alias("lo_d")).filter(c("n") >= 2)
    ends = compare(spread, k, "rozdily_uvnitr_uzemi", F.lit("rozpětí hustoty mezi okresy"), c("hi"), c("lo"),
                   refs(ref("T04_okresy", c("hi_d"), "hustota"), ref("T04_okresy", c("lo_d"), "hustota")))
    return near.unionByName(far).unionByName(ends)


def activity_deviation(activity: DataFrame, key: list[str]) -> DataFrame:
    """Activity share of the section against all industries. activity(key, territory, share, share_all)."""
    t = F.col("territory")
    return compare(activity, key, "aktivita_oboru", F.lit("podíl se zjištěnou aktivitou: sekce proti všem oborům"),
                   F.col("share"), F.col("share_all"), refs(ref("T01_zakladni", t, "sekce"), ref("T01_zakladni", t, "vse")))


def rank_divergence(ranks: DataFrame, key: list[str], label: str, one_place_ok: bool, table: str) -> DataFrame:
    """Rank by count against rank by density, normalised by the number of peers - 1.
    ranks(key, place, rank_count, rank_density, peers)."""
    p = F.col("place")
    rows = ranks.filter(F.col("peers") >= 3)
    if not one_place_ok:
        rows = rows.filter(F.abs(F.col("rank_count") - F.col("rank_density")) >= 2)
    strength = F.abs(F.col("rank_count") - F.col("rank_density")).cast("double") / (F.col("peers") - 1)
    return compare(rows, key, "divergence_poradi", F.lit(label), F.col("rank_count"), F.col("rank_density"),
                   refs(ref(table, p, "poradi_pocet"), ref(table, p, "poradi_hustota")), strength)


def published_deviation(rows: DataFrame, key: list[str], kind: str, measures: list[tuple[str, str]], table: str) -> DataFrame:
    """Wage and account figures of a territory against the state in the same year.
    rows(key, territory, year, <m>, <m>_state); measures = (column, subtype)."""
    place = F.concat_ws(" ", "territory", F.col("year").cast("string"))
    state = F.concat_ws(" ", F.lit("CZ"), F.col("year").cast("string"))
    out = None
    for column, subtype in measures:
        one = compare(rows, key, kind, F.lit(subtype), F.col(column), F.col(f"{column}_state"),
                      refs(ref(table, place, column), ref(table, state, column)))
        out = one if out is None else out.unionByName(one)
    return out


def development(rows: DataFrame, key: list[str], kind: str, measures: list[tuple[str, str]], table: str) -> DataFrame:
    """Development against the state: index of the last to the first year of a territory beside the
    state's index of the same years. rows(key, territory, year, <m>); a series has one row per year."""
    c = F.col
    ends = rows.groupBy(*key, "territory").agg(
        F.min("year").alias("y0"), F.max("year").alias("y1"),
        *[F.min_by(m, "year").alias(f"{m}_0") for m, _ in measures], *[F.max_by(m, "year").alias(f"{m}_1") for m, _ in measures])
    state = ends.filter(c("territory") == "CZ").select(
        *key, "y0", "y1", *[c(f"{m}_{i}").alias(f"{m}_s{i}") for m, _ in measures for i in (0, 1)])
    j = ends.filter((c("territory") != "CZ") & (c("y0") < c("y1"))).join(state, [*key, "y0", "y1"])
    place = lambda t, y: F.concat_ws(" ", t, c(y).cast("string"))
    out = None
    for m, label in measures:
        whole = (c(f"{m}_0") != 0) & (c(f"{m}_1") != 0) & (c(f"{m}_s0") != 0) & (c(f"{m}_s1") != 0)
        own = F.when(whole, F.round(c(f"{m}_1") / c(f"{m}_0"), 2))
        reference = F.when(whole, F.round(c(f"{m}_s1") / c(f"{m}_s0"), 2))
        sources = refs(*[ref(table, place(t, y), m) for t in (c("territory"), F.lit("CZ")) for y in ("y0", "y1")])
        one = compare(j, [*key, "territory"], kind, F.lit(label), own, reference, sources)
        out = one if out is None else out.unionByName(one)
    return out


def assemble(parts: list[DataFrame], report: list[str]) -> DataFrame:
    """All findings of a report in order of strength, kind and subtype, with content-based ids."""
    common = [*report, "kind", "subtype", "value", "reference", "strength", "difference_pct", "direction", "sources"]
    extra = {"territory_effect": "boolean", "original_strength": "double", "others_difference_pct": "double"}
    union = None
    for p in parts:
        for name, kind in extra.items():
            if name not in p.columns:
                p = p.withColumn(name, F.lit(None).cast(kind))
        p = p.select(*common, *extra)
        union = p if union is None else union.unionByName(p)
    prefix = F.create_map(*[F.lit(x) for pair in X.FINDING_KINDS for x in pair])[F.col("kind")]
    content = F.concat_ws("|", "kind", "subtype", F.array_join("sources", "|"))
    order = Window.partitionBy(*report).orderBy(F.desc("strength"), _rank_of_kind(), "subtype", F.array_join("sources", "|"))
    # a report has at most a few hundred findings: tables x items of the code lists
    return union.withColumn("finding_id", finding_id(prefix, content)).withColumn("position", F.row_number().over(order))


def duplicate_ids(findings: DataFrame, report: list[str]) -> DataFrame:
    return findings.groupBy(*report, "finding_id").count().filter("count > 1")
