"""Registry records (JSON) to versions, seats, relations; what cannot be read goes to side outputs.

One subject has a base record and, where it is in the public register, a history record. Both are kept
raw whatever happens later; parsing is permissive, so one bad record never blocks the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regisight.functions.numbers import money_amount, money_currency, percent, share_percent
from regisight.functions.text import plain_words, with_role
from regisight.operators.rules import ID
from regisight.operators.temporal import clip_overlaps, version_slices
from regisight.session import materialise

ADDRESS = ("kodAdresnihoMista bigint, nazevUlice string, cisloDomovni int, typCisloDomovni int, cisloOrientacni int, "
           "cisloOrientacniPismeno string, nazevObce string, nazevCastiObce string, psc string, pscTxt string, kodStatu string, "
           "kodObce int, kodKraje int, textovaAdresa string")
BASE = ("ico string, icoId string, obchodniJmeno string, pravniForma string, datumVzniku string, datumZaniku string, "
        "datumAktualizace string, dic string, czNace array<string>, "
        f"sidlo struct<{ADDRESS}>, "
        "adresaDorucovaci map<string,string>, seznamRegistraci struct<stavZdrojeIr string>")
_VALUED = "array<struct<datumZapisu string, datumVymazu string, hodnota string>>"
_AMOUNT = "struct<typObnos string, hodnota string>"
_PERSON = ("struct<jmeno string, prijmeni string, titulPredJmenem string, titulZaJmenem string, datumNarozeni string, "
           "statniObcanstvi string, textOsoba string>")
_MEMBER = ("datumZapisu string, datumVymazu string, nazevAngazma string, "
           "clenstvi struct<funkce struct<nazev string, vznikFunkce string, zanikFunkce string>, "
           "clenstvi struct<vznikClenstvi string, zanikClenstvi string>>, "
           f"fyzickaOsoba {_PERSON}, "
           "pravnickaOsoba struct<ico string, obchodniJmeno string, adresa struct<kodStatu string>>")
_ORGAN = f"array<struct<typOrganu string, nazevOrganu string, datumVymazu string, clenoveOrganu array<struct<{_MEMBER}>>>>"
_SHARE = f"struct<datumZapisu string, datumVymazu string, vklad {_AMOUNT}, velikostPodilu {_AMOUNT}, splaceni {_AMOUNT}>"
_OWNERS = ("array<struct<typOrganu string, nazevOrganu string, datumVymazu string, spolecnik array<struct<datumZapisu string, "
           f"datumVymazu string, osoba struct<{_MEMBER}>, podil array<{_SHARE}>>>>>")
HISTORY = ("icoId string, kod string, zaznamy array<struct<primarniZaznam boolean, "
           f"obchodniJmeno {_VALUED}, pravniForma {_VALUED}, "
           "spisovaZnacka array<struct<datumZapisu string, datumVymazu string, oddil string, vlozka string, soud string>>, "
           f"zakladniKapital array<struct<datumZapisu string, datumVymazu string, vklad {_AMOUNT}>>, "
           f"adresy array<struct<typAdresy string, datumZapisu string, datumVymazu string, adresa struct<{ADDRESS}>>>, "
           f"statutarniOrgany {_ORGAN}, ostatniOrgany {_ORGAN}, akcionari {_ORGAN}, spolecnici {_OWNERS}>>")
# --- fixed value: start of versions whose subject has no founding day ---------------
BEGINNING = "0001-01-01"
SHARE_FIELDS = ["deposit", "deposit_currency", "share_text", "share_percent", "paid_percent"]


def read_raw(spark: SparkSession, path: str, endpoint: str) -> DataFrame:
    """Raw responses, one file each, kept as they came."""
    return spark.read.option("wholetext", True).text(path).select(
        F.lit(endpoint).alias("endpoint"), F.col("_metadata.file_name").alias("file"), F.col("value").alias("raw"))


def primary(records: Column) -> Column:
    """The record marked primary; of several the first."""
    return F.get(F.filter(records, lambda z: z["primarniZaznam"]), F.lit(0))


def primary_or_first(records: Column) -> Column:
    return F.coalesce(primary(records), F.get(records, F.lit(0)))


def _day(text: Column) -> Column:
    return F.substring(text, 1, 10).try_cast("date")


def parse(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """raw(base_json, history_json) -> (subjects(ico, base, hist), rejected(base_json, reason))."""
    # each text is parsed once: nothing is pushed below or drawn into a generated row
    parsed = raw.select("base_json", F.inline(F.array(F.struct(F.from_json("base_json", BASE).alias("base"), F.from_json("history_json", HISTORY).alias("h")))))
    good = F.coalesce(F.col("base.ico").rlike(ID), F.lit(False))
    history = F.when(F.col("h.kod").isNull(), primary(F.col("h.zaznamy")))
    ok = parsed.filter(good).select(F.col("base.ico").alias("ico"), "base", history.alias("hist"))
    return ok, parsed.filter(~good).select("base_json", F.lit("subject without a valid id").alias("reason"))


def store(parsed: DataFrame) -> DataFrame:
    """Typed copy of the parsed records in the shared folder. JSON is parsed once; each later step reads
    only its nested columns from Parquet."""
    return materialise(parsed, "registry")


def _dated(subjects: DataFrame, field: str, attribute: str, value) -> DataFrame:
    """Intervals of one history list: (ico, attribute, start, end, value, pos), empty ones dropped."""
    x = subjects.select("ico", F.posexplode(F.col(f"hist.{field}")).alias("pos", "e"))
    rows = x.select("ico", F.lit(attribute).alias("attribute"), _day(F.col("e.datumZapisu")).alias("start"),
                    _day(F.col("e.datumVymazu")).alias("end"), value(F.col("e")).alias("value"), F.col("pos").cast("bigint").alias("pos"))
    return rows.filter(F.col("start").isNotNull() & F.col("value").isNotNull() & (F.col("end").isNull() | (F.col("end") > F.col("start"))))


def _liquidations(subjects: DataFrame) -> DataFrame:
    organ = subjects.select("ico", F.explode("hist.statutarniOrgany").alias("o")).filter(F.col("o.typOrganu") == "LIKVIDATOR")
    m = organ.select("ico", F.col("o.datumVymazu").alias("od"), F.posexplode("o.clenoveOrganu").alias("pos", "m"))
    d = m.select("ico", "pos", *_member_dates(F.col("m"), F.col("od")))
    return d.filter(F.col("start").isNotNull()).select(
        "ico", F.lit("liquidation").alias("attribute"), "start", "end", F.lit("true").alias("value"), F.col("pos").cast("bigint").alias("pos"))


def versions(subjects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(versions of the subjects, warnings). A subject's life is cut wherever one of its recorded
    attributes changes; facts known only for today are filled into the open version."""
    c = F.col
    mark = lambda e: F.when(
        (e["oddil"] != "") & (e["vlozka"] != "") & (e["soud"] != ""), F.concat(e["oddil"], F.lit(" "), e["vlozka"], F.lit("/"), e["soud"]))
    capital = lambda e: F.concat(
        money_amount(e["vklad"]["typObnos"], e["vklad"]["hodnota"]).cast("string"), F.lit("|"), money_currency(e["vklad"]["typObnos"]))
    recorded_names = _dated(subjects, "obchodniJmeno", "name", lambda e: e["hodnota"])
    recorded = (
        recorded_names.unionByName(_dated(subjects, "pravniForma", "form", lambda e: e["hodnota"]))
        .unionByName(_dated(subjects, "spisovaZnacka", "mark", mark)).unionByName(_dated(subjects, "zakladniKapital", "capital", capital))
        .unionByName(_liquidations(subjects)))
    # tables of the register's size meet below: none is broadcast, whatever their files seem to weigh
    start = F.coalesce(_day(c("base.datumVzniku")), F.lit(BEGINNING).cast("date"))
    own = subjects.select("ico", start.alias("start"), c("base.obchodniJmeno").alias("own_name"), c("base.pravniForma").alias("own_form"), c("hist").isNull().alias("no_history"))
    nameless = own.join(recorded_names.select("ico").distinct().hint("merge"), "ico", "left_anti")
    fallback = nameless.select("ico", "start", F.lit(None).cast("date").alias("end"), F.lit(0).cast("bigint").alias("pos"), F.inline(F.array(
        F.struct(F.lit("name").alias("attribute"), c("own_name").alias("value")),
        F.struct(F.lit("form").alias("attribute"), F.when(c("no_history"), c("own_form")).alias("value"))))).filter(c("value").isNotNull())
    warnings = nameless.filter(~c("no_history")).select("ico", F.lit("register extract without a name, base record used").alias("warning"))
    base = subjects.select(
        "ico", c("hist").isNull().alias("no_history"), _day(c("base.datumVzniku")).alias("founded"), _day(c("base.datumZaniku")).alias("closed"),
        c("base.dic").alias("tax_id"), F.array_sort(F.array_distinct("base.czNace")).alias("nace"), _day(c("base.datumAktualizace")).alias("updated"),
        F.coalesce(c("base.seznamRegistraci.stavZdrojeIr") == "AKTIVNI", F.lit(False)).alias("insolvent"))
    names = ["name", "form", "mark", "capital", "liquidation"]
    sliced = version_slices(recorded.unionByName(fallback), ["ico"], names, "name", base.select("ico", "closed"))
    j = sliced.join(base.hint("merge"), "ico")
    is_open = c("end").isNull()
    unknown_start = c("no_history") & c("founded").isNull() & (c("start") == F.lit(BEGINNING).cast("date"))
    return j.select(
        "ico", "name", c("form").alias("form_code"), F.when(c("gone"), "ZANIKLY").otherwise("AKTIVNI").alias("state"),
        (c("liquidation").isNotNull() | plain_words(c("name")).contains("v likvidaci")).alias("in_liquidation"),
        F.when(is_open, c("insolvent")).alias("insolvent"), "founded", "closed", F.when(is_open, c("tax_id")).alias("tax_id"),
        c("mark").alias("file_mark"), F.split_part("capital", F.lit("|"), F.lit(1)).try_cast("decimal(18,2)").alias("capital"),
        F.nullif(F.split_part("capital", F.lit("|"), F.lit(2)), F.lit("")).alias("currency"),
        F.when(is_open & (F.size("nace") > 0), c("nace")).alias("nace"), F.when(is_open, c("updated")).alias("updated"),
        F.when(~unknown_start, c("start")).alias("start"), "end"), warnings


def address_columns(a: Column) -> list[Column]:
    number = a["cisloDomovni"].cast("string")
    orientation = F.concat(a["cisloOrientacni"].cast("string"), F.coalesce(a["cisloOrientacniPismeno"], F.lit("")))
    return [
        a["kodAdresnihoMista"].alias("ruian"), a["nazevUlice"].alias("street"), F.when(a["typCisloDomovni"] == 1, number).alias("house"),
        F.when(a["typCisloDomovni"] == 2, number).alias("registration"), orientation.alias("orientation"), a["nazevObce"].alias("town"),
        a["nazevCastiObce"].alias("town_part"),
        F.coalesce(F.when(a["psc"].rlike("^[0-9]+$"), F.lpad(a["psc"], 5, "0")).otherwise(a["psc"]), a["pscTxt"]).alias("zip"),
        a["kodStatu"].alias("state"), a["kodKraje"].alias("region_ruian"), a["textovaAdresa"].alias("original")]


def seats(subjects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(seats and delivery addresses, warnings and skipped items). Overlapping seats are clipped; without a
    recorded seat the one of the base record holds; a delivery address repeating the seat is dropped."""
    c = F.col
    listed = subjects.select("ico", F.posexplode("hist.adresy").alias("pos", "e"))
    is_seat = F.coalesce(c("e.typAdresy") == "SIDLO", F.lit(False))
    skipped = listed.filter(~is_seat).select("ico", F.concat(F.lit("unknown kind of address: "), F.coalesce("e.typAdresy", F.lit("None"))).alias("note"))
    dated = listed.filter(is_seat).select("ico", c("pos").cast("bigint").alias("pos"), _day(c("e.datumZapisu")).alias("start"),
                                          _day(c("e.datumVymazu")).alias("end"), c("e.adresa").alias("address")).filter(c("start").isNotNull())
    clipped = clip_overlaps(dated, ["ico"], ["address"])
    cut = clipped.filter(c("clipped") | (c("replaced") > 0)).select(
        "ico", F.concat(F.lit("overlapping seats from "), c("start").cast("string"), F.lit(", the older one shortened")).alias("note"))
    rest = subjects.join(clipped.select("ico").distinct(), "ico", "left_anti").filter(c("base.sidlo").isNotNull())
    none = F.lit(None).cast("date")
    base_seat = rest.select("ico", none.alias("start"), none.alias("end"), c("base.sidlo").alias("address"))
    replaced = rest.filter(c("hist").isNotNull()).select("ico", F.lit("register extract without a seat, base record used").alias("note"))
    all_seats = clipped.select("ico", "start", "end", "address").unionByName(base_seat)
    open_seat = all_seats.filter(c("end").isNull()).select("ico", c("address.textovaAdresa").alias("_seat"))
    lines = F.filter(F.array_sort(F.map_entries("base.adresaDorucovaci")), lambda e: e["key"].startswith("radekAdresy") & (e["value"] != ""))
    text = F.array_join(F.transform(lines, lambda e: e["value"]), ", ")
    delivery = subjects.select("ico", text.alias("original"), c("base.sidlo.kodStatu").alias("state")).join(open_seat, "ico", "left")
    words = plain_words(c("original"))
    kept = delivery.filter(~words.isin("", "ceska republika") & ~F.coalesce(words == plain_words(c("_seat")), F.lit(False)) & c("original").isNotNull())
    rows = all_seats.select("ico", F.lit("SIDLO").alias("kind"), *address_columns(c("address")), "start", "end").unionByName(
        kept.select("ico", F.lit("DORUCOVACI").alias("kind"), "original", "state", none.alias("start"), none.alias("end")), allowMissingColumns=True)
    return rows, skipped.unionByName(cut).unionByName(replaced)


def _member_dates(m: Column, organ_end: Column) -> list[Column]:
    """Dates of a membership: of the function, else of the membership, else of the registration; an
    inconsistent pair falls back to the registration."""
    registered = _day(m["datumZapisu"])
    deleted = F.coalesce(_day(m["datumVymazu"]), _day(organ_end))
    start = F.coalesce(_day(m["clenstvi"]["funkce"]["vznikFunkce"]), _day(m["clenstvi"]["clenstvi"]["vznikClenstvi"]), registered)
    end = F.coalesce(_day(m["clenstvi"]["funkce"]["zanikFunkce"]), _day(m["clenstvi"]["clenstvi"]["zanikClenstvi"]), deleted)
    wrong = F.coalesce(end < start, F.lit(False))
    return [F.when(wrong, registered).otherwise(start).alias("start"), F.when(wrong, deleted).otherwise(end).alias("end"),
            registered.alias("registered"),
            F.when(~F.coalesce(deleted < registered, F.lit(False)), deleted).alias("deleted")]


def relations(subjects: DataFrame, form_of: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(relations, skipped items) of all organs and owners; form_of(ico, form_code) = last legal form."""
    c = F.col
    none = F.lit(None)
    organs = F.flatten(F.array_compact(F.array("hist.statutarniOrgany", "hist.ostatniOrgany", "hist.akcionari")))
    # subjects meet their forms before they are unfolded to members; both sides grow with the register, so neither is broadcast
    formed = subjects.join(form_of.hint("merge"), "ico", "left")
    members = formed.select("ico", "form_code", F.posexplode(organs).alias("p1", "o")).select(
        "ico", "form_code", "p1", c("o.typOrganu").alias("organ_type"), c("o.nazevOrganu").alias("organ_name"), c("o.datumVymazu").alias("organ_end"),
        F.posexplode("o.clenoveOrganu").alias("p2", "m")).select(
        "ico", "form_code", F.lit(0).alias("g"), "p1", "p2", F.lit(0).alias("p3"), "organ_type", "organ_name", "organ_end", "m", c("m.clenstvi.funkce.nazev").alias("function"),
        none.cast(_SHARE).alias("share"))
    coop = subjects.select("ico", F.explode("hist.spolecnici").alias("o")).filter(c("o.typOrganu") == "VKLAD_CLEN_DRUZSTVA_SEKCE").select(
        "ico", F.concat(F.lit("out of scope, cooperative members: "), F.size("o.spolecnik").cast("string")).alias("note"))
    owner_rows = formed.select("ico", "form_code", F.posexplode("hist.spolecnici").alias("p1", "o"))
    owners = owner_rows.filter(~F.coalesce(c("o.typOrganu") == "VKLAD_CLEN_DRUZSTVA_SEKCE", F.lit(False))).select(
        "ico", "form_code", "p1", c("o.typOrganu").alias("organ_type"), c("o.nazevOrganu").alias("organ_name"), c("o.datumVymazu").alias("organ_end"),
        F.posexplode("o.spolecnik").alias("p2", "s"))
    person = F.col("s.osoba")
    m = F.when(person.isNotNull(), person.withField("datumZapisu", F.coalesce(person["datumZapisu"], c("s.datumZapisu"))).withField(
        "datumVymazu", F.coalesce(person["datumVymazu"], c("s.datumVymazu"))))
    owned = owners.select("ico", "form_code", F.lit(1).alias("g"), "p1", "p2", "organ_type", "organ_name", "organ_end", m.alias("m"), none.cast("string").alias("function"),
                          F.posexplode_outer("s.podil").alias("p3", "share"))
    every = members.unionByName(owned.withColumn("p3", F.coalesce("p3", F.lit(0))))
    raw = with_role(every, "organ_type", "organ_name", "function", "form_code").withColumn(
        "d", F.struct(*_member_dates(c("m"), c("organ_end"))))
    person, firm = c("m.fyzickaOsoba"), c("m.pravnickaOsoba")
    firm_id = F.btrim(F.coalesce(firm["ico"], F.lit("")))
    kind = (
        F.when(person.isNotNull(), F.when(F.coalesce(person["prijmeni"], F.lit("")) != "", "OSOBA"))
        .when(firm.isNotNull() & (firm_id != ""), F.when(firm_id.rlike(ID) & (firm_id != c("ico")), "SUBJEKT"))
        .when(firm.isNotNull(), F.when(firm["obchodniJmeno"].isNotNull() & firm["adresa"]["kodStatu"].isNotNull(), "POJMENOVANY")))
    why = (
        F.when(c("role_code").isNull(), F.concat_ws(" / ", F.lit("unknown role"), "organ_type", "organ_name", "function"))
        .when(person.isNotNull(), "person without a surname")
        .when(firm.isNotNull() & (firm_id != ""), F.when(firm_id == c("ico"), "member is the subject itself").otherwise("invalid id of a member"))
        .when(firm.isNotNull(), "legal person without an id and without a name or state").otherwise("member without a person"))
    s = c("share")
    amount = money_amount(s["vklad"]["typObnos"], s["vklad"]["hodnota"])
    marked = raw.withColumn("member_kind", kind).withColumn("_amount", amount).withColumns(
        {"_first": plain_words(person["jmeno"]), "_last": plain_words(person["prijmeni"]), "_firm": plain_words(firm["obchodniJmeno"])})
    usable = c("role_code").isNotNull() & c("member_kind").isNotNull()
    skipped = marked.filter(~usable).select("ico", why.alias("note")).unionByName(coop)
    start = F.coalesce(_day(s["datumZapisu"]), c("d.start"))
    end = F.coalesce(_day(s["datumVymazu"]), c("d.end"))
    # only a share can end before it starts here; it then ends where it starts
    end = F.when(s.isNotNull() & F.coalesce(end < start, F.lit(False)), start).otherwise(end)
    is_person, is_firm, is_named = (c("member_kind") == k for k in ("OSOBA", "SUBJEKT", "POJMENOVANY"))
    member = F.struct(
        F.when(is_person, person["jmeno"]).alias("first"), F.when(is_person, person["prijmeni"]).alias("last"),
        F.when(is_person, person["titulPredJmenem"]).alias("title_before"), F.when(is_person, person["titulZaJmenem"]).alias("title_after"),
        F.when(is_person, _day(person["datumNarozeni"])).alias("born"), F.when(is_person, person["statniObcanstvi"]).alias("citizenship"),
        F.when(is_firm, firm_id).alias("member_ico"), F.when(is_named, firm["obchodniJmeno"]).alias("member_name"),
        F.when(is_named, firm["adresa"]["kodStatu"]).alias("member_state"))
    key = (
        F.when(is_person, F.concat_ws("|", F.lit("OSOBA"), c("_first"), c("_last"),
                                      F.coalesce(_day(person["datumNarozeni"]).cast("string"), F.lit("?"))))
        .when(is_firm, F.concat_ws("|", F.lit("SUBJEKT"), firm_id))
        .otherwise(F.concat_ws("|", F.lit("POJMENOVANY"), c("_firm"), firm["adresa"]["kodStatu"])))
    kept = marked.filter(usable).select(
        "ico", key.alias("member_key"), "member_kind", member.alias("member"), "role_code",
        F.nullif(F.concat_ws(" / ", F.nullif("organ_name", F.lit("")), F.nullif("function", F.lit(""))), F.lit("")).alias("organ"),
        c("_amount").alias("deposit"), F.when(c("_amount").isNotNull(), money_currency(s["vklad"]["typObnos"])).alias("deposit_currency"),
        s["velikostPodilu"]["hodnota"].alias("share_text"),
        share_percent(s["velikostPodilu"]["typObnos"], s["velikostPodilu"]["hodnota"]).alias("share_percent"),
        percent(s["splaceni"]["typObnos"], s["splaceni"]["hodnota"]).cast("decimal(7,4)").alias("paid_percent"),
        start.alias("start"), end.alias("end"), F.coalesce(_day(s["datumZapisu"]), c("d.registered")).alias("registered"),
        F.coalesce(_day(s["datumVymazu"]), c("d.deleted")).alias("deleted"), F.struct("g", "p1", "p2", "p3").alias("pos"))
    return merge_registrations(kept), skipped


def merge_registrations(rows: DataFrame) -> DataFrame:
    """Repeated registrations of one relation become one row: same member, role, share and start first
    (an open end wins, the member's data come from the latest registration), then adjoining rows of the
    same content. Windows hold one row per start day of one relation."""
    c = F.col
    identity = ["ico", "member_key", "member_kind", "role_code", *SHARE_FIELDS]

    def open_or_last(x: str) -> Column:
        return F.when(F.count_if(c(x).isNull()) == 0, F.max(x)).alias(x)

    source_order = F.struct(*[(-c(f"pos.{p}")).alias(p) for p in ("g", "p1", "p2", "p3")])
    latest = F.struct(F.coalesce("registered", F.lit(BEGINNING).cast("date")).alias("d"), source_order.alias("o"))
    once = rows.groupBy(*identity, "start").agg(
        open_or_last("end"), F.min("registered").alias("registered"), open_or_last("deleted"),
        F.max_by("member", latest).alias("member"), F.min_by("organ", "pos").alias("organ"), F.min("pos").alias("pos"))
    w = Window.partitionBy(*identity).orderBy("start")
    joins = F.coalesce(F.lag("end").over(w) == c("start"), F.lit(False))
    runs = once.withColumn("_n", F.when(joins, 0).otherwise(1)).withColumn(
        "_run", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    order = F.coalesce("start", F.lit(BEGINNING).cast("date"))
    return runs.groupBy(*identity, "_run").agg(
        F.min("start").alias("start"), F.max_by(F.struct("end"), order)["end"].alias("end"),
        F.min_by(F.struct("registered"), order)["registered"].alias("registered"), F.max_by(F.struct("deleted"), order)["deleted"].alias("deleted"),
        F.max_by("member", order).alias("member"), F.min_by(F.struct("organ"), order)["organ"].alias("organ"), F.min("pos").alias("pos")).drop("_run").select(
            "*", "member.*").drop("member")


def map_subjects(raw: DataFrame) -> dict[str, DataFrame]:
    """All outputs of a batch of raw records: versions, seats, relations, notes, rejected."""
    parsed, rejected = parse(raw)
    subjects = store(parsed)
    v, warnings = versions(subjects)
    a, notes = seats(subjects)
    order = F.struct(F.coalesce("start", F.lit(BEGINNING).cast("date")))
    forms = v.groupBy("ico").agg(F.max_by(F.struct("form_code"), order)["form_code"].alias("form_code"))
    r, skipped = relations(subjects.filter(F.col("hist").isNotNull()), forms)
    every_note = warnings.withColumnRenamed("warning", "note").unionByName(notes).unionByName(skipped)
    return {"versions": v, "seats": a, "relations": r, "notes": every_note, "rejected": rejected}
