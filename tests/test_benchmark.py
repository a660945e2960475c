"""Structure of a territory beside the state and chosen regions."""

from regisight.operators import structure as S

CELLS = [("CR", "CZ", 100, 60, 30, 11, 8), ("KRAJ", "A", 50, 40, 12, 4, 0), ("KRAJ", "B", 30, 12, 11, 5, 3), ("OKRES", "a1", 50, 40, 12, 4, 0), ("OKRES", "b1", 20, 4, 3, 0, 0),
         ("OKRES", "b2", 10, 8, 8, 5, 3)]
PLACES = [("CR", "CZ", None), ("KRAJ", "A", "CZ"), ("KRAJ", "B", "CZ"), ("OKRES", "a1", "A"), ("OKRES", "b1", "B"), ("OKRES", "b2", "B")]


def frames(spark):
    cells = spark.createDataFrame([("s", lv, t, "dim", f"i{k}", n) for lv, t, *ns in CELLS for k, n in enumerate(ns) if n], "section string, level string, territory string, dim string, item string, n bigint")
    return cells, spark.createDataFrame(PLACES, "level string, territory string, parent string")


def test_a_region_is_no_reference_of_its_only_district(spark):
    got = {tuple(r)[1:] for r in S.references(frames(spark)[1], ["A", "B"]).collect()}
    assert got == {("A", "CZ"), ("A", "B"), ("B", "CZ"), ("B", "A"), ("a1", "CZ"), ("a1", "B"), ("b1", "CZ"), ("b1", "A"), ("b1", "B"), ("b2", "CZ"), ("b2", "A"), ("b2", "B")}


def test_items_follow_the_territory(spark):
    cells, places = frames(spark)
    shares, variables = S.benchmark_regions(cells, ["section"], places, ["A", "B"])
    got = {(r.territory, r.reference, r.item): (r.share, r.share_reference, r.difference) for r in shares.collect()}
    # A publishes i0 and i1 only (i3 is small and takes i2 with it): the state's i2 to i4 are merged, although two of them are large
    a = {k[2]: v for k, v in got.items() if k[:2] == ("A", "CZ")}
    assert set(a) == {"i0", "i1", "(other)"}
    assert all(v[2] is None or abs(v[2] - round(v[0] - v[1], 1)) < 1e-9 for v in got.values())
    assert round(sum(v[1] for v in a.values()), 0) == 100
    own = {k for k in got if k[0] == "b2"}
    assert own and not any(k[1] == k[0] for k in got)
    # no reference cell below the threshold is shown, and no lone small rest
    for (t, ref), group in {(r.territory, r.reference): None for r in variables.collect()}.items():
        cells_of = [r for r in variables.collect() if (r.territory, r.reference) == (t, ref)]
        assert all(r.n >= 10 for r in cells_of if r.status == "published")
        merged = sum(r.n for r in cells_of if r.status == "other")
        assert merged == 0 or merged >= 10
