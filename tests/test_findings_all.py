"""findings_all_ranked holds every kind of finding."""

from regisight import catalog
from regisight.operators import findings as K


def test_all_kinds_are_ranked(spark):
    catalog.load_all()
    out = catalog.QUERIES["findings_all_ranked"](spark, "/root/testdata/sf0.01").select("kind", "place").collect()
    assert {r.kind for r in out} == set(K.KINDS) and min(r.place for r in out) == 1
