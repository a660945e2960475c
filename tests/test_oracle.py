"""Every registered query against its SQL on the smallest given tables."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

import __spark_entry__ as entry  # noqa: E402
from tools.check_oracle import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry_is_stable(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.schema == entry.entry(spark).schema


OWN = sorted(n for n in entry.queries() if not re.fullmatch(r"op\d+_\w+|pipeline", n))


def test_every_query_has_sql():
    assert set(OWN) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, con, name):
    rows, expected, differences = compare(spark, con, name, SF)
    assert not differences and rows == expected
