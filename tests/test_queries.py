"""Every registered query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry
import compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    verdict, got, want = compare.compare(spark, con, SF, entry.queries()[name], entry.oracle_sql().get(name))
    assert verdict in ("ok", "rows"), (verdict, got, want)


def test_names():
    names = [n.lower() for n in entry.queries()]
    assert not [n for n in names if "pipeline" in n and n != "pipeline"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
