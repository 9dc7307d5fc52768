"""Every registered query against its SQL at the smallest scale."""

import pytest

from tests import oracle_check as oc

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oc.connect(FOLDER)


def test_all_queries_have_sql():
    assert set(oc.entry_module.ORACLE) == set(oc.entry_module.CATALOG)


@pytest.mark.parametrize("name", list(oc.entry_module.CATALOG))
def test_query_matches_sql(spark, con, name):
    ok, note = oc.compare(spark, con, FOLDER, name)
    assert ok, note


def test_entry(spark):
    df = oc.entry_module.entry(spark)
    assert df.count() > 0
    assert "window_start" in df.columns and "window_end" in df.columns
