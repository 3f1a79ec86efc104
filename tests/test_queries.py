"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import DATA, connect, differences

SQL = entry.oracle_sql()
LLM = {q for q in SQL if q.startswith("op") or q == "pipeline"}  # tested in their own folder
# the smallest picture is 12 pixels high: these have no row there
LARGER = {"e5_open", "e5_open_22", "e6_close_16", "e6_close_22", "f6_shore_median", "g7_river_flood_mask"}


@pytest.fixture(scope="module")
def con():
    return {sf: connect(DATA / sf) for sf in ("sf0.001", "sf0.01")}


@pytest.mark.parametrize("name", sorted(set(SQL) - LLM))
def test_query_equals_sql(spark, con, name):
    sf = "sf0.01" if name in LARGER else "sf0.001"
    df = entry.queries()[name](spark, str(DATA / sf))
    assert differences(df, con[sf], SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
