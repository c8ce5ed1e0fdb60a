"""Every registered query against its DuckDB twin on the smallest data set."""

import pytest

from paths import SF_SMALL
from oracle_compare import compare, duck_connect

from ledgerlake.plans.registry import ORACLE, QUERIES, load_all

load_all()


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    assert key in ORACLE, f"{key} has no DuckDB twin"
    ok, msg = compare(df, duck, ORACLE[key])
    assert ok, msg


def test_entry_runs(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0
    assert "gp_net" in df.columns
