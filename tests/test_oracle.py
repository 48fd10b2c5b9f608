"""Every registered query equals its DuckDB oracle on the smallest driver folder."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables missing")
def test_all_queries_match_oracle(spark):
    import oracle_check
    rep = oracle_check.run(spark, SF, verbose=False)
    bad = {k: r for k, r in rep.items() if not oracle_check.good(r)}
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    from cartwheel.plans.catalog import queries
    assert set(queries()) <= set(e.oracle_sql()) <= set(e.queries())
