"""Every registered query against its DuckDB oracle on the smallest test data."""

from shelfwise.checks.compare import compare

SF = "/root/testdata/sf0.001"


def test_all_queries_match_oracle(spark):
    from shelfwise.plans.registry import QUERIES
    res = compare(spark, SF, list(QUERIES), verbose=False)
    bad = {k: v for k, v in res.items() if not v.startswith("OK ")}
    assert not bad, bad


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() >= 0
    assert "calc_type" in df.columns
