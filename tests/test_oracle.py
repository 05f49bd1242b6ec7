"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

import re

import oracle_check  # noqa: E402

import __spark_entry__ as entry


def test_all_queries_match_oracle(spark):
    # the training-data queries have their own tests
    names = sorted(n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n))
    res = oracle_check.compare(spark, "/root/testdata/sf0.001", names, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] != "ok"}
    assert not bad
    assert len(names) >= 51 and set(names) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "unique_suppliers" in df.columns
