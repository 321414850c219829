"""Every query against its DuckDB oracle on the smallest data; queries without one must give rows."""

import pytest

import __spark_entry__ as entry
from workloads.case import CASES
from workloads.check import compare

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.mark.parametrize("name", list(CASES))
def test_query(spark, name):
    fn = entry.queries()[name]
    if name in SQL:
        diff, _ = compare(spark, SF, fn, SQL[name])
        assert diff is None, diff
    else:
        assert fn(spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
