"""Every query against its SQL on the smallest tables."""

import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    problem, rows, _ = compare(
        spark, con, SF_DIR, entry.queries()[name], entry.oracle_sql()[name]
    )
    assert problem is None
    assert rows > 0


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 10
    assert rows[0].job_count >= rows[-1].job_count
