"""Every registered query of the library runs, and equals its SQL check where it has one.

The training-data queries are tested in tests/llm, which owns them.
"""

import pytest

import __spark_entry__ as driver
from check_queries import compare
from wellspring import registry

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, duck, sf_dir):
    result = compare(spark, duck, sf_dir, name, QUERIES, ORACLES)
    assert not result.startswith("FAIL"), result


def test_every_check_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    df = driver.entry(spark)
    assert df.columns == ["operator", "wells", "oil_m3"]
    assert 0 < df.count() <= 10
