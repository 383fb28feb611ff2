"""Every query over trips against its SQL, on whole tables."""

import pytest

from __spark_entry__ import oracle_sql, queries
from dockflow.plans.catalog import QUERIES
from tests.compare import duck_rows, oracle, same, spark_rows

NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def duck(small):
    return oracle(small)


def test_every_query_has_sql():
    assert set(NAMES) <= set(oracle_sql()) & set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_matches(spark, duck, small, name):
    columns, found = spark_rows(queries()[name](spark, small))
    expected_columns, expected = duck_rows(duck, oracle_sql()[name])
    assert columns == expected_columns
    assert len(found) == len(expected) > 0
    for left, right in zip(found, expected, strict=True):
        assert all(map(same, left, right)), (left, right)
