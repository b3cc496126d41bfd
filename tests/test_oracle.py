import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from check import attach, compare  # noqa: E402
from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from footfall.checks.oracle import ORACLE  # noqa: E402
from footfall.checks.queries import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return attach(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    got, want, same = compare(spark, duck, FOLDER, name)
    assert len(got) == len(want) and same


def test_entry(spark):
    assert entry(spark).count() > 0
