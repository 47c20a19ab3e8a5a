"""Every registered query next to its SQL, on the smallest tables."""

import os

import pytest

from cohort_spark.catalog import ORACLES, QUERIES
from tools.check_oracles import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, FOLDER), duck, ORACLES[name]).startswith("ok")
