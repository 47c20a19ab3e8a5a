"""Every registered query next to its SQL, on the smallest tables."""

import os

import pytest

from cohort_spark.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import FOLDER
from tools.check_oracles import compare, connect

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, FOLDER), duck, ORACLES[name]).startswith("ok")


def test_each_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
