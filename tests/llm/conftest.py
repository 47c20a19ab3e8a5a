import os

import pytest

from tests.conftest import spark  # noqa: F401

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def docs(spark):  # noqa: F811
    """A documents table of (doc_id, text) rows."""
    return lambda rows: spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)


@pytest.fixture
def given(spark):  # noqa: F811
    """A given table, or a skip where the tables are not here."""
    if not os.path.isdir(FOLDER):
        pytest.skip("tables are not here")
    return lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
