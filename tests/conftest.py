import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cohort_spark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", "tests", spark__sql__shuffle__partitions="8")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows under a DDL schema; time stamps as text become timestamp_ntz columns."""

    def make(schema: str, rows: list):
        plain = schema.replace("timestamp_ntz", "string")
        df = spark.createDataFrame(rows, plain)
        for part in schema.split(","):
            name, kind = part.split()
            if kind == "timestamp_ntz":
                df = df.withColumn(name, df[name].cast("timestamp_ntz"))
        return df

    return make


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]
