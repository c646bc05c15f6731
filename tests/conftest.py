import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from grantweave.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture()
def value(spark):
    """Evaluates an expression over one text value."""

    def evaluate(function, text):
        df = spark.createDataFrame([(text,)], "x string")
        return df.select(function(df.x).alias("y")).first().y

    return evaluate
