from __future__ import annotations

import pytest

from tests.compare import oracle
from tests.sessions import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture(scope="session")
def duck(sf_dir):
    return oracle(sf_dir)


@pytest.fixture
def one(spark):
    """Evaluate a column expression over one text value."""
    from pyspark.sql import functions as F

    def run(make, value, dtype="string"):
        df = spark.createDataFrame([(value,)], f"v {dtype}")
        return df.select(make(F.col("v"))).first()[0]

    return run
