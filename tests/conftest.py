import tempfile

import pytest

from anaquel.session import build_session


# Column expressions in parameter lists need a running session when tests are collected.
SESSION = build_session("local[8]", 8, tempfile.mkdtemp(prefix="anaquel-tests-"))
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture
def one(spark):
    """Evaluate column expressions over one row of named text values."""
    from pyspark.sql import functions as F

    def run(column, **values):
        row = spark.range(1).select(*[F.lit(v).cast("string").alias(k) if v is None or isinstance(v, str) else F.lit(v).alias(k) for k, v in values.items()])
        return row.select(column.alias("out")).first()["out"]

    return run
