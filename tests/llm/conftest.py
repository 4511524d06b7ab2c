import pytest

from sensormill.shipping import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def small_batches(spark):
    """Arrow batches of a few rows, so that groups lie across their rims."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "5")
    yield
    spark.conf.set(name, before)
