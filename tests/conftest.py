import pytest

from webgraph_spark.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def many_ranges(spark):
    """Keeps small range partitions apart that AQE would put together."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)
