"""Settings that small tables need to be dealt over many tasks."""

import pytest


@pytest.fixture
def many_ranges(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, old)
