"""Wide silver projections run in methods that HotSpot compiles."""

import pytest

from changelake.operators.conform import Target, conform

LIMIT = "spark.sql.codegen.hugeMethodLimit"


@pytest.fixture
def default_limit(spark):
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, "65535")
    yield
    spark.conf.set(LIMIT, before)


def test_wide_projections_are_compiled_in_any_session(spark, default_limit):
    conform(spark.createDataFrame([("1",)], "a string"), [Target("A", "string", "a", "code")])
    assert spark.conf.get(LIMIT) == "8000"
    spark.conf.set(LIMIT, "4000")
    conform(spark.createDataFrame([("1",)], "a string"), [Target("A", "string", "a", "code")])
    assert spark.conf.get(LIMIT) == "4000"
