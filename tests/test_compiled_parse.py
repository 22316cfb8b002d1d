"""Parsed envelopes and compared catalogs run in methods that HotSpot compiles, in any session."""

import pytest

from changelake.operators.drift import table_events
from changelake.operators.envelope import parse_envelope

LIMIT = "spark.sql.codegen.hugeMethodLimit"


@pytest.fixture
def default_limit(spark):
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, "65535")
    yield
    spark.conf.set(LIMIT, before)


def test_parsed_envelopes(spark, default_limit):
    parse_envelope(spark.createDataFrame([(1, "{}")], "seq bigint, value string"))
    assert spark.conf.get(LIMIT) == "8000"


def test_compared_catalogs(spark, default_limit):
    catalog = spark.createDataFrame([], "table_full string, column string, ordinal int, data_type string, column_default string")
    table_events(catalog, catalog)
    assert spark.conf.get(LIMIT) == "8000"
