"""Every registered query against its check SQL on whole tables."""

import pytest

import __spark_entry__ as driver
from millwright.plans.check_sql import oracle
from millwright.plans.queries import registry
from tests.compare import connect, differences
from tests.conftest import SMALL

QUERIES, CHECKS = registry(), oracle()


@pytest.fixture(scope="module")
def check_engine():
    return connect(SMALL)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_check(spark, check_engine, name):
    assert differences(QUERIES[name](spark, SMALL), check_engine, CHECKS[name]) == []


def test_entry_has_rows_and_names(spark):
    result = driver.entry(spark)
    assert result.columns[:3] == ["quarter_start", "asset_id", "event_count"]
    assert result.count() == 280


@pytest.mark.parametrize("name", ["logistics_features_quarterly", "rolling_asset_stats",
                                  "profile_quantiles", "stratified_sample"])
def test_result_does_not_depend_on_partitioning(spark, check_engine, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert differences(QUERIES[name](spark, SMALL), check_engine, CHECKS[name]) == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_session_zone_does_not_change_results(spark, check_engine):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        name = "hrss_features_quarterly"
        assert differences(QUERIES[name](spark, SMALL), check_engine, CHECKS[name]) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
