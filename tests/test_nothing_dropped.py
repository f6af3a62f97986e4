"""Rows and digits that caps, patterns and NULLs must not drop."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from millwright import contracts as c
from millwright.operators.logs import without_health_checks
from millwright.operators.quality import parse_messages, validate
from millwright.operators.sampling import bootstrap_sample, stratified_sample
from millwright.sources.messages import as_messages
from tests.conftest import utc


@pytest.mark.parametrize("rate", [0.5, 60, 800])
def test_bootstrap_has_no_cap(spark, rate):
    n = 400
    drawn = bootstrap_sample(spark.range(n), "id", rate, 3).groupBy("id").count().agg(
        F.sum("count"), F.countDistinct("count")
    ).first()
    assert abs(drawn[0] / n - rate) < 5 * (rate / n) ** 0.5
    assert drawn[1] > 1


def test_null_class_is_sampled(spark):
    rows = spark.range(100).select("id", F.when(F.col("id") < 50, F.lit(True)).alias("flag"))
    found = Counter(r.flag for r in stratified_sample(rows, ["flag"], "id", 10, 1).collect())
    assert found == {True: 5, None: 5}


def test_only_health_checks_go(spark):
    lines = ["GET /health", "GET /health?x=1", "GET /ready/", "GET /health-records/12", "GET /healthy"]
    frame = spark.createDataFrame([(x,) for x in lines], "message string")
    assert [r.message for r in without_health_checks(frame).collect()] == lines[3:]


def test_fraction_of_a_second_is_published(spark, events):
    rows = events([{"event_timestamp": utc("2025-02-01T10:00:00.250000")}, {}])
    text = [r.value for r in as_messages(rows, c.LOGISTICS_EVENTS).collect()]
    assert '"event_timestamp":"2025-02-01T10:00:00.25Z"' in text[0]
    assert '"event_timestamp":"2025-02-01T10:00:00Z"' in text[1]


def test_nan_is_missing_where_null_is(spark):
    name = next(f.name for f in c.HRSS_TELEMETRY.fields if not f.nullable and f.name == "reading_timestamp")
    message = spark.createDataFrame([(f'{{"{name}":"NaN"}}',)], "value string")
    reasons = validate(parse_messages(message, c.HRSS_TELEMETRY), c.HRSS_TELEMETRY).first().reasons
    assert f"missing:{name}" in reasons
