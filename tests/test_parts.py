"""Queries whose stock and forecast come from the event's part, over rows made here."""

import json
from datetime import datetime

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from millwright.plans.check_sql import oracle
from millwright.plans.queries import registry
from tests.compare import connect, differences

#: Part 1 is known, part 2 isn't; one event of each in the window's and in the quarter's time.
DAYS = (datetime(2001, 3, 5), datetime(1998, 5, 6))
QUERIES = [
    "logistics_features_quarterly",
    "project_logistics",
    "typed_events",
    "window_filter",
    "quarter_filter",
    "clip_values",
    "to_json_rows",
]


@pytest.fixture(scope="module")
def sf_dir(tmp_path_factory):
    path = tmp_path_factory.mktemp("parts")
    pq.write_table(pa.table({
        "l_orderkey": pa.array([1, 2, 3, 4], pa.int64()), "l_partkey": pa.array([1, 2, 1, 2], pa.int64()),
        "l_suppkey": pa.array([5, 6, 5, 6], pa.int64()), "l_linenumber": pa.array([1, 1, 1, 1], pa.int32()),
        "l_quantity": [3.0] * 4, "l_extendedprice": [100.5] * 4, "l_discount": [0.05] * 4, "l_tax": [0.02] * 4,
        "l_returnflag": ["N", "R", "N", "R"], "l_linestatus": ["O", "F", "O", "F"],
        "l_shipdate": pa.array([DAYS[0], DAYS[0], DAYS[1], DAYS[1]], pa.timestamp("us")),
    }), path / "lineitem.parquet")
    pq.write_table(pa.table({
        "p_partkey": pa.array([1], pa.int64()), "p_size": pa.array([30], pa.int32()), "p_retailprice": [1234.56],
    }), path / "part.parquet")
    return str(path)


def _stock_and_forecast(row: dict) -> tuple:
    if "value" in row:
        row = json.loads(row["value"])
    stock = row.get("inventory_level", row.get("avg_inventory_level"))
    forecast = row.get("demand_forecast")
    return None if stock is None else int(stock), forecast


@pytest.mark.parametrize("name", QUERIES)
def test_stock_and_forecast_are_the_parts(spark, sf_dir, name):
    rows = registry()[name](spark, sf_dir)
    whole = {"demand_forecast", "value"} & set(rows.columns)
    found = {_stock_and_forecast(r.asDict()) for r in rows.collect()}
    assert found == {(300, 1234 if whole else None), (None, None)}
    assert rows.count() == (2 if name in ("window_filter", "quarter_filter") else 4)
    assert differences(rows, connect(sf_dir), oracle()[name]) == []


@pytest.mark.parametrize("name", QUERIES)
def test_check_reads_the_parts(sf_dir, name):
    engine = connect(sf_dir)
    engine.execute("drop view part")
    with pytest.raises(duckdb.CatalogException):
        engine.sql(oracle()[name])
