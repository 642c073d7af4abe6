import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tenderline.plans.queries import QUERIES
from tests.compare import connect, of_duckdb, of_spark, type_differences

FOLDER = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)
HOT = [
    "attribute_pivot", "compare_ge_all", "demand_summary", "join_left_range",
    "negotiation_history", "negotiation_history_dedup", "negotiation_history_expanded",
    "negotiation_runs", "user_dimension",
    "window_lead_status", "window_row_number_label",
]


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


def agrees(spark, database, name):
    frame = queries()[name](spark, FOLDER)
    columns, rows = of_spark(frame)
    wanted_columns, wanted_rows = of_duckdb(database, oracle_sql()[name])
    assert columns == wanted_columns
    assert rows == wanted_rows
    assert rows
    assert type_differences(frame, database, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", NAMES)
def test_agrees_with_sql(spark, database, name):
    agrees(spark, database, name)


@pytest.mark.parametrize("name", HOT)
def test_agrees_with_sql_when_keys_are_hot(spark, database, low_limit, name):
    agrees(spark, database, name)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    frame = entry(spark)
    assert "unit_price" in frame.columns
    assert frame.count() > 0
