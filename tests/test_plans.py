"""What the physical plans must and must not contain."""

import pytest

from __spark_entry__ import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def plan(spark):
    """The plan with static broadcasts off, as for tables of unknown size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def text(name):
        frame = queries()[name](spark, FOLDER)
        return frame._jdf.queryExecution().executedPlan().toString()

    yield text
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(
    "name",
    ["attribute_pivot", "demand_summary", "negotiation_history", "user_dimension",
     "join_left_range", "join_cross_singleton", "compare_ge_all"],
)
def test_no_pairing_of_all_rows(plan, name):
    text = plan(name)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_in_the_plan(spark, name):
    text = queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text


def test_row_local_queries_do_not_shuffle(plan):
    for name in ("contract_info", "benchmark_history", "json_array_explode", "json_array_latest",
                 "filter_threshold", "filter_as_of", "scalar_epoch", "typed_null_column"):
        assert "Exchange" not in plan(name), name


def test_number_of_shuffles(plan):
    assert plan("window_row_number_label").count("Exchange hashpartitioning") == 1
    assert plan("window_lead_status").count("Exchange hashpartitioning") == 1
    # Values once, products once, and the small header table to drop its copies;
    # fields and headers are measured and broadcast.
    text = plan("attribute_pivot")
    assert text.count("Exchange hashpartitioning") == 3
    assert text.count("Exchange hashpartitioning(pb_product_id") == 1
    assert text.count("Exchange hashpartitioning(product_id") == 1


def test_numbering_and_counting_share_a_sort(plan):
    text = plan("join_left_range")
    assert text.count("Window [") == 1
    text = plan("negotiation_history")
    assert text.count("Window [") == 2
    below = text[text.index("Window [") : text.rindex("Window [")]
    assert "Sort [" not in below


def test_filters_and_columns_reach_the_scan(plan):
    text = plan("filter_threshold")
    assert "GreaterThan(value,100.0)" in text
    text = plan("agg_count")
    assert "ReadSchema: struct<l_linestatus:string>" in text
    text = plan("scan_query")
    assert "EqualTo(o_orderstatus,F)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in text
