"""Plans a large cluster would run: broadcasts off, adaptive choices not counted on."""
import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from loomvault.functions.dates import at
from loomvault.operators import governance
from loomvault.plans import semantic
from loomvault.registry import QUERIES


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    """Shuffles of the plan that ran; dealing a small test table out to all cores is not counted, nor what shows only that no key is cut."""
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    return len(re.findall(r"Exchange hashpartitioning[^\n]*ENSURE_REQUIREMENTS", final)) - len(re.findall(r"Exchange hashpartitioning\(_cut_key", final))


def test_exchange_counts(warehouse):
    assert exchanges(warehouse.hub_order) == 1
    assert exchanges(warehouse.sat_order_details) == 1
    # a satellite once by (key, segment), once by key for its newest rows
    assert exchanges(warehouse.bv_order_lifecycle) <= 5
    assert exchanges(warehouse.conformed_orders) <= 7         # and the link, first by its own key
    assert exchanges(warehouse.pit_order) <= 5


@pytest.mark.parametrize("name", [
    "bv_customer_classification", "agg_customer_ltv", "agg_monthly_revenue", "sv_product_performance", "dp_customer_360", "pit_customer", "asof_join",
    "win_ntile", "win_percent_rank", "fct_order_items", "product_search_topk",
])
def test_no_cross_join_python_or_single_task_window(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"Python|Pandas|ArrowEval", text)
    assert not re.search(r"Window [^\n]*\n[^\n]*Sort [^\n]*\n[^\n]*Exchange SinglePartition", text)


def test_filters_and_columns_reach_the_scan(spark, warehouse):
    text = plan(QUERIES["read_parquet"](spark, SMALL))
    assert "GreaterThan(l_quantity,45.0)" in text and "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in text
    text = plan(QUERIES["incremental_lookback"](spark, SMALL))
    assert "GreaterThanOrEqual(ts,2024-01-28" in text
    hub = plan(warehouse.hub_order)
    assert "o_totalprice" not in hub and "o_orderpriority" not in hub


def test_row_policy_and_metric_filter_sink_below_the_aggregate(spark, folder):
    spark.createDataFrame([("US", "A", 1), ("DE", "B", 2)], "COUNTRY_CODE string, SEG string, N int").write.parquet(f"{folder}/t")
    base = governance.row_access_country(spark.read.parquet(f"{folder}/t"), "ANALYST", ["US"])
    view = semantic.SemanticView(base, {"n": semantic.Metric("SUM", F.col("N"), "n")}, {"seg": F.col("SEG")})
    text = plan(semantic.semantic_query(view, ["n"], ["seg"], filters=F.col("SEG") == "A"))
    assert "EqualTo(SEG,A)" in text and "COUNTRY_CODE" in text.split("PushedFilters")[1]
    with pytest.raises(KeyError):
        semantic.semantic_query(view, ["unknown"])


def test_high_water_mark_is_a_literal(spark, folder):
    from loomvault.plans.vault import newer_than
    spark.range(5).select(at("2024-01-01 00:00:00").alias("LOAD_DATETIME"), "id").write.parquet(f"{folder}/t")
    stored = spark.read.parquet(f"{folder}/t")
    text = plan(newer_than(stored, stored))
    assert "GreaterThan(LOAD_DATETIME,2024-01-01" in text
