"""Registered queries against their SQL. LOOMVAULT_ALL=1 runs every one of them."""
import os
import sys
from collections import Counter

import duckdb
import pytest
from conftest import ROOT, SMALL

import __spark_entry__ as entry

sys.path.insert(0, str(ROOT / "tools"))
from check import TABLES, plain  # noqa: E402

CORE = [
    "agg_monthly_revenue", "agg_customer_ltv", "bv_order_lifecycle", "conformed_customers", "pit_customer", "pit_order", "bridge_customer_order",
    "load_satellite", "load_eff_satellite", "fct_order_items", "dim_product", "dp_product_performance", "feature_store_customer", "agg_revenue_by_segment",
    "snapshot_scd2", "sv_product_performance", "secure_customer_profiles", "asof_join", "win_ntile", "win_percent_rank", "agg_conditional_distinct",
    "change_feed", "cdc_apply", "cdc_route", "stream_cdc_apply", "ranks_after_change", "error_trend_hourly", "classify_columns", "dq_vault_ri", "dq_inline", "ingestion_freshness", "budget_status",
    "data_product_catalog", "seed_enrich", "fn_string", "fn_datediff", "fn_json_array", "product_search_topk",
]
NAMES = sorted(entry.queries()) if os.environ.get("LOOMVAULT_ALL") else CORE


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sql, name):
    df = entry.queries()[name](spark, SMALL)
    ours = [tuple(r) for r in df.collect()]
    if name not in entry.oracle_sql():  # rows only: see the tests of the operator
        assert ours
        return
    theirs = sql.sql(entry.oracle_sql()[name])
    order = sorted(df.columns)
    assert order == sorted(theirs.columns)

    def counted(data, columns):
        at = [columns.index(c) for c in order]
        return Counter(tuple(plain(r[i]) for i in at) for r in data)

    assert counted(ours, df.columns) == counted(theirs.fetchall(), theirs.columns)
    assert ours


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
