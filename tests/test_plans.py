"""Plans: what reaches the scan, and what must not appear in any plan."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feira.operators import search, sorting
from feira.queries import queries
from feira.sources import tables
from tests.conftest import SMALL

# Running these queries writes files, so only their results are checked, elsewhere.
WRITERS = ("d1_refreshed", "d3_refreshed", "c12_", "a1_", "a6_", "a9_", "a11_", "a12_", "b19_orders_in", "i1_stream", "d12_stream", "i3_stream", "i5_", "i6_stream",
           "i8_", "i9_", "i10_")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in queries() if not n.startswith(WRITERS)))
def test_no_python_rows_and_no_cross_products(spark, name):
    text = plan(queries()[name](spark, SMALL))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_time_range_prunes_partitions(spark, market, tmp_path):
    path = str(tmp_path / "orders")
    tables.write_orders(market.order, path, market.now)
    found = tables.scan_orders(spark, path, datetime(2001, 3, 1), datetime(2001, 4, 1))
    assert {f.split("order_bucket=")[1].split("/")[0] for f in found.inputFiles()} == {"order_2001_03"}
    wanted = market.order.where("order_purchase_timestamp >= '2001-03-01' AND order_purchase_timestamp < '2001-04-01'")
    assert found.count() == wanted.count() > 0


def test_filters_and_columns_reach_the_scan(market):
    text = plan(search.open_orders(market.order, market.now))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in text
    text = plan(market.session_event.where(F.col("ts") >= "2024-01-20").select("event_id"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in text and "props" not in text.split("ReadSchema")[1]


def test_item_numbers_cost_nothing_where_unused(market):
    from feira.queries.sales import monthly_sales

    lines = plan(monthly_sales(market)).split("\n")
    assert not any("row_number()" in line and "l_linenumber" in line for line in lines)


def test_group_heads_are_cut_before_the_shuffle(market):
    ranked = sorting.top_k_per_group(market.order_item, ["seller_id"], [F.desc("price"), F.asc("order_id")], 3)
    text = plan(ranked)
    assert text.index("Final") < text.index("Partial") and "WindowGroupLimit" in text


def test_no_collect_on_a_hot_key(market):
    """Newest row per key is an aggregate with a map side, not a window."""
    from feira.operators.sets import latest_per_key

    text = plan(latest_per_key(market.order, ["customer_unique_id"], ["order_purchase_timestamp"]))
    assert "partial_max_by" in text and "Window" not in text


def test_slots_and_slices_are_spread_over_tasks(market):
    """A key split into slots or time slices must not stay partitioned by the key alone."""
    from feira.operators.timelines import status_transitions, with_previous
    from feira.streaming.buckets import bucket_events

    lines = plan(bucket_events(market.session_event, 5)).split("\n")
    assert any("Exchange hashpartitioning(session_id" in x and "slot#" in x for x in lines)
    keyed = market.order_history.repartition("order_id")
    sliced = with_previous(keyed, ["order_id"], ["changed_at"], ["order_status"], F.col("changed_at").cast("date"))
    assert any("Exchange hashpartitioning(order_id" in x and "_slice#" in x for x in plan(sliced).split("\n"))
    assert plan(status_transitions(market.order_history)).count("Exchange") == 1


def test_settings_reach_a_foreign_session(spark, market):
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"


def test_seller_performance_reads_the_items_once(market):
    from feira.plans.catalog import seller_performance

    parts = market.order, market.order_item, market.review_doc
    assert plan(seller_performance(*parts)).count("FileScan") <= sum(plan(p).count("FileScan") for p in parts)
