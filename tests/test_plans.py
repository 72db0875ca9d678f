"""What the physical plans must look like."""

import pytest

from tallybrook.operators import enrich, versioned, windows
from tallybrook.plans.hot_keys import find_hot_keys
from tallybrook.sources import testdata as td
from tallybrook.suite.queries import all_queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_what_the_totals_need(spark, sf_dir):
    text = plan(all_queries()["orders_per_window"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(user_id), IsNotNull(ts)]" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in text


def test_orders_are_summed_before_shuffle_and_join(spark, sf_dir):
    text = plan(all_queries()["orders_per_window"](spark, sf_dir))
    join, partial = text.index("Join"), text.index("partial_sum(amount_cents")
    # the plan is printed from the result down to the scans
    assert join < text.index("Exchange hashpartitioning(key") < partial


@pytest.mark.parametrize(
    "name", [n for n in sorted(all_queries()) if not n.startswith("stream_")]
)
def test_no_python_and_no_product_in_batch_plans(spark, sf_dir, name):
    text = plan(all_queries()[name](spark, sf_dir))
    for operator in ("PythonUDF", "ArrowEval", "BatchEvalPython", "MapInPandas", "CartesianProduct"):
        assert operator not in text
    # these two end in (or compare with) one global count or maximum
    if name not in ("validation_summary", "window_retention"):
        assert "Exchange SinglePartition" not in text


def test_strict_rule_is_partitioned_by_block(spark, sf_dir):
    text = plan(windows.drop_late(td.orders(spark, sf_dir)))
    assert "hashpartitioning(partition#" in text and "_block#" in text
    # full rows are shuffled once; the other exchanges carry one row per block
    assert text.count("Exchange hashpartitioning") == 3


def test_hot_keys_cut_the_join_into_cells(spark, sf_dir):
    orders, history = td.orders(spark, sf_dir), td.profile_history(spark, sf_dir)
    assert "_slice" not in plan(versioned.enrich_asof(orders, history))
    assert "_slice" in plan(versioned.enrich_asof(orders, history, hot_rows=50))


def test_hot_orders_are_not_shuffled_for_the_join(spark, sf_dir):
    orders = td.orders(spark, sf_dir)
    hot = find_hot_keys(orders, ["key"], 60)
    assert 0 < hot.count() < orders.select("key").distinct().count()
    current = enrich.current_tiers(td.profile_history(spark, sf_dir))
    text = plan(enrich.enrich_current(orders, current, hot=hot))
    assert "Union" in text and "BroadcastHashJoin" in text
