"""Publishing the retail tables bucketed by OrderId removes the shuffle from order-line joins."""

import os

import pytest

from ledgerline.plans import metrics
from ledgerline.sources.testdata import CatalogModel, RetailModel, publish_tables

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_bucketed_orders_and_lines_join_without_exchange(spark):
    publish_tables(RetailModel(spark, SF), "retail_t", buckets=4)
    cat = CatalogModel(spark, "retail_t")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = cat.orders.join(cat.order_details, "OrderId")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        # and the queries run unchanged on the catalog tables
        a = sorted(map(tuple, metrics.customer_analysis(cat).collect()))
        b = sorted(map(tuple, metrics.customer_analysis(RetailModel(spark, SF)).collect()))
        assert a == b
        from ledgerline.plans.stages import Stages
        r1 = sorted(map(repr, Stages(cat).repair_order_dates().collect()))
        r2 = sorted(map(repr, Stages(RetailModel(spark, SF)).repair_order_dates().collect()))
        assert r1 == r2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
