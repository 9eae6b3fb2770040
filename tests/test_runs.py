"""Stored tables of a run: one answer per data set, nothing stale, nothing left behind; state between pipeline runs."""

import os
from dataclasses import replace
from datetime import datetime, timedelta

import pytest

from ledgerline.params import DEFAULT_PARAMS
from ledgerline.plans.pipeline import run_pipeline
from ledgerline.plans.registry import QUERIES
from ledgerline.plans.stages import Run, Stages, stages_for
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources.lasting import LastingTables
from ledgerline.sources.testdata import CatalogModel, RetailModel, publish_tables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


def low_stock(model):
    return QUERIES["low_stock_orders"](model, DEFAULT_PARAMS).count()


def test_two_databases_have_their_own_answers(spark):
    publish_tables(RetailModel(spark, SF), "runs_a", buckets=2)
    publish_tables(RetailModel(spark, SF), "runs_b", buckets=2)
    spark.table("runs_a.Orders").filter("OrderId % 2 = 0").write.mode("overwrite").saveAsTable("runs_b.Orders2")
    spark.sql("DROP TABLE runs_b.Orders")
    spark.sql("ALTER TABLE runs_b.Orders2 RENAME TO runs_b.Orders")
    run = Run()
    a, b = CatalogModel(spark, "runs_a"), CatalogModel(spark, "runs_b")
    a.run = b.run = run
    assert stages_for(a) is not stages_for(b) and stages_for(a) is stages_for(a)
    assert low_stock(a) > low_stock(b) > 0
    run.end()


def test_added_data_is_seen_and_end_removes_everything(spark, scratch):
    folder = os.path.join(scratch, "grown")
    for t in "region nation customer supplier part lineitem".split():
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    orders.filter("o_orderkey % 4 = 0").write.parquet(f"{folder}/orders.parquet")
    run = Run()
    count = lambda: stages_for(RetailModel(spark, folder, run)).recent_lines.count()
    before = count()
    stored = set(run._folders)
    assert stored and count() == before and set(run._folders) == stored  # read, not built again
    orders.filter("o_orderkey % 4 = 1").write.mode("append").parquet(f"{folder}/orders.parquet")
    assert count() > before
    paths = [p.removeprefix("file:") for p in run._folders]
    assert all(map(os.path.exists, paths))
    run.end()
    assert not any(map(os.path.exists, paths))


def test_models_of_frames_share_nothing(spark):
    run, a, b = Run(), RetailModel(spark, SF), RetailModel(spark, SF)
    a.run = b.run = run
    assert stages_for(a) is stages_for(b)  # the same data
    assert isinstance(stages_for(a, replace(DEFAULT_PARAMS, department_id=101)), Stages)
    assert stages_for(a, replace(DEFAULT_PARAMS, department_id=101)) is not stages_for(a)


def test_two_pipeline_runs_into_one_place(spark, scratch):
    out = os.path.join(scratch, "lasting")
    first = run_pipeline(RetailModel(spark, SF), replace(DEFAULT_PARAMS, run_id="one"), out_dir=out).first()
    reports = ["SalesPerformanceReport", "CustomerSegmentAnalysis", "DepartmentPerformanceReport"]
    rows = lambda: [spark.read.parquet(f"{out}/{r}").count() for r in reports]
    stored = rows()
    assert all(stored)
    second = run_pipeline(RetailModel(spark, SF), replace(DEFAULT_PARAMS, run_id="two"), out_dir=out).first()
    assert rows() == stored  # insert-if-absent for the run date
    assert first.RecordsProcessed == second.RecordsProcessed
    tables = LastingTables(spark, out)
    # the second run found nothing left to repair or to purge: it wrote no folder of these
    assert len(os.listdir(f"{out}/Orders")) == len(os.listdir(f"{out}/OrderProcessingQueue")) == 1
    assert tables.read("ProcessExecutionLog").count() == tables.read("RunSummary").count() == tables.record().number == 2
    # the second run read the repaired orders of the first
    repaired = tables.read("Orders", tables.record(1)).drop("OrderMonth")
    assert repaired.exceptAll(RetailModel(spark, SF).orders_with_shipping.select(*repaired.columns)).count() > 0


def test_undated_orders_count(spark):
    """An order without a date belongs to the department metrics, as in the procedure."""
    from ledgerline.plans import metrics
    from pyspark.sql import functions as F
    m = RetailModel(spark, SF)
    m.__dict__["orders"] = m.orders.withColumn(
        "OrderDate", F.when(F.col("OrderId") % 10 != 0, F.col("OrderDate")))
    undated = m.orders.filter("OrderDate IS NULL").count()
    late = replace(DEFAULT_PARAMS, current_ts=datetime(2030, 1, 1) + timedelta(days=0))
    got = metrics.department_performance_metrics(m, late).agg(F.sum("OrderCount")).first()[0]
    assert undated > 0 and got == undated
    assert ensure_checkpoint_dir(spark)
