"""Queries over lasting tables: changes of touched partitions, kept months, and a run that fails."""

from __future__ import annotations

import copy
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.params import RunParams
from ledgerline.plans import upserts
from ledgerline.plans.history import History
from ledgerline.plans.pipeline import run_pipeline, table_counts
from ledgerline.plans.stages import Stages, stages_for
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources.lasting import LastingTables
from ledgerline.sources.testdata import MONTH_COLUMNS, ORDER_MONTH, PROCESSED_MONTH, CatalogModel, RetailModel, by_month, load_tables


def scratch_tables(m: RetailModel) -> LastingTables:
    return LastingTables(m.spark, f"{ensure_checkpoint_dir(m.spark)}/ledgerline-lasting/{uuid.uuid4().hex}")


def maintained(st: Stages) -> LastingTables:
    """Orders, lines and queue loaded by month, then repaired (U4) and purged (D1) where rows are hit, once per run."""
    def build() -> LastingTables:
        tables = scratch_tables(st.m)
        change = tables.begin()
        load_tables(st.m, change, st.shipped_orders)
        change.commit()
        change = tables.begin()
        fixes = st._keep(st.order_date_fixes(orders=change.read("Orders")))
        change.update("Orders", fixes, ["OrderId"], ["RequiredDate", "ShippedDate"], unique=True)
        gone = upserts.purged_entries(st, queue=change.read("OrderProcessingQueue"))
        change.delete("OrderProcessingQueue", st._keep(gone.select("QueueId", PROCESSED_MONTH)), ["QueueId"])
        change.commit()
        return tables
    return st._shared(f"maintained {st.p}", build)


def orders_repaired_in_place(st: Stages) -> DataFrame:
    """U4 on lasting tables: Orders after the repair, of which only months with a repaired order were written anew."""
    return maintained(st).read("Orders").drop(ORDER_MONTH)


def queue_purged_in_place(st: Stages) -> DataFrame:
    """D1 on lasting tables: the queue after the purge, of which only months with a purged entry were written anew."""
    return maintained(st).read("OrderProcessingQueue").drop(PROCESSED_MONTH)


def sales_history(m: RetailModel, params: RunParams) -> DataFrame:
    """All orders per customer from kept months: all but the run's month are kept first, then that month is added."""
    tables, month = scratch_tables(m), params.previous_month.year * 100 + params.previous_month.month
    new = {a: F.coalesce(F.col(MONTH_COLUMNS[a]) == month, F.lit(False)) for a in ("orders", "order_details")}
    frames = by_month(m)
    first = tables.begin()
    for attr, is_new in new.items():
        first.create(CatalogModel.TABLES[attr], frames[attr].filter(~is_new), [MONTH_COLUMNS[attr]])
    History(first).refresh()
    first.commit()
    second = tables.begin()
    for attr, is_new in new.items():
        second.append(CatalogModel.TABLES[attr], frames[attr].filter(is_new))
    History(second).refresh()  # reads the lines of the new month only
    second.commit()
    return History(tables.begin()).customers().select(
        "CustomerId", F.col("orders").alias("Orders"), F.col("line_count").alias("Lines"),
        F.col("gross_sum").alias("GrossSales"), F.col("net_sum").alias("NetSales"))


class _BrokenOff(RuntimeError):
    pass


def failed_run(m: RetailModel, params: RunParams) -> DataFrame:
    """The lasting tables and their rows after a run that fails in its last stage: those before it, and its logs."""
    tables = scratch_tables(m)
    change, st = tables.begin(), stages_for(m, params)
    load_tables(m, change, st.shipped_orders)
    change.commit()
    broken = copy.copy(st)

    def fails() -> DataFrame:
        raise _BrokenOff("stage 14")

    broken.process_statistics = fails
    try:
        run_pipeline(m, params, out_dir=tables.root, stages=broken)
    except _BrokenOff:
        pass
    return table_counts(tables, dict.fromkeys(tables.record().tables))
