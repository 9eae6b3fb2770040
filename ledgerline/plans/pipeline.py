"""Q40: the whole procedure, stages 1-14 in order, with its sinks.

What lasts is under ``out_dir`` as lasting tables (``sources.lasting``): Orders and
OrderProcessingQueue (kept by month), CustomerOrderSummary, the report tables
(insert-if-absent for the run date), ProcessExecutionLog, ProcessStatistics,
RunSummary, and ErrorLog on failure.  A run's changes count all together, once its
last stage is done; a run that fails leaves nothing but its ErrorLog and
RunSummary rows.  The run's own tables, TempMergeResults, TempValidationResults,
TempAggregatedData, TempProcessingData (and the three debug result sets when
``debug``), are plain folders under ``runs/<run id>``.

The staging table versions are stored as they are produced, so a lost
executor costs at most the current stage, and the next stage starts from a
short lineage.  Returns the one-row run summary.
"""

from __future__ import annotations

import hashlib
import traceback
import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.exprs import lit_ts, month_number
from ledgerline.operators.dml import merge
from ledgerline.params import RunParams
from ledgerline.plans import labels as L
from ledgerline.plans import upserts
from ledgerline.plans.history import History
from ledgerline.plans.stages import Run, Stages, stages_for
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources.lasting import Change, ConcurrentRunError, LastingTables
from ledgerline.sources.testdata import ORDER_MONTH, PROCESSED_MONTH, LastingModel, RetailModel

SUMMARY_SCHEMA = ("ProcessId string, StartTime timestamp_ntz, EndTime timestamp_ntz, DurationSeconds long, "
                  "RecordsProcessed long, Status string, ErrorMessage string")
ERROR_SCHEMA = ("ProcessId string, ErrorNumber string, ErrorProcedure string, ErrorLine int, ErrorMessage string, "
                "CreatedDate timestamp_ntz")
MONTHS = ["ProcessYear", "ProcessMonth"]
#: Tables that a failed run writes to; they don't stand in the way of going on with a run.
LOGS = ["ErrorLog", "RunSummary"]

#: Report tables: key columns and the column of the run date.
REPORTS = {
    "SalesPerformanceReport": (["ReportDate", "DepartmentId", "EmployeeId", "CustomerId"], "ReportDate"),
    "CustomerSegmentAnalysis": (["AnalysisDate", "CustomerId"], "AnalysisDate"),
    "DepartmentPerformanceReport": (["ReportDate", "DepartmentId"], "ReportDate"),
}


def _append_report(change: Change, name: str, rows: DataFrame, day: datetime) -> None:
    """Append report rows whose key is not yet stored for the run's day (idempotent re-runs).

    Report tables are partitioned by ``ReportDay`` (the date of the run), so
    the NOT EXISTS check reads one partition, not the table's history.
    """
    keys, day_col = REPORTS[name]
    rows, stored = rows.withColumn("ReportDay", F.to_date(F.col(day_col))), change.read(name)
    if stored is not None:
        stored = stored.filter(F.col("ReportDay") == F.lit(day.date())).select(*keys).distinct()
        rows = rows.join(stored, keys, "left_anti")
    change.append(name, rows, ["ReportDay"])


def _log(tables: LastingTables, rows: dict[str, DataFrame]) -> None:
    """Append rows to log tables, by a record of their own; another run may have come in between."""
    while True:
        change = tables.begin()
        for name, df in rows.items():
            change.append(name, df)
        try:
            change.commit()
            return
        except ConcurrentRunError:
            continue


def run_pipeline(m: RetailModel, params: RunParams, out_dir: str | None = None, debug: bool = False,
                 stages: Stages | None = None) -> DataFrame:
    """Run stages 1-14 and return the run summary row.

    ``out_dir`` holds what lasts between runs; Orders, OrderDetails and the queue
    are read from there once they are (``load_tables``, or an earlier run).
    Without it everything goes to a scratch folder.  A run of an id and
    parameters that were killed goes on behind the last finished sink; one that
    was finished returns its summary and changes nothing.  ``stages`` may be
    given where they have been begun already.

    On failure the ErrorLog and RunSummary rows are appended and the error is
    raised again, with the summary row as its ``run_summary``.
    """
    spark = m.spark
    lasting = out_dir or f"{ensure_checkpoint_dir(spark)}/ledgerline-runs/{params.run_id}-{uuid.uuid4().hex[:8]}"
    tables = LastingTables(spark, lasting)
    parameters = {"date": params.current_ts.isoformat(), "department": params.department_id,
                  "employee": params.employee_id, "user": params.run_user,
                  "data": hashlib.sha256(str(m.identity()).encode()).hexdigest()}
    change = tables.begin(params.run_id, parameters, LOGS)
    if change.committed is not None:
        stored = tables.read("RunSummary", change.committed).filter(
            (F.col("ProcessId") == params.run_id) & (F.col("Status") == L.SUCCESS))
        return stored
    own = Run() if "Orders" in change.base.tables and stages is None else None  # other data: nothing stored so far counts
    if own is not None:
        m = LastingModel(m, tables, change.base)
        m.run = own
    if own is not None and "OrderDetails" in change.now:
        m.history = History(change)
    records = None

    def summary_row(status: str, message: str | None) -> DataFrame:
        ended = datetime.now().replace(microsecond=0)
        seconds = int((ended - change.started).total_seconds())
        return spark.createDataFrame([(params.run_id, change.started, ended, seconds, records, status, message)], SUMMARY_SCHEMA)

    try:
        if m.history is not None:
            change.step("History", m.history.refresh)
        st = stages if stages is not None else stages_for(m, params)
        temp = f"{lasting}/runs/{params.run_id}"
        records = _stages(change, st, params, temp, debug)
        change.step("RunSummary", lambda: change.append("RunSummary", summary_row(L.SUCCESS, None)))
        done = change.commit()
        return tables.read("RunSummary", done).filter((F.col("ProcessId") == params.run_id) & (F.col("Status") == L.SUCCESS))
    except Exception as exc:
        frames = traceback.extract_tb(exc.__traceback__)
        error = spark.createDataFrame(
            [(params.run_id, type(exc).__name__, frames[-1].name, frames[-1].lineno, str(exc), datetime.now())], ERROR_SCHEMA)
        exc.run_summary = summary_row(L.FAILED, str(exc))
        _log(tables, {"ErrorLog": error, "RunSummary": exc.run_summary})
        raise
    finally:
        if own is not None:
            own.end()


def _stages(change: Change, st: Stages, params: RunParams, temp: str, debug: bool) -> int:
    """Stages 1-14 as steps of ``change``; returns how many staging rows there are."""

    def plain(name: str, rows) -> None:
        """A table of the run's own."""
        change.step(name.replace("/", "-"), lambda: rows().write.mode("overwrite").parquet(f"{temp}/{name}"))

    def first() -> dict:
        # 1 staging rows; @RowCount comes from an Observation filled while tpd1 is stored
        _ = st.recent_lines  # the reports read all of them, so the staging takes its own from them
        tpd1 = st.tpd1
        observed = st.stage1_rows.get if st.run else {}
        return {"rows": int(observed["rows"]) if "rows" in observed else tpd1.count()}

    def summary() -> None:
        # 3 summary merge + change feed (2, re-price and value status, is tpd2)
        if "CustomerOrderSummary" in change.now:
            month = {"ProcessYear": params.process_year, "ProcessMonth": params.process_month}
            scoped, feed = merge(change.read("CustomerOrderSummary"), st.merge_source(st.tpd2),
                                 upserts.summary_merge_spec(st), check_duplicates=False, scope_only=True, store=st._keep)
            change.replace_parts("CustomerOrderSummary", scoped, [month])
        else:
            after, feed = upserts.customer_order_summary_merge(st, tpd=st.tpd2)
            change.create("CustomerOrderSummary", after, MONTHS)
        feed.write.mode("overwrite").parquet(f"{temp}/TempMergeResults")

    def purge() -> None:
        # 4 queue purge: needs IsProcessed = 1, which stage 8 sets later (so nothing goes in one run)
        if "OrderProcessingQueue" in change.now:
            gone = upserts.purged_entries(st, queue=change.read("OrderProcessingQueue"), tpd=st.tpd2)
            change.delete("OrderProcessingQueue", st._keep(gone.select("QueueId", PROCESSED_MONTH)), ["QueueId"])
        else:
            queue = upserts.purge_processed_queue(st, tpd=st.tpd2)
            change.create("OrderProcessingQueue", queue.withColumn(PROCESSED_MONTH, month_number(F.col("ProcessedDate"))),
                          [PROCESSED_MONTH])

    def repair() -> None:
        # 13 order date repair: the months with a repaired order are written anew
        if "Orders" in change.now:
            fixes = st._keep(st.order_date_fixes(st.tpd4))
            change.update("Orders", fixes, ["OrderId"], ["RequiredDate", "ShippedDate"], unique=True)
        else:
            orders = st.repair_order_dates(st.tpd4)
            change.create("Orders", orders.withColumn(ORDER_MONTH, month_number(F.col("OrderDate"))), [ORDER_MONTH])

    def log() -> None:
        # 9 execution log
        row = st.execution_log().withColumn("StartTime", lit_ts(change.started)).withColumn("EndTime", F.localtimestamp())
        change.append("ProcessExecutionLog", row)

    def statistics() -> None:
        # 14 statistics
        elapsed = int((datetime.now() - change.started).total_seconds())
        change.append("ProcessStatistics", st.process_statistics().withColumn(
            "ProcessingTimeSeconds", F.lit(elapsed).cast("long")))

    def report(name: str, rows) -> None:
        change.step(name, lambda: _append_report(change, name, rows(), params.current_ts))

    records = change.step("Stage1", first)["rows"]
    change.step("CustomerOrderSummary", summary)
    change.step("OrderProcessingQueue", purge)
    report("SalesPerformanceReport", st.sales_performance_report)  # 5
    plain("TempAggregatedData", st.aggregated_department_employee)  # 6
    plain("TempValidationResults", st.validation_results)  # 7; 8, the final status, is tpd3
    change.step("ProcessExecutionLog", log)
    if debug:  # 10
        plain("debug/ProcessingSummary", st.processing_summary)
        plain("debug/DepartmentSummary", st.department_summary)
        plain("debug/ValidationResults", st.validation_summary)
    report("CustomerSegmentAnalysis", st.customer_segment_analysis)  # 11
    report("DepartmentPerformanceReport", st.department_performance_report)  # 12
    change.step("Orders", repair)
    plain("TempProcessingData", lambda: st.tpd4)  # as the procedure leaves it
    change.step("ProcessStatistics", statistics)
    return records


#: Tables of a run: those that last (``None``) and the run's own, by their folder.
RUN_TABLES = {
    "CustomerOrderSummary": None, "SalesPerformanceReport": None, "CustomerSegmentAnalysis": None,
    "DepartmentPerformanceReport": None, "ProcessExecutionLog": None, "ProcessStatistics": None, "Orders": None,
    "OrderProcessingQueue": None, "TempMergeResults": "runs/*/", "TempAggregatedData": "runs/*/",
    "TempValidationResults": "runs/*/", "TempProcessingData": "runs/*/",
}


def table_counts(tables: LastingTables, names: dict[str, str | None]) -> DataFrame:
    """(TableName, TableRows) of lasting tables and of run folders."""
    spark, rows = tables.spark, None
    for name, folder in names.items():
        df = tables.read(name) if folder is None else spark.read.parquet(f"{tables.root}/{folder}{name}")
        n = df.groupBy().agg(F.lit(name).alias("TableName"), F.count(F.lit(1)).alias("TableRows"))
        rows = n if rows is None else rows.unionByName(n)
    return rows


def run_pipeline_counts(m: RetailModel, params: RunParams) -> DataFrame:
    """Q40 as a query: the run's status and record count, with the rows of every table it wrote."""
    spark = m.spark
    out = f"{ensure_checkpoint_dir(spark)}/ledgerline-runs/{params.run_id}-{uuid.uuid4().hex[:8]}"
    one = run_pipeline(m, params, out_dir=out).first()  # the summary is one row
    return table_counts(LastingTables(spark, out), RUN_TABLES).select(
        "TableName", "TableRows", F.lit(one.Status).alias("Status"),
        F.lit(one.RecordsProcessed).cast("long").alias("RecordsProcessed"))
