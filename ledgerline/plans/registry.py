"""Name -> query function registry used by ``__spark_entry__`` and ``bench.py``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from ledgerline.params import DEFAULT_PARAMS, RunParams
from ledgerline.plans import adhoc, inplace, metrics, pipeline, upserts
from ledgerline.plans.stages import TPD_COLUMNS, Run, Stages, stages_for
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources.testdata import RetailModel

QueryFn = Callable[[RetailModel, RunParams], DataFrame]


def _st(fn: Callable[[Stages], DataFrame]) -> QueryFn:
    def run(m: RetailModel, p: RunParams) -> DataFrame:
        return fn(stages_for(m, p))
    run.__name__ = getattr(fn, "__name__", "stage_query")
    run.__doc__ = fn.__doc__
    return run


# name -> query; the comment gives the SURVEY §2 ids it covers
QUERIES: dict[str, QueryFn] = {
    # Q1 R1
    "department_hierarchy": metrics.department_hierarchy,
    # Q2
    "employee_performance": metrics.employee_performance,
    # Q3
    "customer_analysis": metrics.customer_analysis,
    # Q4
    "product_sales_metrics": metrics.product_sales_metrics,
    # Q5
    "regional_sales_summary": metrics.regional_sales_summary,
    # Q6 T1
    "top_categories": metrics.top_categories,
    # Q7 P18
    "order_amount_in_top_categories": _st(lambda st: st.order_amount_in_top_categories()),
    # Q8 P25 P27
    "customer_tier": _st(lambda st: st.customer_tier()),
    # Q9 P19 J5
    "low_stock_orders": _st(lambda st: st.low_stock_orders()),
    # Q10 P20 J6
    "uncancelled_orders": _st(lambda st: st.uncancelled_orders()),
    # Q11 J1 S7
    "stage_processing_data": _st(lambda st: st.tpd1.select(*TPD_COLUMNS)),
    # P13
    "optional_filter": _st(lambda st: stages_for(st.m, replace(st.p, department_id=103)).tpd1.select(*TPD_COLUMNS)),
    # Q12 P7 U1
    "reprice_with_discounts": _st(lambda st: st.tpd2.select(*TPD_COLUMNS[:5], "Amount")),
    # Q13 P26 A10
    "customer_value_status": _st(lambda st: st.tpd2.select(*TPD_COLUMNS[:5], "Status")),
    # Q14 M1-M5
    "customer_order_summary_merge": _st(lambda st: upserts.customer_order_summary_merge(st)[0]),
    # M6 S11
    "merge_changes": _st(lambda st: upserts.customer_order_summary_merge(st)[1]),
    # Q15 D1
    "purge_processed_queue": _st(lambda st: upserts.purge_processed_queue(st)),
    # Q16 S12 A6
    "sales_performance_report": _st(lambda st: st.sales_performance_report(st.m.stored_sales_report(st.p))),
    # Q17 A13 J14
    "aggregated_department_employee": _st(lambda st: st.aggregated_department_employee()),
    # Q18
    "validate_amount": _st(lambda st: st.validate_amount()),
    # Q19 P21
    "validate_customer": _st(lambda st: st.validate_customer()),
    # Q20 U2 A9
    "finalize_status": _st(lambda st: st.finalize_status()),
    # Q21 J3 A7 A16
    "execution_log": _st(lambda st: st.execution_log()),
    # Q22 A12
    "processing_summary": _st(lambda st: st.processing_summary()),
    # Q23 T5
    "department_summary": _st(lambda st: st.department_summary()),
    # Q24
    "validation_summary": _st(lambda st: st.validation_summary()),
    # Q25 P26
    "similar_order_count": _st(lambda st: st.similar_order_count()),
    # Q26 P26
    "regional_category_average": _st(lambda st: st.regional_category_average()),
    # Q27 W1 T2
    "employee_ranking": _st(lambda st: st.employee_ranking),
    # Q28 A8
    "customer_segmentation": _st(lambda st: st.customer_segmentation),
    # Q29 U3
    "reclassify_status": _st(lambda st: st.reclassify_status()),
    # Q30 T3 T4 J13
    "customer_segment_analysis": _st(lambda st: st.customer_segment_analysis(st.m.stored_segment_analysis(st.p))),
    # Q31 R2
    "department_budget_tree": metrics.department_budget_tree,
    # Q32 P8 P16
    "department_performance_metrics": _st(lambda st: st.department_metrics),
    # Q33
    "department_performance_report": _st(lambda st: st.department_performance_report(st.m.stored_department_report(st.p))),
    # Q34 U4 P17 P22
    "repair_order_dates": _st(lambda st: st.repair_order_dates()),
    # Q35
    "process_statistics": _st(lambda st: st.process_statistics()),
    # Q36 J9
    "regions_cross_count": _st(lambda st: st.regions_cross_count()),
    # Q39 M7
    "merge_update_only": _st(lambda st: upserts.merge_update_only(st)),
    # Q37
    "nested_topn_amount": _st(lambda st: adhoc.nested_topn_amount(
        st.m.orders, st.m.order_details, st.m.products, st.m.categories,
        st.m.categories, st.m.products, st.m.order_details, rank_others=[st.m.categories])),
    # Q38 J8
    "filtered_product_join": _st(adhoc.filtered_product_join),
    # J3
    "left_join_extra_on": _st(adhoc.left_join_extra_on),
    # J9 J10
    "category_sales_through_product": _st(adhoc.category_sales_through_product),
    # A10
    "order_value_percentiles": _st(adhoc.order_value_percentiles),
    # S7
    "staged_row_ids": _st(adhoc.staged_row_ids),
    # F7 F9
    "orders_of_the_year": _st(adhoc.orders_of_the_year),
    # S2
    "customers_by_qualified_names": _st(adhoc.customers_by_qualified_names),
    # U4 D1 on lasting tables
    "orders_repaired_in_place": _st(inplace.orders_repaired_in_place),
    "queue_purged_in_place": _st(inplace.queue_purged_in_place),
    # P26 A14 from kept months
    "sales_history": inplace.sales_history,
    # S8 S10
    "failed_run": inplace.failed_run,
    # Q40 S10 S13 S14
    "run_pipeline": pipeline.run_pipeline_counts,
}


def bind(fn: QueryFn, params: RunParams = DEFAULT_PARAMS, name: str | None = None,
         shared: Run | None = None) -> Callable[[SparkSession, str], DataFrame]:
    """``fn`` over the tables of a folder; queries bound to one ``shared`` run share its stored tables."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        return fn(RetailModel(spark, sf_dir, shared), params)
    run.__name__ = name or getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run
