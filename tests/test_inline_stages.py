"""Stage rules on hand-made rows: branches the generated test tables never reach."""

from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerline.params import RunParams
from ledgerline.plans import upserts
from ledgerline.plans.stages import Stages
from ledgerline.sources.testdata import FrameModel

CUR = datetime(1998, 7, 1)
P = RunParams(current_ts=CUR)


def day(n):
    return CUR + timedelta(days=n)


@pytest.fixture(scope="module")
def model(spark):
    mk = spark.createDataFrame
    regions = mk([(0, "R0", 0)], "RegionId int, RegionName string, CountryId int")
    customers = mk([(1, "vip", 1, 0, D("1000000.00"), 1), (2, "small", 1, 0, D("10.00"), 1),
                    (3, "gone", 1, 0, D("5.00"), 0)],
                   "CustomerId long, CustomerName string, CustomerTypeId int, RegionId int, "
                   "CreditLimit decimal(18,2), IsActive int")
    # category 1: products 10 (low stock), 11; category 2: product 20 (discontinued)
    products = mk([(10, "p10", 1, 1, D("1.00"), 1, 0, 0, 0), (11, "p11", 1, 1, D("1.00"), 9, 0, 0, 0),
                   (20, "p20", 2, 1, D("1.00"), 5, 0, 0, 1)],
                  "ProductId long, ProductName string, CategoryId int, SupplierId long, UnitPrice decimal(10,2), "
                  "UnitsInStock int, UnitsOnOrder int, ReorderLevel int, Discontinued int")
    categories = mk([(1, "Cat1"), (2, "Cat2")], "CategoryId int, CategoryName string")
    suppliers = mk([(1,)], "SupplierId long")
    shippers = mk([(1,)], "ShipperId int")
    employees = mk([(7, "e7", 100, 0, day(-900), D("1.00"), 1, 1)],
                   "EmployeeId long, EmployeeName string, DepartmentId int, ManagerId long, HireDate timestamp_ntz, "
                   "Salary decimal(18,2), PositionId int, IsActive int")
    departments = mk([(0, "HQ", None, 0, D("100.00"), 0), (100, "Sales", 0, 0, D("0.00"), 0)],
                     "DepartmentId int, DepartmentName string, ParentDepartmentId int, ManagerId int, "
                     "BudgetAmount decimal(18,2), LocationId int")
    # customer 1: 11 orders in June (VIP); customer 2: one June order with cheap lines (Standard)
    orders, lines = [], []
    for i in range(11):
        orders.append((100 + i, day(-20) + timedelta(hours=i), 7, 1, 1, day(-20 + 200), day(-20 + 300)))
        lines.append((100 + i, 10, 1, D("5.00"), D("0.00")))
    orders.append((200, day(-10), 7, 2, 1, day(-15), day(200)))     # required before order; shipped late
    lines += [(200, 10, 2, D("3.00"), D("0.10")), (200, 20, 1, D("2.00"), D("0.00"))]  # has a discontinued product
    orders.append((300, day(-5), 7, 2, 1, day(10), day(250)))       # shipped late, no discontinued product
    lines.append((300, 11, 1, D("4.00"), D("0.00")))
    lines.append((300, 10, 1, D("4.00"), D("0.00")))
    orders_df = mk(orders, "OrderId long, OrderDate timestamp_ntz, SalesPersonId long, CustomerId long, ShipVia int, "
                           "RequiredDate timestamp_ntz, ShippedDate timestamp_ntz")
    od = mk(lines, "OrderId long, ProductId long, Quantity int, UnitPrice decimal(10,2), Discount decimal(4,2)")
    cancellations = mk([], "OrderId long, CancellationDate timestamp_ntz")
    discounts = mk([(2, D("10.00"), day(-100), day(100), 1)],
                   "CustomerId long, DiscountPercent decimal(5,2), StartDate timestamp_ntz, EndDate timestamp_ntz, "
                   "IsActive int")
    queue = mk([(1, 100, "Processed", day(-60)), (2, 200, "Processed", day(-60)), (3, 300, "Pending", day(-60)),
                (4, 101, "Processed", day(-1))],
               "QueueId long, OrderId long, Status string, ProcessedDate timestamp_ntz")
    frames = dict(regions=regions, customers=customers, orders=orders_df.drop("ShippedDate"),
                  orders_with_shipping=orders_df, order_details=od, products=products, categories=categories,
                  suppliers=suppliers, shippers=shippers, employees=employees, departments=departments,
                  order_cancellations=cancellations, discounts=discounts, order_processing_queue=queue)
    return FrameModel(spark, frames)


def test_vip_and_standard_tiers(model):
    st = Stages(model, P)
    tiers = {r.CustomerId: r.Tier for r in st.customer_tier().collect()}
    assert tiers == {1: "VIP", 2: "Standard"}
    statuses = {r.CustomerId: r.Status for r in st.tpd1.select("CustomerId", "Status").distinct().collect()}
    assert statuses == {1: "VIP", 2: "Standard"}


def test_reprice_applies_discount_factor(model):
    st = Stages(model, P)
    amounts = {(r.OrderId, r.ProductId): r.Amount for r in st.tpd2.collect()}
    # order 200, product 10: 2 * 3.00 * 0.90 = 5.40, customer 2 has a 10 % discount -> x 1.10 = 5.94
    assert amounts[(200, 10)] == D("5.94")
    assert amounts[(100, 10)] == D("5.00")


def test_null_amount_validation_trap(model, spark):
    st = Stages(model, P)
    tpd = st.tpd1.limit(1).withColumn("Amount", F.lit(None).cast("decimal(18,2)"))
    v = st._with_validations(tpd).first()
    assert (v.amount_valid, v.amount_msg) == (0, "Valid")


def test_credit_limit_and_finalize(model):
    st = Stages(model, P)
    res = {(r.CustomerId, r.ValidationType): (r.IsValid, r.ValidationMessage)
           for r in st.validation_results().collect()}
    assert res[(2, "Customer Status Validation")] == (0, "Customer credit limit exceeded")
    assert res[(1, "Customer Status Validation")] == (1, "Valid")
    final = {r.CustomerId: (r.Status, r.ErrorMessage, r.IsProcessed) for r in st.finalize_status().collect()}
    assert final[2] == ("Validation Failed", "Customer credit limit exceeded", 1)
    assert final[1] == ("Processed", None, 1)


def test_repair_order_dates_discontinued_exception(model):
    st = Stages(model, P)
    got = {r.OrderId: (r.RequiredDate, r.ShippedDate) for r in st.repair_order_dates().collect()}
    # 200: required before order -> +7 days; shipped > 180 days but has a discontinued product -> unchanged
    assert got[200] == (day(-10) + timedelta(days=7), day(200))
    # 300: shipped > 180 days, no discontinued product -> order date + 14 days
    assert got[300] == (day(10), day(-5) + timedelta(days=14))
    # VIP orders: required > 90 days after order -> +30 days
    assert got[100][0] == day(-20) + timedelta(days=30)


def test_purge_deletes_old_processed_clean_orders(model):
    st = Stages(model, P)
    processed = st.tpd1.withColumn("IsProcessed", F.lit(1))
    kept = {r.QueueId for r in upserts.purge_processed_queue(st, tpd=processed).collect()}
    # 1 goes (processed, old, clean); 2 stays (discontinued product); 3 pending; 4 too recent
    assert kept == {2, 3, 4}


def test_pipeline_failure_writes_error_log(spark, model, scratch):
    import os

    from ledgerline.plans.pipeline import run_pipeline
    from ledgerline.params import RunParams as RP
    frames = {k: v for k, v in model.__dict__.items() if hasattr(v, "columns")}
    frames["orders"] = frames["orders"].drop("SalesPersonId")       # broken input
    broken = FrameModel(spark, frames, name="broken")
    out = os.path.join(scratch, "failed-run")
    params = RP(current_ts=CUR, run_id="failing-run")
    with pytest.raises(Exception):
        run_pipeline(broken, params, out_dir=out)
    err = spark.read.parquet(os.path.join(out, "ErrorLog")).collect()
    assert len(err) == 1 and err[0].ProcessId == "failing-run" and err[0].ErrorMessage


def test_zero_budget_gives_null_ratio(spark, model):
    zero = spark.createDataFrame([(0, "HQ", None, 0, D("0.00"), 0), (100, "Sales", 0, 0, D("0.00"), 0),
                                  (101, "Empty", 0, 0, D("5.00"), 0)],
                                 "DepartmentId int, DepartmentName string, ParentDepartmentId int, ManagerId int, "
                                 "BudgetAmount decimal(18,2), LocationId int")
    frames = {k: v for k, v in model.__dict__.items() if hasattr(v, "columns")}
    frames["departments"] = zero
    st = Stages(FrameModel(spark, frames, name="zero-budget"), P)
    rows = {r.DepartmentId: r for r in st.department_performance_report().collect()}
    assert rows[100].TotalSales is not None and rows[100].SalesToBudgetRatio is None
    assert rows[100].Status == "Below Target"
    assert rows[101].EmployeeCount == 0 and rows[101].TotalSales is None   # no staff: kept, empty measures


def test_a_third_rule_needs_no_other_change(model, monkeypatch):
    """Messages of a record are listed in the rules' order; each failed one is a row of the left join."""
    from ledgerline.plans.adhoc import left_join_extra_on
    from ledgerline.plans.stages import Rule
    two = Stages.rules
    monkeypatch.setattr(Stages, "rules", lambda self: [
        Rule("order", "Order Validation", F.col("OrderId") < 300, F.col("OrderId") != 200, F.lit("Order is 200")), *two(self)])
    st = Stages(model, P)
    final = {(r.OrderId, r.ProductId): (r.Status, r.ErrorMessage) for r in st.finalize_status().collect()}
    assert final[(200, 10)] == ("Validation Failed", "Order is 200; Customer credit limit exceeded")
    assert final[(300, 10)] == ("Validation Failed", "Customer credit limit exceeded")
    assert final[(100, 10)] == ("Processed", None)
    joined = [(r.OrderId, r.ValidationType) for r in left_join_extra_on(st).filter("CustomerId = 2").collect()]
    assert sorted(joined) == sorted([(200, "Order Validation"), (200, "Customer Status Validation")] * 2
                                    + [(300, "Customer Status Validation")] * 2)
    kinds = {r.ValidationType: r.TotalValidations for r in st.validation_summary().collect()}
    assert kinds["Order Validation"] == kinds["Amount Validation"] - 2
    ids = sorted(r.Id for r in st.tpd1.collect())
    assert ids == list(range(1, len(ids) + 1)) and {r.RecordId for r in st.validations.collect()} == set(ids)


def test_no_report_expands_its_rows(model):
    st = Stages(model, P)
    for df in (st.sales_performance_report(), st.execution_log(), st.process_statistics()):
        assert "Expand" not in df._jdf.queryExecution().optimizedPlan().toString()
