"""What queries do as their tables grow: passes over the lines, sizes of parts, whole-number sums."""

from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.exprs import net_amount, sum_gross, sum_net
from ledgerline.params import DEFAULT_PARAMS
from ledgerline.plans import history, inplace, metrics
from ledgerline.plans.stages import Run, Stages
from ledgerline.sources.lasting import LastingTables
from ledgerline.sources.testdata import RetailModel

LINES = "OrderId long, ProductId long, Quantity int, UnitPrice decimal(10,2), Discount decimal(4,2)"


@pytest.fixture(scope="module")
def folder(spark, scratch):
    """Raw tables: 40 orders of 8 customers, three lines each, some odd."""
    day = datetime(1998, 5, 20)
    rows = {
        "region": ([(0, "AFRICA"), (1, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(i, f"N{i}", i % 2) for i in range(4)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": ([(i, f"S{i}", i % 4, 1.0) for i in range(5)],
                     "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "customer": ([(i, f"C{i}", i % 4, 10.0, "BUILDING") for i in range(8)],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "part": ([(i, f"P{i}", f"Brand#{11 + i % 3}", 5.0, i + 1) for i in range(6)],
                 "p_partkey long, p_name string, p_brand string, p_retailprice double, p_size int"),
        "orders": ([(i, i % 8, "OFP"[i % 3], 1.0, day + timedelta(days=i * 2), "1-URGENT") for i in range(40)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
                   "o_orderpriority string"),
        "lineitem": ([(i, (i + k) % 6, 0, k, float(k + 1), 10.005 * (i + 1) + k, 0.05 * k, 0.0, "N", "O", day + timedelta(days=i))
                      for i in range(40) for k in range(3)] + [(None, 1, 0, 1, 2.0, 3.0, 0.0, 0.0, "N", "O", day)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                     "l_shipdate timestamp_ntz"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{scratch}/growth/{name}.parquet")
    return f"{scratch}/growth"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_sums_in_whole_units_are_those_of_the_decimals(spark):
    lines = spark.createDataFrame([(1, 1, 3, D("19.99"), D("0.07")), (1, 2, -2, D("0.01"), D("0.00")), (2, 1, 7, None, D("0.10")),
                                   (3, 1, 1, D("99999999.99"), D("1.00")), (3, 2, 5, D("-4.35"), D("0.33"))], LINES)
    was = lines.groupBy("OrderId").agg(F.sum(net_amount()).alias("n"), F.sum(F.col("Quantity") * F.col("UnitPrice")).alias("g"))
    now = lines.groupBy("OrderId").agg(sum_net(lines).alias("n"), sum_gross(lines).alias("g"))
    assert now.schema == was.schema and sorted(now.collect()) == sorted(was.collect())
    # columns of more places are added up as they are
    fine = lines.withColumn("Discount", F.lit(D("0.0625")).cast("decimal(5,4)"))
    assert fine.agg(sum_net(fine)).first()[0] == fine.agg(F.sum(net_amount()).cast("decimal(37,4)")).first()[0]


def test_unit_price_needs_no_decimal_division(spark, folder):
    od = RetailModel(spark, folder).order_details
    text = od._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal(20,0)" not in text and "round(" not in text
    prices = {(r.OrderId, r.ProductId): r.UnitPrice for r in od.collect()}
    assert prices[(0, 0)] == D("10.01") and prices[(0, 1)] == D("5.51") and prices[(3, 3)] == D("40.02")


def test_product_sales_in_parts_of_a_set_size(spark, folder, monkeypatch):
    m = RetailModel(spark, folder)
    few = sorted(metrics.product_sales_metrics(m).collect())
    monkeypatch.setattr(RetailModel, "parts_of", lambda self, megabytes: 37, raising=False)
    many = metrics.product_sales_metrics(RetailModel(spark, folder))
    assert plan(many).count("37), REPARTITION_BY_NUM") == 2
    assert sorted(many.collect()) == few


def test_summary_seed_reads_the_lines_once(spark, folder):
    seed = RetailModel(spark, folder).customer_order_summary(DEFAULT_PARAMS)
    assert plan(seed).count("l_orderkey") and plan(seed).count("lineitem.parquet") == 1
    m = RetailModel(spark, folder)
    e = m.employees.select(F.col("EmployeeId").alias("SalesPersonId"), "DepartmentId")
    want = {(r.CustomerId, r.DepartmentId): (r.o, r.p, r.e, r.s) for r in m.orders.join(m.order_details, "OrderId").join(
        e, "SalesPersonId").filter("CustomerId % 3 != 2").groupBy("CustomerId", "DepartmentId").agg(
        F.count_distinct("OrderId").alias("o"), F.count_distinct("ProductId").alias("p"),
        F.count_distinct("SalesPersonId").alias("e"), F.sum(net_amount()).cast("decimal(18,2)").alias("s")).collect()}
    got = {(r.CustomerId, r.DepartmentId): (r.OrderCount, r.ProductCount, r.EmployeeCount, r.TotalAmount) for r in seed.collect()}
    assert got == want


def test_months_states_meet_once(spark):
    lines = spark.createDataFrame([(1, 1, 3, D("1.50"), D("0.10"), 199805), (1, 2, 1, D("2.00"), D("0.00"), 199805)],
                                  LINES + ", OrderMonth int")
    per = history._per_month(lines, ["OrderId"], history._sums(lines))
    assert plan(per).count("Exchange") == 1
    assert [tuple(r) for r in per.collect()] == [(199805, 1, D("6.0500"), D("6.50"), 2)]


def test_arranged_rows_are_written_without_another_exchange(spark, scratch):
    tables = LastingTables(spark, f"{scratch}/arranged")
    change = tables.begin()
    change.create("T", spark.createDataFrame([(1, 199805), (2, 199806), (3, None)], "a int, OrderMonth int"), ["OrderMonth"],
                  arranged=True)
    change.commit()
    assert sorted((r.a, r.OrderMonth) for r in tables.read("T").collect()) == [(1, 199805), (2, 199806), (3, None)]


def test_reports_by_category_share_one_join_with_the_products(spark, folder):
    run = Run()
    st = Stages(RetailModel(spark, folder), DEFAULT_PARAMS, run=run, facts={})
    assert "part.parquet" not in plan(st.recent_sales) and "SupplierId" in st.recent_sales.columns
    assert st.recent_sales.count() == st.recent_lines.count() > st.window_lines.count() > 0
    assert {r.OrderId for r in st.window_lines.collect()} == {r.OrderId for r in st.window_orders.collect()}
    run.end()


def repeated(spark, folder, run=None) -> RetailModel:
    """The tables with orders whose key stands several times (other dates, customers and states) or is NULL."""
    class Repeated(RetailModel):
        def raw(self, name):
            df = super().raw(name)
            if name != "orders":
                return df
            key, day = F.col("o_orderkey"), F.col("o_orderdate")
            again = df.filter(key % 3 == 0).withColumns({
                "o_orderdate": F.timestamp_add("DAY", F.lit(20), day), "o_custkey": (F.col("o_custkey") + 3) % 8,
                "o_orderstatus": F.when(key % 2 == 0, "O").when(key % 9 == 0, None).otherwise("F")})
            return df.unionByName(again).unionByName(df.limit(1).withColumn("o_orderkey", F.lit(None).cast("long")))
    return Repeated(spark, folder, run)


def test_ship_dates_come_from_the_sums_of_the_lines(spark, folder):
    m = repeated(spark, folder)
    o, first = m.orders, m.raw("lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first"))
    status = m.raw("orders").select(F.col("o_orderkey").alias("sk"), "o_orderstatus")
    want = (o.join(status, o.OrderId == status.sk).join(first, o.OrderId == first.l_orderkey, "left").select(
        *o.columns, F.when(F.col("o_orderstatus") == "O", F.lit(None)).otherwise(F.col("first")).alias("ShippedDate")))
    rows = sorted(map(repr, want.collect()))
    st = Run().stages(m, DEFAULT_PARAMS)
    assert len(rows) > 40 and sorted(map(repr, m.orders_with_shipping.collect())) == rows
    assert sorted(map(repr, st.shipped_orders.collect())) == rows
    # from the sums that the run has stored
    assert "lineitem.parquet" not in plan(st.shipped_orders)
    assert st.order_totals.columns == ["OrderId", "net_sum", "gross_sum", "line_count"]


@pytest.mark.parametrize("model", [RetailModel, repeated])
def test_the_window_needs_no_recent_lines(spark, folder, model):
    run, other = Run(), Run()
    st, after = run.stages(model(spark, folder, run), DEFAULT_PARAMS), other.stages(model(spark, folder, other), DEFAULT_PARAMS)
    repaired = inplace.orders_repaired_in_place(st)
    assert repaired.count() > 0 and not [f for f in st.facts if f.startswith("recent_lines")]
    # the same where the run has all recent lines
    assert after.recent_lines.count() > after.window_lines.count() > 0
    assert sorted(map(repr, st.window_lines.collect())) == sorted(map(repr, after.window_lines.select(*st.window_lines.columns).collect()))
    assert sorted(map(repr, st.validated.collect())) == sorted(map(repr, after.validated.collect()))
    assert sorted(map(repr, inplace.orders_repaired_in_place(after).collect())) == sorted(map(repr, repaired.collect()))


def test_fixes_are_looked_for_in_the_stored_months(spark, folder):
    st = Run().stages(RetailModel(spark, folder), DEFAULT_PARAMS)
    stored = st._keep(st.shipped_orders)
    assert sorted(st.order_date_fixes(orders=stored).collect()) == sorted(st.order_date_fixes().collect())
