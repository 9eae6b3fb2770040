"""The procedure's reusable CTEs as DataFrame queries (Q1-Q6, Q31-Q32).

Plan shape used throughout: order lines are first reduced to one row per
order (partial aggregation before the shuffle), then joined to orders on
OrderId, then grouped by the report key.  Left joins the SQL makes only to
dimensions on their unique key (Products, Categories, Suppliers, Shippers,
Departments) change neither rows nor measures, so they are left out.
No side is broadcast by force: AQE's runtime broadcast conversion checks sizes.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.exprs import (datediff_days, in_cents, lit_ts, net_amount, net_unit_price, net_unit_price_units,
                                        net_units, sum_gross, sum_net)
from ledgerline.operators.hierarchy import cumulative_down, tree_paths
from ledgerline.plans import labels as L
from ledgerline.params import DEFAULT_PARAMS, RunParams
from ledgerline.sources.testdata import RetailModel


#: Megabytes of stored tables to a part of product_sales_metrics' (order, product) groups.
PAIRS_MB = 16


def avg_from_parts(total: Column, count: Column, scale: int = 4) -> Column:
    """sum/count as the exact average, rounded half-up at ``scale + 4`` decimals."""
    return (total.cast(f"decimal({22 + scale},{scale})")
            / F.nullif(count, F.lit(0)).cast("decimal(20,0)")).cast(f"decimal(38,{scale + 4})")


def order_totals(m: RetailModel) -> DataFrame:
    """One row per order that has lines: net and gross sums and line count, and where the
    model makes ShippedDate of it, the first ship date, from the same pass."""
    od = m.shipped_lines if m.shipped_lines is not None else m.order_details
    first_ship = [F.min("ShipDate").alias("first_ship")] if m.shipped_lines is not None else []
    return od.groupBy("OrderId").agg(
        sum_net(od).alias("net_sum"),
        sum_gross(od).alias("gross_sum"),
        F.count(F.lit(1)).alias("line_count"),
        *first_ship,
    )


# ---------------------------------------------------------------- Q1 / Q31
def department_hierarchy(m: RetailModel, params: RunParams = DEFAULT_PARAMS) -> DataFrame:
    """Q1: departments reachable from a root, with Level and HierarchyPath."""
    return tree_paths(m.spark, m.departments, id_col="DepartmentId", parent_col="ParentDepartmentId",
                      name_col="DepartmentName", sep=L.PATH_SEPARATOR,
                      keep=["ManagerId", "BudgetAmount", "LocationId"])


def department_budget_tree(m: RetailModel, params: RunParams = DEFAULT_PARAMS) -> DataFrame:
    """Q31: TotalBudget = parent's TotalBudget + own BudgetAmount, from the root down."""
    return cumulative_down(m.spark, m.departments, id_col="DepartmentId",
                           parent_col="ParentDepartmentId", value_col="BudgetAmount",
                           keep=["DepartmentName"])


# ---------------------------------------------------------------- Q2
def employee_performance(m: RetailModel, params: RunParams = DEFAULT_PARAMS) -> DataFrame:
    """Q2: per active employee, orders sold, gross sales, average gross line, first/last date."""
    o = m.orders.select("OrderId", "SalesPersonId", "OrderDate")
    per_order = o.join(order_totals(m), "OrderId", "left")
    per_emp = per_order.groupBy(F.col("SalesPersonId").alias("EmployeeId")).agg(
        F.count("OrderId").alias("TotalOrders"),
        F.sum("gross_sum").alias("g"), F.sum("line_count").alias("n"),
        F.max("OrderDate").alias("LastOrderDate"), F.min("OrderDate").alias("FirstOrderDate"))
    e = m.employees.filter(F.col("IsActive") == 1).select(
        "EmployeeId", "EmployeeName", "DepartmentId", "ManagerId", "HireDate", "Salary", "PositionId")
    j = e.join(per_emp, "EmployeeId", "left")
    return j.select(
        *e.columns,
        F.coalesce(F.col("TotalOrders"), F.lit(0)).alias("TotalOrders"),
        F.col("g").cast("decimal(38,4)").alias("TotalSales"),
        avg_from_parts(F.col("g"), F.col("n"), scale=2).alias("AvgOrderValue"),
        "LastOrderDate", "FirstOrderDate")


# ---------------------------------------------------------------- Q3
def customer_analysis(m: RetailModel, params: RunParams = DEFAULT_PARAMS) -> DataFrame:
    """Q3: per active customer, orders, net spend, average net line, recency."""
    o = m.orders.select("OrderId", "CustomerId", "OrderDate")
    per_order = o.join(order_totals(m), "OrderId", "left")
    per_cust = per_order.groupBy("CustomerId").agg(
        F.count("OrderId").alias("OrderCount"),
        F.sum("net_sum").alias("s"), F.sum("line_count").alias("n"),
        F.max("OrderDate").alias("LastPurchaseDate"))
    c = m.customers.filter(F.col("IsActive") == 1).select(
        "CustomerId", "CustomerName", "CustomerTypeId", "RegionId", "CreditLimit")
    j = c.join(per_cust, "CustomerId", "left")
    return j.select(
        *c.columns,
        F.coalesce(F.col("OrderCount"), F.lit(0)).alias("OrderCount"),
        F.col("s").cast("decimal(38,4)").alias("TotalSpent"),
        avg_from_parts(F.col("s"), F.col("n")).alias("AvgOrderAmount"),
        "LastPurchaseDate",
        datediff_days(F.col("LastPurchaseDate"), lit_ts(params.current_ts)).alias("DaysSinceLastPurchase"))


# ---------------------------------------------------------------- Q4
def product_sales_metrics(m: RetailModel, params: RunParams = DEFAULT_PARAMS) -> DataFrame:
    """Q4: per product, orders, quantity, net revenue, average net unit price, last sale."""
    od = m.order_details
    o = m.orders.select("OrderId", "OrderDate")
    # Lines are shuffled once by OrderId for the join; the (OrderId, ProductId)
    # aggregate reuses that partitioning, and the per-product aggregate is
    # partial before its shuffle, so a hot product is combined map-side.
    # A task holds its pairs twice, as partial and as whole groups: parts of a set size
    # (which AQE leaves as they are) keep that from growing with the tables.
    n = m.parts_of(PAIRS_MB)
    if n > m.spark.sparkContext.defaultParallelism:
        od, o = od.repartition(n, "OrderId"), o.repartition(n, "OrderId")
    # whole ten-thousandths, where the columns allow it: a third of a decimal's room
    whole = in_cents(od, "UnitPrice", "Discount")
    net, unit = (net_units(), net_unit_price_units()) if whole else (net_amount(), net_unit_price())
    money = lambda c: F.col(c).cast("decimal(20,0)") * F.lit(Decimal("0.0001")) if whole else F.col(c)
    lines = od.join(o, "OrderId", "left")
    per_pair = lines.groupBy("OrderId", "ProductId").agg(
        F.sum("Quantity").alias("q"), F.sum(net).alias("s"),
        F.sum(unit).alias("u"), F.count(F.lit(1)).alias("n"),
        F.max("OrderDate").alias("d"))
    per_prod = per_pair.groupBy("ProductId").agg(
        F.count("OrderId").alias("OrderCount"), F.sum("q").alias("TotalQuantitySold"),
        F.sum("s").alias("s"), F.sum("u").alias("u"), F.sum("n").alias("n"),
        F.max("d").alias("LastSaleDate"))
    p = m.products.select("ProductId", "ProductName", "CategoryId", "SupplierId", "UnitPrice",
                          "UnitsInStock", "UnitsOnOrder", "ReorderLevel")
    j = p.join(per_prod, "ProductId", "left")
    return j.select(
        *p.columns,
        F.coalesce(F.col("OrderCount"), F.lit(0)).alias("OrderCount"),
        F.col("TotalQuantitySold").cast("long").alias("TotalQuantitySold"),
        money("s").cast("decimal(38,4)").alias("TotalRevenue"),
        avg_from_parts(money("u"), F.col("n")).alias("AvgSellingPrice"),
        "LastSaleDate")


# ---------------------------------------------------------------- Q5
def regional_sales_summary(m: RetailModel, params: RunParams = DEFAULT_PARAMS,
                           totals: DataFrame | None = None) -> DataFrame:
    """Q5: per region, customers, orders, net sales, average net line, distinct salespeople."""
    c = m.customers.select("CustomerId", "RegionId")
    o = m.orders.select("OrderId", "CustomerId", "SalesPersonId")
    e = m.employees.select(F.col("EmployeeId").alias("SalesPersonId"), F.lit(1).alias("emp_exists"))
    totals = totals if totals is not None else order_totals(m)
    per_order = (o.join(totals.select("OrderId", "net_sum", "line_count"), "OrderId", "left")
                 .join(e, "SalesPersonId", "left"))
    cust_orders = c.join(per_order, "CustomerId", "inner")
    # one pass: a single distinct aggregate is planned as (region, salesperson)
    # partial groups, so it needs no Expand over the order rows
    order_side = cust_orders.groupBy("RegionId").agg(
        F.count("OrderId").alias("OrderCount"), F.sum("net_sum").alias("s"),
        F.sum("line_count").alias("n"),
        F.count_distinct(F.when(F.col("emp_exists") == 1, F.col("SalesPersonId"))).alias("EmployeeCount"))
    cust_side = c.groupBy("RegionId").agg(F.count(F.lit(1)).alias("CustomerCount"))
    r = m.regions
    j = r.join(cust_side, "RegionId", "left").join(order_side, "RegionId", "left")
    return j.select(
        "RegionId", "RegionName", "CountryId",
        F.coalesce(F.col("CustomerCount"), F.lit(0)).alias("CustomerCount"),
        F.coalesce(F.col("OrderCount"), F.lit(0)).alias("OrderCount"),
        F.col("s").cast("decimal(38,4)").alias("TotalSales"),
        avg_from_parts(F.col("s"), F.col("n")).alias("AvgOrderValue"),
        F.coalesce(F.col("EmployeeCount"), F.lit(0)).alias("EmployeeCount"))


# ---------------------------------------------------------------- Q6
def category_gross_sales(m: RetailModel, per_product: DataFrame | None = None) -> DataFrame:
    """Gross sales per category name over all order lines (inner joins); ``per_product`` (ProductId, g) may be kept."""
    if per_product is None:
        per_product = m.order_details.groupBy("ProductId").agg(sum_gross(m.order_details).alias("g"))
    p = m.products.select("ProductId", "CategoryId")
    per_cat = per_product.join(p, "ProductId", "inner").groupBy("CategoryId").agg(F.sum("g").alias("g"))
    cat = m.categories
    return (per_cat.join(cat, "CategoryId", "inner").groupBy("CategoryName")
            .agg(F.sum("g").cast("decimal(38,2)").alias("GrossSales")))


def top_categories(m: RetailModel, params: RunParams = DEFAULT_PARAMS, n: int = 5,
                   per_product: DataFrame | None = None) -> DataFrame:
    """Q6: the five category names with the highest gross sales (ties by name)."""
    ranked = category_gross_sales(m, per_product).orderBy(F.col("GrossSales").desc(), F.col("CategoryName").asc())
    return ranked.limit(n)


# ---------------------------------------------------------------- Q32
def department_performance_metrics(m: RetailModel, params: RunParams = DEFAULT_PARAMS,
                                   totals: DataFrame | None = None) -> DataFrame:
    """Q32: per department in the budget tree, recent sales against the cumulative budget.

    ``WHERE o.OrderDate >= @PreviousMonth OR o.OrderDate IS NULL`` after the
    left joins keeps employees with no orders at all and the recent (or
    undated) orders of the others; employees whose orders are all older drop
    out, and so does a department left with no rows.
    """
    prev = lit_ts(params.previous_month)
    totals = totals if totals is not None else order_totals(m)
    rdb = department_budget_tree(m, params).select("DepartmentId", "DepartmentName", "TotalBudget")
    e = m.employees.select("EmployeeId", "DepartmentId")
    orders = m.orders.select("OrderId", F.col("SalesPersonId").alias("EmployeeId"), "CustomerId", "OrderDate")
    recent = orders.filter((F.col("OrderDate") >= prev) | F.col("OrderDate").isNull())
    # one row per (salesperson, customer) before any join on the salesperson: a busy one isn't a hot key
    pairs = (recent.join(totals.select("OrderId", "net_sum", "line_count"), "OrderId", "left")
             .groupBy("EmployeeId", "CustomerId")
             .agg(F.count(F.lit(1)).alias("k"), F.sum("net_sum").alias("s"), F.sum("line_count").alias("n")))
    known = m.customers.select("CustomerId", F.col("CustomerId").alias("ExistingCustomer"))
    sales = (pairs.join(e, "EmployeeId", "inner").join(known, "CustomerId", "left").groupBy("DepartmentId")
             .agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("k").alias("OrderCount"),
                  F.count_distinct("ExistingCustomer").alias("CustomerCount")))
    # who counts: sold something recently, or never sold anything
    sold = orders.groupBy("EmployeeId").agg(F.max(
        ((F.col("OrderDate") >= prev) | F.col("OrderDate").isNull()).cast("int")).alias("sold_recently"))
    counted = (e.join(sold, "EmployeeId", "left").filter("sold_recently IS NULL OR sold_recently = 1")
               .groupBy("DepartmentId").agg(F.count(F.lit(1)).alias("EmployeeCount")))
    staffed = e.groupBy("DepartmentId").agg(F.count(F.lit(1)).alias("staff"))
    j = (rdb.join(staffed, "DepartmentId", "left").join(counted, "DepartmentId", "left")
         .join(sales, "DepartmentId", "left")
         .filter(F.col("staff").isNull() | F.col("EmployeeCount").isNotNull()))
    total = F.col("s").cast("decimal(38,4)")
    return j.select(
        "DepartmentId", "DepartmentName", "TotalBudget",
        F.coalesce(F.col("EmployeeCount"), F.lit(0)).alias("EmployeeCount"),
        total.alias("TotalSales"),
        avg_from_parts(F.col("s"), F.col("n")).alias("AvgOrderValue"),
        F.coalesce(F.col("OrderCount"), F.lit(0)).alias("OrderCount"),
        F.coalesce(F.col("CustomerCount"), F.lit(0)).alias("CustomerCount"),
        sales_to_budget(total, F.col("TotalBudget")).alias("SalesToBudgetRatio"))


def sales_to_budget(total: Column, budget: Column) -> Column:
    """`(sales / NULLIF(budget, 0)) * 100`, rounded half-up to 6 decimals."""
    ratio = total.cast("decimal(30,4)") * 100 / F.nullif(budget, F.lit(0)).cast("decimal(20,2)")
    return ratio.cast("decimal(38,6)")
