"""The procedure's stages 1-14 as DataFrame queries (Q7-Q30, Q33-Q36).

``Stages`` holds one run (model + parameters) and builds each version of the
staging table (#TempProcessingData) lazily:

* ``tpd1`` stage 1 rows (one per qualifying order line), IsProcessed = 0;
* ``tpd2`` after the stage-2 re-price and value status;
* ``tpd3`` after validation and finalisation (stage 8), IsProcessed = 1;
* ``tpd4`` after the stage-11 reclassification.

Correlated subqueries of the procedure are decorrelated into one grouped
frame per natural key (customer, order, (order, product), (customer,
category), (region, category), employee), joined back on that key.  Staging rows
get their IDENTITY ids when they are filled; the validation rows carry them, and the
finalisation aggregates the failed ones by them.

Every query reads the whole model tables; only the run parameters restrict
rows, exactly as the procedure does.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.exprs import (add_days, count_when, lit_ts, month_number, net_amount, optional_eq,
                                        percent_factor, sum_net, tier)
from ledgerline.operators.distinct import distinct_counts
from ledgerline.operators.dml import update
from ledgerline.operators.quantile import percentile_cont
from ledgerline.operators.relational import append_if_absent, identity_ids, row_number_by_range, top_n_per_key
from ledgerline.params import DEFAULT_PARAMS, RunParams
from ledgerline.plans import labels as L
from ledgerline.plans import metrics
from ledgerline.session import ensure_checkpoint_dir, remove_folder
from ledgerline.sources.testdata import ORDER_MONTH, RetailModel

TPD_KEYS = ["CustomerId", "OrderId", "ProductId", "EmployeeId", "DepartmentId"]
TPD_COLUMNS = TPD_KEYS + ["Amount", "Status", "ProcessDate", "IsProcessed", "ErrorMessage"]
#: With the IDENTITY column, which the stages use; queries that are compared with SQL leave it out.
STAGED = ["Id"] + TPD_COLUMNS


@dataclass(frozen=True)
class Rule:
    """A validation of staging rows: which rows it looks at, which of those are valid, and what it says."""
    key: str
    kind: str
    applies: Column
    valid: Column
    message: Column


def _dec(x: str) -> Column:
    return F.lit(Decimal(x))


def sorted_list(values: Column, sep: str = L.LIST_SEPARATOR) -> Column:
    """`STRING_AGG(DISTINCT x, sep)` with a fixed (sorted) order; NULL when empty.

    Used only where the distinct values per group are bounded (statuses,
    category names).
    """
    return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), sep))


class Run:
    """The stored tables that the queries of one run share (the procedure's #temp tables).

    The caller makes it, hands it to its models and ends it.  Tables are kept
    by the identity of the data (file listing, not path) and by the run's
    parameters, and lie in a folder of the run's own under the cluster's
    ``spark.checkpoint.dir``, which ``end()`` removes.
    """

    def __init__(self):
        self._stages: dict[tuple, Stages] = {}
        self._facts: dict[tuple, dict[str, DataFrame]] = {}
        self._folders: dict[str, SparkSession] = {}

    def stages(self, m: RetailModel, params: RunParams) -> "Stages":
        """One ``Stages`` per data and parameters; facts without parameters are shared by all parameters."""
        data = (m.spark.sparkContext.applicationId, m.identity())
        key = (*data, params)
        if key not in self._stages:
            self._stages[key] = Stages(m, params, run=self, facts=self._facts.setdefault(data, {}))
        return self._stages[key]

    def store(self, df: DataFrame) -> DataFrame:
        """Write an intermediate table to the run's folder and read it back.

        Later stages read it instead of re-running the lineage (columns are
        pruned), and a lost executor doesn't lose it.
        """
        spark = df.sparkSession
        path = f"{ensure_checkpoint_dir(spark)}/run-{id(self):x}-{uuid.uuid4().hex}"
        self._folders[path] = spark
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def end(self) -> None:
        """Forget and remove everything that was stored."""
        self._stages.clear()
        self._facts.clear()
        for path, spark in self._folders.items():
            remove_folder(spark, path)
        self._folders.clear()


def stages_for(m: RetailModel, params: RunParams = DEFAULT_PARAMS) -> "Stages":
    """The stages of the model's run; a model without one gets a run of its own."""
    if m.run is None:
        m.run = Run()
    return m.run.stages(m, params)


class Stages:
    def __init__(self, m: RetailModel, params: RunParams = DEFAULT_PARAMS, run: Run | None = None,
                 facts: dict[str, DataFrame] | None = None):
        self.m = m
        self.p = params
        self.run = run
        self.facts = facts
        self.cur = lit_ts(params.current_ts)
        self.prev = lit_ts(params.previous_month)
        # @@ROWCOUNT of stage 1, filled by the job that stores tpd1 (no extra count job)
        self.stage1_rows = Observation("stage1_rows")

    def _keep(self, df: DataFrame) -> DataFrame:
        return self.run.store(df) if self.run else df

    def _shared(self, name: str, build) -> DataFrame:
        """A parameter-independent fact, built once per input when facts are shared."""
        if self.facts is None:
            return build()
        if name not in self.facts:
            self.facts[name] = build()
        return self.facts[name]

    def _of_the_date(self, name: str, build) -> DataFrame:
        """A fact that depends on the run date only: runs for single departments or employees share it."""
        return self._shared(self._dated(name), build)

    def _dated(self, name: str) -> str:
        return f"{name} {self.p.current_ts.isoformat()}"

    # ------------------------------------------------------------ shared facts
    @cached_property
    def recent_orders(self) -> DataFrame:
        """Orders with OrderDate >= @PreviousMonth (the lower-bound filters): about a month's, stored once per run."""
        def build():
            recent = self.m.since(self.m.orders, self.p.previous_month).filter(F.col("OrderDate") >= self.prev)
            return self._keep(recent.drop(ORDER_MONTH))
        return self._of_the_date("recent_orders", build)

    @cached_property
    def window_orders(self) -> DataFrame:
        """Orders in [@PreviousMonth, @CurrentDate): of all recent ones often a few, so they are stored by themselves."""
        return self._of_the_date("window_orders", lambda: self._keep(
            self.recent_orders.filter(F.col("OrderDate") < self.cur)))

    @cached_property
    def recent_lines(self) -> DataFrame:
        """Order lines of recent orders, with the order's customer and salesperson.

        Read by about eight stage queries; stored once per run instead of
        re-joining lines and orders each time.  With a run date of today this
        is about one month of lines, a small slice of the table.
        """
        def build():
            return self._keep(self._lines_with(self.recent_orders))
        return self._of_the_date("recent_lines", build)

    def _lines_with(self, orders: DataFrame) -> DataFrame:
        """The lines of some recent orders, with the order's customer and salesperson."""
        lines = self.m.since(self.m.order_details, self.p.previous_month).drop(ORDER_MONTH)
        return lines.join(orders.select("OrderId", "CustomerId", "SalesPersonId", "OrderDate"), "OrderId", "inner")

    def _recent_lines_where(self, key: str, keys: DataFrame) -> DataFrame:
        """The recent lines whose ``key`` (OrderId or CustomerId) is among a few ``keys``.

        From all recent lines where those are stored, else by a look for the lines
        of these orders, which are stored first: a join learns how few they are.
        """
        if self.facts is None or self._dated("recent_lines") in self.facts:
            return self.recent_lines.join(keys, key, "left_semi")
        return self._lines_with(self._keep(self.recent_orders.join(keys, key, "left_semi")))

    @cached_property
    def window_lines(self) -> DataFrame:
        """The recent lines of the run window's orders, which the staging rows are of: a small part of all recent ones."""
        def build():
            return self._keep(self._recent_lines_where("OrderId", self.window_orders.select("OrderId")))
        return self._of_the_date("window_lines", build)

    @cached_property
    def recent_sales(self) -> DataFrame:
        """The recent lines with their product's category and supplier (inner join), for the reports by those.

        Stored once per run: beyond the size that a broadcast takes, each join of
        the lines with the products shuffles all of them.
        """
        def build():
            products = self.m.products.select("ProductId", "CategoryId", "SupplierId")
            return self._keep(self.recent_lines.drop("OrderDate").join(products, "ProductId", "inner"))
        return self._of_the_date("recent_sales", build)

    @cached_property
    def dept_tree(self) -> DataFrame:
        """DepartmentIds reachable from a root (bounded dimension), stored once per run
        so the recursion is not re-run inside every query that filters on it."""
        return self._shared("dept_tree", lambda: self._keep(
            metrics.department_hierarchy(self.m, self.p).select("DepartmentId")))

    @cached_property
    def order_totals(self) -> DataFrame:
        """Per-order gross/net sums over all lines: read by the tier and value rules, stored once."""
        if self.m.history is not None:
            return self.m.history.order_totals()
        return self._order_sums.select("OrderId", "net_sum", "gross_sum", "line_count")

    @cached_property
    def _order_sums(self) -> DataFrame:
        return self._shared("order_totals", lambda: self._keep(metrics.order_totals(self.m)))

    @cached_property
    def shipped_orders(self) -> DataFrame:
        """Orders with ShippedDate; where the model makes that of the lines, it comes from the stored sums per order."""
        m = self.m
        return m.orders_with_shipping if m.shipped_lines is None else m.with_shipping(self._order_sums)

    @cached_property
    def regional_totals(self) -> DataFrame:
        """TotalSales per region over all orders, from the kept months or the stored per-order totals."""
        if self.m.history is not None:
            spent = self.m.history.customers().join(self.m.customers.select("CustomerId", "RegionId"), "CustomerId", "inner")
            per = spent.groupBy("RegionId").agg(F.sum("net_sum").cast("decimal(38,4)").alias("TotalSales"))
            return self._keep(self.m.regions.select("RegionId").join(per, "RegionId", "left"))
        return self._shared("regional_totals", lambda: self._keep(
            metrics.regional_sales_summary(self.m, self.p, self.order_totals).select("RegionId", "TotalSales")))

    @cached_property
    def category_avg_stock(self) -> DataFrame:
        """Average UnitsInStock per category (double, like AVG over the products)."""
        return self.m.products.groupBy("CategoryId").agg(F.avg("UnitsInStock").alias("cat_avg_stock"))

    def _product_history(self) -> DataFrame | None:
        """(ProductId, g) over all months, if they are kept."""
        if self.m.history is None:
            return None
        return self.m.history.products().select("ProductId", F.col("gross_sum").alias("g"))

    @cached_property
    def top_category_ids(self) -> DataFrame:
        """CategoryIds whose name is among the top 5 by gross sales (at most 5 names).

        Ranking needs every order line, so the few ids are stored once per run.
        """
        def build():
            names = metrics.top_categories(
                self.m, self.p, per_product=self._product_history()).select("CategoryName")
            return self._keep(self.m.categories.join(F.broadcast(names), "CategoryName", "left_semi")
                              .select("CategoryId"))
        return self._shared("top_category_ids", build)

    # ------------------------------------------------------------ Q7-Q10
    def order_amount_in_top_categories(self, orders: DataFrame | None = None) -> DataFrame:
        """Q7: per order, net value of its lines whose product is in a top-5 category (NULL if none)."""
        o = (orders if orders is not None else self.window_orders).select("OrderId")
        # the run window's lines are among the stored recent ones
        lines = (self.m.order_details if orders is not None else self.window_lines).join(o, "OrderId", "left_semi")
        top = F.broadcast(self.top_category_ids.withColumn("in_top", F.lit(True)))
        prod = self.m.products.select("ProductId", "CategoryId").join(top, "CategoryId", "left")
        per = (lines.join(prod, "ProductId", "inner")
               .groupBy("OrderId")
               .agg(sum_net(lines, F.col("in_top")).alias("Amount")))
        return o.join(per, "OrderId", "left").select(
            "OrderId", F.col("Amount").cast("decimal(38,4)").alias("Amount"))

    @cached_property
    def window_orders_per_customer(self) -> DataFrame:
        """Orders per customer in [@PreviousMonth, @CurrentDate): one aggregate, stored per run."""
        return self._of_the_date("window_orders_per_customer", lambda: self._keep(
            self.window_orders.groupBy("CustomerId").agg(F.count(F.lit(1)).alias("RecentOrders"))))

    def customer_tier_frame(self, customers: DataFrame) -> DataFrame:
        """Q8 core: VIP / Premium / Standard for the given CustomerIds.

        VIP: more than 10 orders in [@PreviousMonth, @CurrentDate); Premium:
        average gross line over all the customer's orders above 1000 (compared
        exactly as sum > 1000 * count); else Standard.
        """
        cust = customers.select("CustomerId").distinct()
        if self.m.history is not None:
            gross = self.m.history.customers().select("CustomerId", F.col("gross_sum").alias("g"), F.col("line_count").alias("n"))
        else:
            # stored, so that the join learns how few they are and needn't move all totals
            o = self._keep(self.m.orders.select("OrderId", "CustomerId").join(cust, "CustomerId", "left_semi"))
            totals = self.order_totals.select("OrderId", "gross_sum", "line_count")
            gross = (o.join(totals, "OrderId", "inner").groupBy("CustomerId")
                     .agg(F.sum("gross_sum").alias("g"), F.sum("line_count").alias("n")))
        j = cust.join(self.window_orders_per_customer, "CustomerId", "left").join(gross, "CustomerId", "left")
        recent = F.coalesce(F.col("RecentOrders"), F.lit(0))
        return j.select(
            "CustomerId",
            recent.alias("RecentOrders"),
            metrics.avg_from_parts(F.col("g"), F.col("n"), scale=2).alias("AvgGrossLine"),
            tier((recent > 10, L.VIP), (F.col("g") > F.col("n") * 1000, L.PREMIUM),
                 default=L.STANDARD).alias("Tier"))

    def customer_tier(self) -> DataFrame:
        """Q8: tier of every active customer with an order in the run window."""
        active = self.m.customers.filter(F.col("IsActive") == 1).select("CustomerId")
        with_orders = active.join(self.window_orders_per_customer.select("CustomerId"), "CustomerId", "left_semi")
        return self.customer_tier_frame(with_orders)

    def low_stock_products(self) -> DataFrame:
        """Products whose UnitsInStock is below their category's average."""
        avg = self.category_avg_stock
        return (self.m.products.select("ProductId", "CategoryId", "UnitsInStock")
                .join(avg, "CategoryId", "inner")
                .filter(F.col("UnitsInStock") < F.col("cat_avg_stock")).select("ProductId"))

    def low_stock_orders(self, orders: DataFrame | None = None) -> DataFrame:
        """Q9: orders holding at least one low-stock product (EXISTS → semi join)."""
        o = orders if orders is not None else self.m.orders
        lines = self.m.order_details.select("OrderId", "ProductId").join(
            self.low_stock_products(), "ProductId", "left_semi")
        return o.join(lines, "OrderId", "left_semi").select("OrderId", "CustomerId", "OrderDate")

    def uncancelled_orders(self, orders: DataFrame | None = None) -> DataFrame:
        """Q10: orders with no cancellation dated on/after @PreviousMonth (NOT EXISTS → anti join)."""
        o = orders if orders is not None else self.m.orders
        recent_cancel = self.m.order_cancellations.filter(F.col("CancellationDate") >= self.prev)
        return o.join(recent_cancel, "OrderId", "left_anti").select("OrderId", "CustomerId", "OrderDate")

    # ------------------------------------------------------------ Q11 stage 1
    @cached_property
    def tpd1(self) -> DataFrame:
        """Q11: the staging rows, one per order line of a qualifying window order.

        The procedure's CTEs appear only as join partners on their key, so
        each becomes an existence test on its base table: CustomerAnalysis =
        active customer, EmployeePerformance = active employee,
        DepartmentHierarchy = department in the tree, RegionalSalesSummary =
        existing region, ProductSalesMetrics/Products/Categories/Suppliers =
        product with existing category and supplier.
        """
        m, p = self.m, self.p
        cust = (m.customers.filter(F.col("IsActive") == 1)
                .join(m.regions.select("RegionId"), "RegionId", "left_semi")
                .select("CustomerId"))
        emp = (m.employees.filter(F.col("IsActive") == 1)
               .join(self.dept_tree, "DepartmentId", "left_semi")
               .filter(optional_eq("DepartmentId", p.department_id)
                       & optional_eq("EmployeeId", p.employee_id))
               .select(F.col("EmployeeId"), F.col("EmployeeId").alias("SalesPersonId"), "DepartmentId"))
        recent_cancel = (m.order_cancellations.filter(F.col("CancellationDate") >= self.prev)
                         .select("OrderId"))
        orders = (self.window_orders.select("OrderId", "CustomerId", "SalesPersonId")
                  .join(cust, "CustomerId", "left_semi")
                  .join(emp, "SalesPersonId", "inner")
                  .join(recent_cancel, "OrderId", "left_anti"))
        orders = self._keep(orders)  # a month's orders: read by the lines, the totals and the rows
        win_lines = (self.window_lines.select("OrderId", "ProductId", "Quantity", "UnitPrice", "Discount")
                     .join(orders.select("OrderId"), "OrderId", "left_semi"))
        # One aggregate per order gives both the top-5 amount and the low-stock test.
        top = F.broadcast(self.top_category_ids.withColumn("in_top", F.lit(True)))
        prod_info = (m.products.select("ProductId", "CategoryId", "UnitsInStock")
                     .join(self.category_avg_stock, "CategoryId", "left")
                     .join(top, "CategoryId", "left")
                     .select("ProductId", F.coalesce(F.col("in_top"), F.lit(False)).alias("in_top"),
                             F.coalesce(F.col("UnitsInStock") < F.col("cat_avg_stock"), F.lit(False))
                             .alias("is_low")))
        per_order = (win_lines.join(prod_info, "ProductId", "inner").groupBy("OrderId")
                     .agg(sum_net(win_lines, F.col("in_top")).alias("Amount"),
                          F.max(F.col("is_low").cast("int")).alias("has_low"))
                     .filter(F.col("has_low") == 1))
        valid_products = (m.products.select("ProductId", "CategoryId", "SupplierId")
                          .join(m.categories.select("CategoryId"), "CategoryId", "left_semi")
                          .join(m.suppliers, "SupplierId", "left_semi").select("ProductId"))
        kept = self._keep(orders.join(per_order, "OrderId", "inner"))
        status = self.customer_tier_frame(kept.select("CustomerId")).select("CustomerId", "Tier")
        rows = (win_lines.select("OrderId", "ProductId")
                .join(valid_products, "ProductId", "left_semi")
                .join(kept, "OrderId", "inner")
                .join(status, "CustomerId", "left"))
        filled = rows.select(
            "CustomerId", "OrderId", "ProductId", "EmployeeId", "DepartmentId",
            F.col("Amount").cast("decimal(18,2)").alias("Amount"),
            F.col("Tier").alias("Status"),
            self.cur.alias("ProcessDate"),
            F.lit(0).alias("IsProcessed"),
            F.lit(None).cast("string").alias("ErrorMessage"))

        def counted(placed: DataFrame) -> DataFrame:
            # behind the range exchange: the look at the rows that finds its bounds isn't observed
            return self._keep(placed.observe(self.stage1_rows, F.count(F.lit(1)).alias("rows")))

        return self._keep(identity_ids(filled, [F.col(c).asc() for c in TPD_KEYS], store=counted if self.run else None))

    # ------------------------------------------------------------ Q12-Q13 stage 2
    def discount_factor(self) -> DataFrame:
        """Per customer: 1 + (sum of active discount percents)/100 (customers with none: 1)."""
        d = self.m.discounts.filter((F.col("StartDate") <= self.cur) & (F.col("EndDate") >= self.cur)
                                    & (F.col("IsActive") == 1))
        return d.groupBy("CustomerId").agg(F.sum("DiscountPercent").alias("pct_sum"))

    def repriced_amount(self, tpd: DataFrame) -> DataFrame:
        """Q12: Amount = net of the row's (order, product) lines x discount factor, as DECIMAL(18,2)."""
        pairs = tpd.select("OrderId", "ProductId")
        # the rows to re-price belong to orders of the window
        pair_net = (self.window_lines.join(pairs, ["OrderId", "ProductId"], "left_semi")
                    .groupBy("OrderId", "ProductId").agg(sum_net(self.window_lines).alias("pair_net")))
        j = tpd.join(pair_net, ["OrderId", "ProductId"], "left").join(self.discount_factor(), "CustomerId", "left")
        factor = percent_factor(F.col("pct_sum")).cast("decimal(9,4)")
        return j.withColumn("NewAmount", (F.col("pair_net").cast("decimal(18,4)") * factor).cast("decimal(18,2)"))

    def value_status(self, tpd: DataFrame) -> DataFrame:
        """Q13: High Value / Above Average / Standard for each staging row.

        High Value: the customer's distinct orders (all time) exceed 1.5 x the
        mean orders per ordering customer of the customer's region.  Above
        Average: the order's gross value exceeds the 75th percentile of gross
        value over all orders.
        """
        m = self.m
        if m.history is not None:
            per_cust = m.history.customers().select("CustomerId", F.col("orders").alias("cust_orders"))
        else:
            per_cust = m.orders.groupBy("CustomerId").agg(F.count(F.lit(1)).alias("cust_orders"))
        c = m.customers.select("CustomerId", "RegionId")
        region_mean = (per_cust.join(c, "CustomerId", "inner").groupBy("RegionId")
                       .agg(F.avg(F.col("cust_orders").cast("double")).alias("region_mean")))
        totals = self.order_totals.select("OrderId", "gross_sum")
        p75 = percentile_cont(totals, "gross_sum", 0.75)
        totals = totals.join(tpd.select("OrderId"), "OrderId", "left_semi")  # a staged table is small beside all totals
        j = (tpd.join(per_cust, "CustomerId", "left")
             .join(c.withColumnRenamed("RegionId", "cust_region"), "CustomerId", "left")
             .join(region_mean, F.col("cust_region") == F.col("RegionId"), "left")
             .join(totals, "OrderId", "left"))
        p75_col = F.lit(p75).cast("double")
        return j.withColumn("NewStatus", tier(
            (F.coalesce(F.col("cust_orders"), F.lit(0)) > F.col("region_mean") * 1.5, L.HIGH_VALUE),
            (F.col("gross_sum") > p75_col, L.ABOVE_AVERAGE),
            default=L.STANDARD))

    def _recent_ids(self, tpd: DataFrame) -> DataFrame:
        """The recent orders' OrderIds that staging rows have, stored: of all recent orders they are a few."""
        return self._keep(self.recent_orders.select("OrderId").join(tpd.select("OrderId"), "OrderId", "left_semi"))

    @cached_property
    def tpd2(self) -> DataFrame:
        """#TempProcessingData after stage 2 (rows with IsProcessed = 0 and a recent order)."""
        t = self.tpd1
        recent = self._recent_ids(t)
        target = t.join(recent, "OrderId", "left_semi").filter(F.col("IsProcessed") == 0)
        rest = t.join(recent, "OrderId", "left_anti").unionByName(t.filter(F.col("IsProcessed") != 0)
                                                                  .join(recent, "OrderId", "left_semi"))
        upd = self.value_status(self.repriced_amount(target))
        upd = upd.select(*[F.col("NewAmount").alias("Amount") if c == "Amount"
                           else F.col("NewStatus").alias("Status") if c == "Status"
                           else F.col(c) for c in STAGED])
        return self._keep(upd.unionByName(rest.select(*STAGED)))

    # ------------------------------------------------------------ Q14 stage 3
    @cached_property
    def summary_table(self) -> DataFrame:
        """CustomerOrderSummary as it is before this run (read once per run)."""
        return self._keep(self.m.customer_order_summary(self.p))

    def merge_source(self, tpd: DataFrame) -> DataFrame:
        """Per (customer, department) summary of unprocessed staging rows."""
        t = tpd.filter(F.col("IsProcessed") == 0)
        return t.groupBy("CustomerId", "DepartmentId").agg(
            F.count_distinct("OrderId").alias("OrderCount"),
            F.sum("Amount").cast("decimal(18,2)").alias("TotalAmount"),
            F.avg("Amount").cast("decimal(18,6)").alias("AvgAmount"),
            F.max("ProcessDate").alias("LastProcessDate"),
            F.min("ProcessDate").alias("FirstProcessDate"),
            F.count_distinct("ProductId").alias("ProductCount"),
            F.count_distinct("EmployeeId").alias("EmployeeCount"),
            sorted_list(F.collect_set("Status")).alias("StatusList"))

    # ------------------------------------------------------------ Q16 stage 5
    def sales_performance_report(self, existing: DataFrame | None = None) -> DataFrame:
        """Q16: report rows per (department, employee, customer, region) not yet reported today.

        As written, each staging row is joined again with all lines of its
        order, so sums count an order once per staging row of that order.
        That fan-out is reproduced with per-order totals multiplied by the
        number of staging rows of the order, without pairing lines.
        """
        m = self.m
        t = self.tpd2.filter((F.col("IsProcessed") == 0) & (F.col("ProcessDate") >= self.prev))
        active_cust = (m.customers.filter(F.col("IsActive") == 1)
                       .join(m.regions.select("RegionId"), "RegionId", "left_semi")
                       .select("CustomerId", "RegionId"))
        emp = (m.employees.filter(F.col("IsActive") == 1)
               .join(self.dept_tree, "DepartmentId", "left_semi")
               .select("EmployeeId", F.col("DepartmentId").alias("EmpDepartmentId")))
        ship = m.shippers
        o = (m.orders.select("OrderId", "ShipVia")
             .join(ship, F.col("ShipVia") == F.col("ShipperId"), "left_semi").select("OrderId"))
        rows = (t.select("CustomerId", "OrderId", "EmployeeId")
                .join(active_cust, "CustomerId", "inner")
                .join(emp, "EmployeeId", "inner")
                .join(o, "OrderId", "left_semi"))
        keys = ["EmpDepartmentId", "EmployeeId", "CustomerId", "RegionId"]
        mult = rows.groupBy(*keys, "OrderId").agg(F.count(F.lit(1)).alias("mult"))
        prod = (m.products.select("ProductId", "CategoryId", "SupplierId")
                .join(m.categories.select("CategoryId"), "CategoryId", "left_semi")
                .join(m.suppliers, "SupplierId", "left_semi"))
        # each line of a staged order, once per (report key, order), weighted by the
        # number of staging rows of that order: one aggregate gives sums and distinct counts
        lines = (self.window_lines.select("OrderId", "ProductId", "Quantity", "UnitPrice", "Discount")
                 .join(mult, "OrderId", "inner")
                 .join(prod, "ProductId", "inner"))
        # level by level, so that every distinct count is a count of rows: orders, then products, each of
        # which has one category and one supplier
        per_product = lines.groupBy(*keys, "ProductId", "CategoryId", "SupplierId").agg(
            F.sum(net_amount() * F.col("mult")).alias("s"), F.sum("mult").alias("n"))
        per_supplier = per_product.groupBy(*keys, "CategoryId", "SupplierId").agg(
            F.sum("s").alias("s"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
        per_category = per_supplier.groupBy(*keys, "CategoryId").agg(
            F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("k").alias("k"))
        suppliers = (per_supplier.groupBy(*keys, "SupplierId").agg(F.lit(1).alias("one"))
                     .groupBy(*keys).agg(F.count(F.lit(1)).alias("SupplierCount")))
        orders = (lines.groupBy(*keys, "OrderId").agg(F.lit(1).alias("one"))
                  .groupBy(*keys).agg(F.count(F.lit(1)).alias("OrderCount")))
        agg = (per_category.groupBy(*keys).agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("k").alias("ProductCount"),
                                               F.count(F.lit(1)).alias("CategoryCount"))
               .join(suppliers, keys).join(orders, keys))
        # read by the percentile and the mean: stored once per run
        per_pair = self._keep(self.recent_lines.groupBy("SalesPersonId", "CustomerId")
                              .agg(sum_net(self.recent_lines).alias("pair_sales")))
        p90 = percentile_cont(per_pair, "pair_sales", 0.9)
        mean = per_pair.select(F.avg("pair_sales").alias("m")).scalar()
        total = F.col("s").cast("decimal(38,4)")
        out = agg.select(
            self.cur.alias("ReportDate"),
            F.col("EmpDepartmentId").alias("DepartmentId"), "EmployeeId", "CustomerId",
            "OrderCount", total.alias("TotalSales"),
            metrics.avg_from_parts(F.col("s"), F.col("n")).alias("AvgOrderValue"),
            "ProductCount", "CategoryCount", "SupplierCount", "RegionId",
            tier((total.cast("double") > F.lit(p90).cast("double"), L.TOP_PERFORMER),
                 (total.cast("double") > mean.cast("double"), L.ABOVE_AVERAGE),
                 default=L.STANDARD).alias("Status"),
            self.cur.alias("CreatedDate"), F.lit(self.p.run_user).alias("CreatedBy"))
        if existing is not None:
            today = existing.filter(F.col("ReportDate") == self.cur)
            out = append_if_absent(out, today, ["DepartmentId", "EmployeeId", "CustomerId"])
        return out

    # ------------------------------------------------------------ Q17 stage 6
    def aggregated_department_employee(self) -> DataFrame:
        return self.temp_aggregated_data

    @cached_property
    def temp_aggregated_data(self) -> DataFrame:
        """Q17: #TempAggregatedData — totals per (department, employee) above the median.

        Rows of customers in a region whose TotalSales beats the regional
        mean; each staging row counts once per line of its order (fan-out as
        written).  HAVING compares with the median of per-(department,
        employee) totals over all unprocessed staging rows.
        """
        m = self.m
        t = self.tpd2.filter(F.col("IsProcessed") == 0)
        rss = self.regional_totals
        good_regions = rss.filter(F.col("TotalSales") > rss.select(F.avg("TotalSales")).scalar()).select("RegionId")
        cust = m.customers.select("CustomerId", "RegionId").join(good_regions, "RegionId", "left_semi")
        emp = (m.employees.filter(F.col("IsActive") == 1)
               .join(self.dept_tree, "DepartmentId", "left_semi")
               .select("EmployeeId", F.col("DepartmentId").alias("EmpDepartmentId")))
        prod = (m.products.select("ProductId", "CategoryId")
                .join(m.categories.select("CategoryId"), "CategoryId", "left_semi"))
        rows = (t.select("CustomerId", "OrderId", "EmployeeId", "Amount")
                .join(cust.select("CustomerId"), "CustomerId", "left_semi")
                .join(emp, "EmployeeId", "inner")
                .join(m.orders.select("OrderId"), "OrderId", "left_semi"))
        lines_per_order = (self.window_lines.join(rows.select("OrderId").distinct(), "OrderId", "left_semi")
                           .join(prod, "ProductId", "left_semi")
                           .groupBy("OrderId").agg(F.count(F.lit(1)).alias("n")))
        fan = rows.join(lines_per_order, "OrderId", "inner")
        g = fan.groupBy("EmpDepartmentId", "EmployeeId").agg(
            F.sum(F.col("Amount") * F.col("n")).alias("s"),
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("Amount").isNotNull(), F.col("n"))).alias("n_amount"),
            F.max("Amount").alias("MaxAmount"), F.min("Amount").alias("MinAmount"))
        median_src = self._keep(self.tpd2.groupBy("DepartmentId", "EmployeeId").agg(F.sum("Amount").alias("tot")))
        median = percentile_cont(median_src, "tot", 0.5)
        g = g.filter(F.col("s").cast("double") > F.lit(median).cast("double"))
        return self._keep(g.select(
            F.col("EmpDepartmentId").alias("DepartmentId"), "EmployeeId",
            F.col("s").cast("decimal(18,2)").alias("TotalAmount"),
            F.col("n").cast("int").alias("RecordCount"),
            (F.col("s").cast("decimal(24,2)") / F.nullif(F.col("n_amount"), F.lit(0)).cast("decimal(20,0)"))
            .cast("decimal(18,2)").alias("AverageAmount"),
            F.col("MaxAmount").cast("decimal(18,2)").alias("MaxAmount"),
            F.col("MinAmount").cast("decimal(18,2)").alias("MinAmount")))

    # ------------------------------------------------------------ Q18-Q20 stages 7-8
    def _with_validations(self, tpd: DataFrame) -> DataFrame:
        """Adds both validation outcomes as columns of the unprocessed staging rows."""
        m = self.m
        order_max = (self.window_lines.join(tpd.select("OrderId"), "OrderId", "left_semi")
                     .groupBy("OrderId").agg(F.max(net_amount()).alias("max_line")))
        spent = self._recent_lines_where("CustomerId", tpd.select("CustomerId"))
        spend = spent.groupBy("CustomerId").agg(sum_net(spent).alias("recent_spend"))
        cust = m.customers.select("CustomerId", "IsActive", "CreditLimit")
        recent = self._recent_ids(tpd).withColumn("recent_order", F.lit(True))
        j = (tpd.join(order_max, "OrderId", "left").join(spend, "CustomerId", "left")
             .join(cust, "CustomerId", "left").join(recent, "OrderId", "left"))
        return j.select(*STAGED, *[c for r in self.rules() for c in (
            F.coalesce(r.applies, F.lit(False)).alias(f"has_{r.key}_check"),
            F.when(r.valid, 1).otherwise(0).alias(f"{r.key}_valid"), r.message.alias(f"{r.key}_msg"))])

    def rules(self) -> list[Rule]:
        """Stage 7's validations, in the order in which their messages are listed."""
        amt, cap = F.col("Amount"), F.col("max_line") * _dec("1.1")
        active = F.col("IsActive") == 1
        return [
            Rule("amount", L.AMOUNT_VALIDATION, F.col("recent_order"), (amt > 0) & (amt <= cap),
                 F.when(amt <= 0, L.AMOUNT_NOT_POSITIVE).when(amt > cap, L.AMOUNT_TOO_HIGH).otherwise(L.VALID)),
            Rule("customer", L.CUSTOMER_VALIDATION, F.lit(True),
                 active & (F.col("CreditLimit") >= F.col("recent_spend")),
                 F.when(~F.coalesce(active, F.lit(False)), L.CUSTOMER_INACTIVE)
                 .when(F.col("CreditLimit") < F.col("recent_spend"), L.CREDIT_EXCEEDED).otherwise(L.VALID)),
        ]

    @cached_property
    def validated(self) -> DataFrame:
        """Unprocessed staging rows with the outcome of every rule, stored once per run."""
        return self._keep(self._with_validations(self.tpd2.filter(F.col("IsProcessed") == 0)))

    @cached_property
    def validations(self) -> DataFrame:
        """#TempValidationResults: a row for each staging row (RecordId) and rule that looks at it; RuleNo orders them."""
        outcomes = F.array(*[F.when(F.col(f"has_{r.key}_check"), F.struct(
            F.lit(i).alias("RuleNo"), F.lit(r.kind).alias("ValidationType"), F.col(f"{r.key}_valid").alias("IsValid"),
            F.col(f"{r.key}_msg").alias("ValidationMessage"))) for i, r in enumerate(self.rules())])
        rows = self.validated.select(F.col("Id").alias("RecordId"), *TPD_KEYS, F.explode(outcomes).alias("tvr"))
        return self._keep(rows.filter("tvr IS NOT NULL").select("RecordId", *TPD_KEYS, "tvr.*"))

    def failed_validations(self) -> DataFrame:
        """`tvr WHERE tvr.IsValid = 0`."""
        return self.validations.filter(F.col("IsValid") == 0)

    def validation_results(self) -> DataFrame:
        """Q18+Q19: #TempValidationResults rows."""
        return self.validations.select("RecordId", *TPD_KEYS, "ValidationType", "IsValid", "ValidationMessage")

    def _results_of(self, kind: str) -> DataFrame:
        return self.validation_results().filter(F.col("ValidationType") == kind).drop("RecordId")

    def validate_amount(self) -> DataFrame:
        return self._results_of(L.AMOUNT_VALIDATION)

    def validate_customer(self) -> DataFrame:
        return self._results_of(L.CUSTOMER_VALIDATION)

    @cached_property
    def tpd3(self) -> DataFrame:
        """Q20: stage 8 — IsProcessed = 1, final Status and the messages of all rules that failed, by record id."""
        unprocessed = self.tpd2.filter(F.col("IsProcessed") == 0)
        existing = self.m.orders.select("OrderId")
        # the messages of a record, at most one for each rule, in the rules' order
        failed = self.failed_validations().groupBy(F.col("RecordId").alias("Id")).agg(
            F.count(F.lit(1)).cast("int").alias("failures"),
            F.expr(f"listagg(ValidationMessage, '{L.MESSAGE_SEPARATOR}') WITHIN GROUP (ORDER BY RuleNo)").alias("messages"))
        v = unprocessed.join(existing, "OrderId", "left_semi").join(failed, "Id", "left")
        status = (F.when(F.col("failures") > 0, L.VALIDATION_FAILED)
                  .when(F.col("Amount").isNull() | (F.col("Amount") <= 0), L.INVALID_AMOUNT)
                  .otherwise(L.PROCESSED))
        done = v.select(*[status.alias("Status") if c == "Status"
                          else F.lit(1).alias("IsProcessed") if c == "IsProcessed"
                          else F.col("messages").alias("ErrorMessage") if c == "ErrorMessage"
                          else F.col(c) for c in STAGED],
                        F.coalesce(F.col("failures"), F.lit(0)).alias("invalid_count"))
        untouched = (unprocessed.join(existing, "OrderId", "left_anti")
                     .unionByName(self.tpd2.filter(F.col("IsProcessed") != 0))
                     .withColumn("invalid_count", F.lit(0)))
        return self._keep(done.unionByName(untouched))

    def finalize_status(self) -> DataFrame:
        return self.tpd3.select(*TPD_COLUMNS)

    # ------------------------------------------------------------ Q21-Q24 stages 9-10
    @staticmethod
    def _counts(df: DataFrame, columns: dict[str, Column]) -> Column:
        """Distinct counts as the fields of one scalar subquery, however many of them are used."""
        return distinct_counts(df, columns).select(F.struct(*columns)).scalar()

    def _people(self, tpd: DataFrame) -> Column:
        return self._counts(tpd, {"DepartmentCount": F.col("DepartmentId"), "EmployeeCount": F.col("EmployeeId"),
                                  "CustomerCount": F.col("CustomerId")})

    def execution_log(self) -> DataFrame:
        """Q21: one ProcessExecutionLog row (LEFT JOIN to invalid validations fans out)."""
        t = self.tpd3.filter(F.col("IsProcessed") == 1)
        w = F.greatest(F.col("invalid_count"), F.lit(1))   # rows after the left join
        failed = F.col("Status") != L.PROCESSED
        agg = t.agg(
            F.sum(w).alias("RecordsProcessed"),
            F.sum(F.when(F.col("Status") == L.PROCESSED, w).otherwise(0)).alias("RecordsSucceeded"),
            F.sum(F.when(failed, w).otherwise(0)).alias("RecordsFailed"),
            F.sum(F.col("Amount") * w).alias("s"),
            F.sum(F.when(F.col("Amount").isNotNull(), w)).alias("n"),
            F.sum(F.when(F.col("invalid_count") > 0, 1).otherwise(0)).alias("ErrorCount"))
        people = self._people(t)
        return agg.select(
            F.lit(self.p.run_id).alias("ProcessId"), F.lit(L.PROCESS_NAME).alias("ProcessName"),
            self.cur.alias("StartTime"), self.cur.alias("EndTime"),
            F.coalesce(F.col("RecordsProcessed"), F.lit(0)).cast("long").alias("RecordsProcessed"),
            F.col("RecordsSucceeded").cast("long").alias("RecordsSucceeded"),
            F.col("RecordsFailed").cast("long").alias("RecordsFailed"),
            F.col("s").cast("decimal(38,2)").alias("TotalAmount"),
            metrics.avg_from_parts(F.col("s"), F.col("n"), scale=2).alias("AverageAmount"),
            *[people[c].alias(c) for c in ("DepartmentCount", "EmployeeCount", "CustomerCount")],
            F.coalesce(F.col("ErrorCount"), F.lit(0)).cast("long").alias("ErrorCount"),
            tier((F.col("RecordsFailed") == 0, L.SUCCESS),
                 (F.col("RecordsFailed") < F.col("RecordsProcessed") * _dec("0.1"), L.PARTIAL_SUCCESS),
                 default=L.FAILED).alias("Status"))

    def processing_summary(self) -> DataFrame:
        """Q22: totals over all staging rows after stage 8."""
        t = self.tpd3
        return t.agg(
            F.lit(L.PROCESSING_SUMMARY).alias("InfoType"),
            F.count(F.lit(1)).alias("TotalRecords"),
            count_when(F.col("IsProcessed") == 1).cast("long").alias("ProcessedRecords"),
            count_when(F.col("IsProcessed") == 0).cast("long").alias("UnprocessedRecords"),
            F.sum("Amount").cast("decimal(38,2)").alias("TotalAmount"),
            F.avg("Amount").cast("decimal(38,6)").alias("AverageAmount"),
            F.min("Amount").alias("MinAmount"), F.max("Amount").alias("MaxAmount"))

    def department_summary(self) -> DataFrame:
        """Q23: per department line of #TempAggregatedData, sorted by amount."""
        tad = self.aggregated_department_employee()
        return (tad.groupBy("DepartmentId", "TotalAmount", "RecordCount", "AverageAmount")
                .agg(F.count_distinct("EmployeeId").alias("EmployeeCount"))
                .select(F.lit(L.DEPARTMENT_SUMMARY).alias("InfoType"), "DepartmentId", "EmployeeCount",
                        "TotalAmount", "RecordCount", "AverageAmount")
                .orderBy(F.col("TotalAmount").desc()))

    def validation_summary(self) -> DataFrame:
        """Q24: valid / invalid counts per validation type."""
        v = self.validation_results()
        return v.groupBy("ValidationType").agg(
            F.count(F.lit(1)).alias("TotalValidations"),
            count_when(F.col("IsValid") == 1).cast("long").alias("ValidCount"),
            count_when(F.col("IsValid") == 0).cast("long").alias("InvalidCount"),
        ).select(F.lit(L.VALIDATION_RESULTS).alias("InfoType"), "ValidationType", "TotalValidations",
                 "ValidCount", "InvalidCount")

    # ------------------------------------------------------------ Q25-Q30 stage 11
    @cached_property
    def complex_transformation(self) -> DataFrame:
        """ComplexDataTransformation: SimilarOrderCount and RegionalCategoryAverage per processed row."""
        m, lines = self.m, self.recent_sales  # all recent lines are read, so the staging takes its own from them
        t = self.tpd3.filter(F.col("IsProcessed") == 1)
        known = m.categories.select("CategoryId")
        prod_cat = m.products.select("ProductId", "CategoryId").join(known, "CategoryId", "left_semi")
        prod_any = m.products.select("ProductId", "CategoryId")
        # a customer's orders in a category, with their lines' sum: read by both measures, stored once per run
        per = self._keep(lines.groupBy("CustomerId", "CategoryId", "OrderId")
                         .agg(sum_net(lines).alias("s"), F.count(F.lit(1)).alias("n"))
                         .groupBy("CustomerId", "CategoryId")
                         .agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("SimilarOrderCount")))
        # (customer, category) -> distinct recent orders touching the category
        similar = (per.join(known, "CategoryId", "left_semi")
                   .select("CustomerId", "CategoryId", "SimilarOrderCount"))
        # (region, category) -> average net line of recent orders of the region's customers
        cust = m.customers.select("CustomerId", "RegionId")
        regional = (per.join(cust, "CustomerId", "inner").groupBy("RegionId", "CategoryId")
                    .agg(F.sum("s").alias("s"), F.sum("n").alias("n")))
        regional = regional.select("RegionId", "CategoryId",
                                   metrics.avg_from_parts(F.col("s"), F.col("n")).alias("RegionalCategoryAverage"))
        row_cat = t.join(prod_cat.withColumnRenamed("CategoryId", "sim_cat"), "ProductId", "left")
        row_cat = row_cat.join(prod_any.withColumnRenamed("CategoryId", "own_cat")
                               .withColumnRenamed("ProductId", "pid2"),
                               F.col("ProductId") == F.col("pid2"), "left")
        row_cat = row_cat.join(cust.withColumnRenamed("RegionId", "own_region")
                               .withColumnRenamed("CustomerId", "cid2"),
                               F.col("CustomerId") == F.col("cid2"), "left")
        j = (row_cat
             .join(similar.withColumnRenamed("CustomerId", "s_cust").withColumnRenamed("CategoryId", "s_cat"),
                   (F.col("CustomerId") == F.col("s_cust")) & (F.col("sim_cat") == F.col("s_cat")), "left")
             .join(regional, (F.col("own_region") == F.col("RegionId")) & (F.col("own_cat") == F.col("CategoryId")),
                   "left"))
        return self._keep(j.select(*STAGED,
                                   F.coalesce(F.col("SimilarOrderCount"), F.lit(0)).alias("SimilarOrderCount"),
                                   "RegionalCategoryAverage"))

    def similar_order_count(self) -> DataFrame:
        """Q25."""
        return self.complex_transformation.select(*TPD_KEYS, "SimilarOrderCount")

    def regional_category_average(self) -> DataFrame:
        """Q26."""
        return self.complex_transformation.select(*TPD_KEYS, "RegionalCategoryAverage")

    @cached_property
    def tpd4(self) -> DataFrame:
        """Q29: stage-11 status reclassification of processed rows."""
        cdt = self.complex_transformation
        mean = cdt.select(F.avg(F.col("SimilarOrderCount").cast("double")).alias("m")).scalar()
        p75 = percentile_cont(cdt, "RegionalCategoryAverage", 0.75)
        status = tier((F.col("SimilarOrderCount") > mean * 1.2, L.HIGH_FREQUENCY),
                      (F.col("RegionalCategoryAverage").cast("double") > F.lit(p75).cast("double"),
                       L.ABOVE_REGIONAL_AVERAGE),
                      default=F.col("Status"))
        done = cdt.select(*[status.alias("Status") if c == "Status" else F.col(c) for c in STAGED])
        return self._keep(done.unionByName(self.tpd3.filter(F.col("IsProcessed") != 1).select(*STAGED)))

    def reclassify_status(self) -> DataFrame:
        return self.tpd4.select(*TPD_COLUMNS)

    @cached_property
    def employee_ranking(self) -> DataFrame:
        """Q27: SalesRank in department by recent net sales, and sales inside own top-3 categories."""
        m = self.m
        e = (m.employees.filter(F.col("IsActive") == 1)
             .join(m.departments.select("DepartmentId"), "DepartmentId", "left_semi")
             .select("EmployeeId", "DepartmentId", "EmployeeName"))
        recent = (self.recent_lines.groupBy("SalesPersonId")
                  .agg(sum_net(self.recent_lines).alias("recent_sales"))
                  .withColumnRenamed("SalesPersonId", "EmployeeId"))
        prod_cat = (m.products.select("ProductId", "CategoryId")
                    .join(m.categories.select("CategoryId"), "CategoryId", "left_semi"))
        key = ["SalesPersonId", "CategoryId"]
        if m.history is not None:
            sold = m.history.sellers().join(prod_cat, "ProductId", "inner").groupBy(*key).agg(F.sum("net_sum").alias("cat_sales"))
        else:
            all_lines = m.order_details.join(m.orders.select("OrderId", "SalesPersonId"), "OrderId", "inner")
            sold = (all_lines.join(prod_cat, "ProductId", "inner").groupBy(*key)
                    .agg(sum_net(all_lines).alias("cat_sales")))
        lately = (self.recent_sales.join(m.categories.select("CategoryId"), "CategoryId", "left_semi").groupBy(*key)
                  .agg(sum_net(self.recent_sales).alias("recent_cat_sales"), F.count(F.lit(1)).alias("recent_cat_lines")))
        emp_cat = sold.join(lately, key, "left")
        top3 = top_n_per_key(emp_cat, ["SalesPersonId"],
                             [F.col("cat_sales").desc(), F.col("CategoryId").asc()], 3)
        top_sales = (top3.groupBy(F.col("SalesPersonId").alias("EmployeeId"))
                     .agg(F.sum("recent_cat_sales").alias("TopCategorySales"),
                          F.sum("recent_cat_lines").alias("top_lines")))
        j = e.join(recent, "EmployeeId", "left").join(top_sales, "EmployeeId", "left")
        # few departments, possibly huge ones: a distributed row number instead of one sort per department
        ranked = row_number_by_range(j, ["DepartmentId"],
                                     [F.col("recent_sales").desc_nulls_last(), F.col("EmployeeId").asc()],
                                     col="SalesRank")
        return self._keep(ranked.select(
            "EmployeeId", "DepartmentId", "EmployeeName", "SalesRank",
            F.when(F.col("top_lines") > 0, F.col("TopCategorySales")).cast("decimal(38,4)")
            .alias("TopCategorySales")))

    @cached_property
    def customer_segmentation(self) -> DataFrame:
        """Q28: Platinum / Gold / Silver / Bronze per active customer, plus category list."""
        m = self.m
        c = m.customers.filter(F.col("IsActive") == 1).select("CustomerId", "CustomerName", "RegionId")
        lines = self.recent_lines
        # each feeds a threshold (percentile / mean) and the join: stored once per run
        spend = self._keep(lines.groupBy("CustomerId").agg(sum_net(lines).alias("spend")))
        orders_n = self._keep(self.recent_orders.groupBy("CustomerId")
                              .agg(F.count(F.lit(1)).alias("recent_orders")))
        prods_n = (self.recent_sales.groupBy("CustomerId")
                   .agg(F.count_distinct("ProductId").alias("recent_products")))
        cat_names = (self.recent_sales.select("CustomerId", "CategoryId").join(m.categories, "CategoryId", "inner")
                     .groupBy("CustomerId")
                     .agg(sorted_list(F.collect_set("CategoryName")).alias("PreferredCategories")))
        p90 = percentile_cont(spend, "spend", 0.9)
        mean_orders = orders_n.select(F.avg(F.col("recent_orders").cast("double"))).scalar()
        j = (c.join(spend, "CustomerId", "left").join(orders_n, "CustomerId", "left")
             .join(prods_n, "CustomerId", "left").join(cat_names, "CustomerId", "left"))
        seg = tier((F.col("spend").cast("double") > F.lit(p90).cast("double"), L.PLATINUM),
                   (F.coalesce(F.col("recent_orders"), F.lit(0)) > mean_orders * 1.5, L.GOLD),
                   (F.coalesce(F.col("recent_products"), F.lit(0)) > 10, L.SILVER),
                   default=L.BRONZE)
        return self._keep(j.select("CustomerId", "CustomerName", "RegionId", seg.alias("CustomerSegment"),
                                   "PreferredCategories"))

    def customer_segment_analysis(self, existing: DataFrame | None = None) -> DataFrame:
        """Q30: CustomerSegmentAnalysis rows: one per (customer, ranking of a recent salesperson)."""
        m = self.m
        cs = self.customer_segmentation
        # every per-customer order fact below comes from one (customer, salesperson)
        # count of recent orders; orders are unique, so distinct counts add up
        by_emp = self._keep(self.recent_orders.groupBy("CustomerId", "SalesPersonId")
                            .agg(F.count(F.lit(1)).alias("k")))
        e = m.employees.select(F.col("EmployeeId").alias("SalesPersonId"), "DepartmentId")
        er = self.employee_ranking.select(F.col("EmployeeId").alias("SalesPersonId"), "SalesRank",
                                          "TopCategorySales")
        pairs = (cs.select("CustomerId", "CustomerSegment", "PreferredCategories")
                 .join(by_emp.select("CustomerId", "SalesPersonId"), "CustomerId", "inner")
                 .join(e.select("SalesPersonId").withColumn("emp_found", F.lit(True)), "SalesPersonId", "left")
                 .join(er, "SalesPersonId", "left")
                 .select("CustomerId", "CustomerSegment", "PreferredCategories",
                         F.when(F.col("emp_found"), F.col("SalesRank")).alias("SalesRank"),
                         F.when(F.col("emp_found"), F.col("TopCategorySales")).alias("TopCategorySales"))
                 .distinct())
        cust_orders = by_emp.groupBy("CustomerId").agg(F.sum("k").alias("TotalOrders"))
        money = (self.recent_lines.groupBy("CustomerId")
                 .agg(sum_net(self.recent_lines).alias("s"), F.count(F.lit(1)).alias("n")))
        main_emp = top_n_per_key(by_emp, ["CustomerId"], [F.col("k").desc(), F.col("SalesPersonId").asc()], 1) \
            .select("CustomerId", F.col("SalesPersonId").alias("EmployeeId"))
        by_dept = (by_emp.join(e, "SalesPersonId", "inner")
                   .groupBy("CustomerId", "DepartmentId").agg(F.sum("k").alias("k")))
        main_dept = top_n_per_key(by_dept, ["CustomerId"], [F.col("k").desc(), F.col("DepartmentId").asc()], 1) \
            .select("CustomerId", "DepartmentId")
        j = (pairs.join(cust_orders, "CustomerId", "left").join(money, "CustomerId", "left")
             .join(main_emp, "CustomerId", "left").join(main_dept, "CustomerId", "left"))
        out = j.select(
            self.cur.alias("AnalysisDate"), "CustomerId", "CustomerSegment", "PreferredCategories",
            F.coalesce(F.col("TotalOrders"), F.lit(0)).cast("long").alias("TotalOrders"),
            F.col("s").cast("decimal(38,4)").alias("TotalSpent"),
            metrics.avg_from_parts(F.col("s"), F.col("n")).alias("AvgOrderValue"),
            "EmployeeId", "DepartmentId", "SalesRank", "TopCategorySales",
            self.cur.alias("CreatedDate"), F.lit(self.p.run_user).alias("CreatedBy"))
        if existing is not None:
            today = existing.filter(F.col("AnalysisDate") == self.cur)
            out = append_if_absent(out, today, ["CustomerId"])
        return out

    # ------------------------------------------------------------ Q33 stage 12
    @cached_property
    def department_metrics(self) -> DataFrame:
        """Q32 for this run (read by Q33 as well), stored once."""
        return self._keep(metrics.department_performance_metrics(self.m, self.p, self.order_totals))

    def department_performance_report(self, existing: DataFrame | None = None) -> DataFrame:
        """Q33: department report rows with target status, inserted if absent for the date."""
        dpm = self.department_metrics
        r = F.col("SalesToBudgetRatio")
        out = dpm.select(
            self.cur.alias("ReportDate"), "DepartmentId", "DepartmentName", "TotalBudget", "EmployeeCount",
            "TotalSales", "AvgOrderValue", "OrderCount", "CustomerCount", "SalesToBudgetRatio",
            tier((r >= 120, L.EXCEEDING_TARGET), (r >= 100, L.MEETING_TARGET), (r >= 80, L.NEAR_TARGET),
                 default=L.BELOW_TARGET).alias("Status"),
            self.cur.alias("CreatedDate"), F.lit(self.p.run_user).alias("CreatedBy"))
        if existing is not None:
            today = existing.filter(F.col("ReportDate") == self.cur)
            out = append_if_absent(out, today, ["DepartmentId"])
        return out

    # ------------------------------------------------------------ Q34 stage 13
    def order_line_flags(self, orders: DataFrame) -> DataFrame:
        """Per given order of the run window, from one pass over its lines: has_valid_line (a product whose
        category exists), has_discontinued (a discontinued product)."""
        m = self.m
        cats = m.categories.select("CategoryId").withColumn("cat_ok", F.lit(1))
        prod = (m.products.select("ProductId", "CategoryId", "Discontinued")
                .join(cats, "CategoryId", "left")
                .select("ProductId", F.coalesce(F.col("cat_ok"), F.lit(0)).alias("valid"),
                        F.when(F.col("Discontinued") == 1, 1).otherwise(0).alias("disc")))
        lines = self.window_lines.select("OrderId", "ProductId").join(orders.select("OrderId"), "OrderId", "left_semi")
        return (lines.join(prod, "ProductId", "inner").groupBy("OrderId")
                .agg((F.max("valid") == 1).alias("has_valid_line"), (F.max("disc") == 1).alias("has_discontinued")))

    def order_date_fixes(self, tpd: DataFrame | None = None, orders: DataFrame | None = None) -> DataFrame:
        """Stage 13's updates: (OrderId, OrderMonth, RequiredDate, ShippedDate) of the orders that it changes.

        ``orders``: the orders with ShippedDate as they are stored (kept by month: only the run's months are read).

        Only staged orders of the run's months are looked at: those that an
        anomaly, an existing customer (with region) and salesperson (with
        department) and a line with a category qualify.
        """
        m = self.m
        t = tpd if tpd is not None else self.tpd1
        od_, req, shp = F.col("OrderDate"), F.col("RequiredDate"), F.col("ShippedDate")
        anomaly = ((req < od_) | (req > add_days(od_, 90))
                   | (shp.isNotNull() & (shp < od_)) | (shp.isNotNull() & (shp > add_days(od_, 180))))
        customers = (m.customers.select("CustomerId", "RegionId")
                     .join(m.regions.select("RegionId"), "RegionId", "left_semi").select("CustomerId"))
        sellers = (m.employees.select("EmployeeId", "DepartmentId")
                   .join(m.departments.select("DepartmentId"), "DepartmentId", "left_semi")
                   .select(F.col("EmployeeId").alias("SalesPersonId")))
        staged = t.select("OrderId")
        orders = orders if orders is not None else self.shipped_orders
        odd = self._keep(m.since(orders, self.p.previous_month)
                         .filter((od_ >= self.prev) & anomaly).join(staged, "OrderId", "left_semi")
                         .join(customers, "CustomerId", "left_semi").join(sellers, "SalesPersonId", "left_semi")
                         .select("OrderId", "OrderDate", "RequiredDate", "ShippedDate"))
        flags = self.order_line_flags(odd).filter("has_valid_line")
        new_req = (F.when(req < od_, add_days(od_, 7))
                   .when(req > add_days(od_, 90), add_days(od_, 30)).otherwise(req))
        new_shp = (F.when(shp.isNotNull() & (shp < od_), F.lit(None))
                   .when(shp.isNotNull() & (shp > add_days(od_, 180)) & ~F.col("has_discontinued"), add_days(od_, 14))
                   .otherwise(shp))
        fixes = odd.join(flags, "OrderId", "inner").select(
            "OrderId", month_number(od_).alias(ORDER_MONTH), "OrderDate",
            new_req.alias("RequiredDate"), new_shp.alias("ShippedDate"), req.alias("was_req"), shp.alias("was_shp"))
        # an exempt late shipment changes nothing
        return fixes.filter(~(F.col("RequiredDate").eqNullSafe(F.col("was_req")) & F.col("ShippedDate").eqNullSafe(F.col("was_shp")))
                            ).select("OrderId", ORDER_MONTH, "RequiredDate", "ShippedDate")

    def repair_order_dates(self, tpd: DataFrame | None = None) -> DataFrame:
        """Q34: Orders after the date repair: all orders, of which ``order_date_fixes`` changes a few."""
        return update(self.shipped_orders, self.order_date_fixes(tpd), ["OrderId"], ["RequiredDate", "ShippedDate"],
                      unique=True).select("OrderId", "OrderDate", "SalesPersonId", "CustomerId", "ShipVia",
                                          "RequiredDate", "ShippedDate")

    # ------------------------------------------------------------ Q35-Q36 stage 14
    def process_statistics(self) -> DataFrame:
        """Q35: the ProcessStatistics row over processed staging rows and recent sales."""
        m = self.m
        t = self.tpd4.filter(F.col("IsProcessed") == 1)
        cats = m.categories.select("CategoryId").withColumn("cat_ok", F.lit(True))
        sups = m.suppliers.withColumn("sup_ok", F.lit(True))
        lp = (self.recent_sales.select("ProductId", "CategoryId", "SupplierId").join(cats, "CategoryId", "left")
              .join(sups, "SupplierId", "left"))
        # categories / suppliers count where they exist
        sold = self._counts(lp, {"ProductCount": F.col("ProductId"), "CategoryCount": F.when(F.col("cat_ok"), F.col("CategoryId")),
                                 "SupplierCount": F.when(F.col("sup_ok"), F.col("SupplierId"))})
        region_count = (self.recent_orders.select("CustomerId")
                        .join(m.customers.select("CustomerId", "RegionId"), "CustomerId", "inner")
                        .join(m.regions.select("RegionId"), "RegionId", "left_semi")
                        .select(F.count_distinct("RegionId")).scalar())
        failed = count_when(F.col("Status") != L.PROCESSED)
        agg = t.agg(
            F.count(F.lit(1)).alias("TotalRecords"),
            count_when(F.col("Status") == L.PROCESSED).cast("long").alias("SuccessfulRecords"),
            failed.cast("long").alias("FailedRecords"),
            F.sum("Amount").cast("decimal(38,2)").alias("TotalAmount"),
            F.avg("Amount").cast("decimal(38,6)").alias("AverageAmount"))
        people = self._people(t)
        return agg.select(
            F.lit(self.p.run_id).alias("ProcessId"), self.cur.alias("ProcessDate"),
            "TotalRecords", "SuccessfulRecords", "FailedRecords", "TotalAmount", "AverageAmount",
            *[people[c].alias(c) for c in ("DepartmentCount", "EmployeeCount", "CustomerCount")],
            *[sold[c].alias(c) for c in ("ProductCount", "CategoryCount", "SupplierCount")], region_count.alias("RegionCount"),
            F.lit(0).cast("long").alias("ProcessingTimeSeconds"),
            tier((F.col("FailedRecords") == 0, L.SUCCESS),
                 (F.col("FailedRecords") < F.col("TotalRecords") * _dec("0.05"), L.WARNING),
                 default=L.ERROR).alias("Status"))

    def regions_cross_count(self, others: list[DataFrame] | None = None) -> DataFrame:
        """Q36: COUNT(DISTINCT RegionId) over a comma (cross) product, without forming the product.

        The product has a row for a region iff every other table is non-empty,
        so the count is the region count times that emptiness test.
        """
        m = self.m
        others = others if others is not None else [m.customers, m.orders, m.order_details, m.products]
        nonempty = F.lit(True)
        for df in others:
            # EXISTS-style test: one row is enough
            nonempty = nonempty & df.limit(1).select(F.count(F.lit(1)) > 0).scalar()
        regions = m.regions.select(F.count_distinct("RegionId").alias("n")).scalar()
        return self.m.spark.range(1).select(
            F.when(nonempty, regions).otherwise(F.lit(0)).cast("long").alias("RegionCount2"))
