"""Retail schema views over the TPC-H-like test tables.

The retail job reads twenty tables that the test environment does not have;
this module derives them, column for column, from the given parquet tables
(`region nation customer supplier part orders lineitem`).  Each view is a lazy
DataFrame: Catalyst prunes the columns a query does not use and pushes filters
to the parquet scan.  ``ledgerline.oracle_sql.MODEL_SQL`` holds the same
mapping in DuckDB SQL; the two must stay identical in meaning.

On a real deployment ``RetailModel`` is replaced by ``CatalogModel`` (below),
which reads the twenty tables from the catalog under the same names.
"""

from __future__ import annotations

import copy
from collections.abc import Mapping
from datetime import datetime
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.exprs import lit_ts, month_number, net_units
from ledgerline.params import RunParams
from ledgerline.session import listing

# Fixed values of the mapping (kept equal to the DuckDB side).
SEGMENT_TYPE_IDS = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4, "MACHINERY": 5}
SHIPPER_IDS = [1, 2, 3, 4, 5]
#: The month of an order, 199806: partition column of Orders and OrderDetails where they are kept by month.
ORDER_MONTH = "OrderMonth"
PROCESSED_MONTH = "ProcessedMonth"
RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
ROOT_DEPARTMENT_NAME = "HQ"
DISCOUNT_START = "1995-01-01 00:00:00"
DISCOUNT_END = "2002-01-01 00:00:00"
HIRE_BASE = "1990-01-01 00:00:00"


def _days_after(ts_col, days_col):
    """`DATEADD(DAY, n, ts)`: keeps the time part and the NTZ type."""
    return F.timestamp_add("DAY", days_col, ts_col)


class RetailModel:
    """The twenty retail tables as DataFrames derived from ``sf_dir``."""

    #: Whose stored tables this model's queries share (``plans.stages.Run``); None: nobody's.
    run = None
    #: Partial aggregates of past months (``plans.history.History``), where they are kept.
    history = None

    def __init__(self, spark: SparkSession, sf_dir: str, run=None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.run = run

    def identity(self) -> tuple:
        """What the data is, not where: stored results count for one identity only."""
        return ("folder", listing(self.spark, self.folders()))

    def folders(self) -> list[str]:
        """Where the files of the tables lie."""
        return [f"{self.sf_dir}/{t}.parquet" for t in RAW_TABLES]

    def parts_of(self, megabytes: int) -> int:
        """How many parts of about ``megabytes`` the stored tables make."""
        return -(-sum(size for _, size, _ in listing(self.spark, self.folders())) // (megabytes << 20))

    @staticmethod
    def since(df: DataFrame, moment: datetime) -> DataFrame:
        """Drops the months before ``moment`` where the table is kept by month (else nothing): fewer partitions are read."""
        if ORDER_MONTH not in df.columns:
            return df
        return df.filter(F.col(ORDER_MONTH) >= moment.year * 100 + moment.month)

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- dimensions -------------------------------------------------------
    @cached_property
    def supplier_count(self):
        """Scalar subquery column: number of suppliers (runs once per query)."""
        return self.raw("supplier").select(F.count(F.lit(1))).scalar()

    @cached_property
    def regions(self) -> DataFrame:
        r = self.raw("region")
        return r.select(
            F.col("r_regionkey").cast("int").alias("RegionId"),
            F.col("r_name").alias("RegionName"),
            (F.col("r_regionkey") % 2).cast("int").alias("CountryId"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        c = self.raw("customer")
        n = self.raw("nation").select("n_nationkey", "n_regionkey")
        seg = F.col("c_mktsegment")
        type_id = F.lit(None).cast("int")
        for name, tid in reversed(list(SEGMENT_TYPE_IDS.items())):
            type_id = F.when(seg == name, F.lit(tid)).otherwise(type_id)
        return c.join(n, c.c_nationkey == n.n_nationkey, "inner").select(
            F.col("c_custkey").alias("CustomerId"),
            F.col("c_name").alias("CustomerName"),
            type_id.alias("CustomerTypeId"),
            F.col("n_regionkey").cast("int").alias("RegionId"),
            (F.col("c_acctbal") * 200).cast("decimal(18,2)").alias("CreditLimit"),
            F.when(F.col("c_custkey") % 10 == 0, 0).otherwise(1).alias("IsActive"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self._orders.drop("o_orderstatus")

    @cached_property
    def _orders(self) -> DataFrame:
        o = self.raw("orders")
        return o.select(
            F.col("o_orderkey").alias("OrderId"),
            F.col("o_orderdate").alias("OrderDate"),
            (F.col("o_orderkey") % self.supplier_count).alias("SalesPersonId"),
            F.col("o_custkey").alias("CustomerId"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("ShipVia"),
            _days_after(F.col("o_orderdate"), F.col("o_orderkey") % 130 - 10).alias("RequiredDate"),
            "o_orderstatus",
        )

    @cached_property
    def orders_with_shipping(self) -> DataFrame:
        """Orders plus ShippedDate = first ship date of its lines, NULL while open.

        Only the order-repair stage reads ShippedDate; the per-order minimum
        is a partial (map-side) aggregate over lineitem, shuffled by order key.
        """
        return self.with_shipping(self.raw("lineitem").groupBy(F.col("l_orderkey").alias("OrderId"))
                                  .agg(F.min("l_shipdate").alias("first_ship")))

    def with_shipping(self, first_ship: DataFrame) -> DataFrame:
        """Orders plus ShippedDate, from (OrderId, first_ship); rows of one key stand once for each status of the key."""
        statuses = F.collect_list(F.struct("o_orderstatus")).over(Window.partitionBy("OrderId"))
        o = (self._orders.filter(F.col("OrderId").isNotNull())
             .withColumn("statuses", statuses).withColumn("status", F.explode("statuses")))
        return (o.join(first_ship.select("OrderId", "first_ship"), "OrderId", "left")
                .select(*self.orders.columns,
                        F.when(F.col("status.o_orderstatus") == "O", F.lit(None))
                        .otherwise(F.col("first_ship")).alias("ShippedDate")))

    @cached_property
    def order_details(self) -> DataFrame:
        return self._lines.drop("ShipDate")

    @cached_property
    def shipped_lines(self) -> DataFrame | None:
        """Order lines with the ShipDate that Orders.ShippedDate is made from; None where that is a column of Orders."""
        return self._lines

    @cached_property
    def _lines(self) -> DataFrame:
        li = self.raw("lineitem")
        # round(x) of a double by floor and remainder, which are exact: ROUND goes through text and BigDecimal
        price = F.col("l_extendedprice") * 100
        whole = F.floor(F.abs(price))
        cents = F.when(price < 0, -1).otherwise(1) * (whole + F.when(F.abs(price) - whole >= 0.5, 1).otherwise(0))
        li = li.withColumns({"__cents": cents.cast("long"), "__qty": F.col("l_quantity").cast("long")})
        # unit price in cents, rounded half up with exact integer arithmetic: floor((2 cents + qty) / (2 qty))
        over, under = F.expr("__cents * 2 + __qty"), F.expr("__qty * 2")
        unit_cents = F.expr("(__cents * 2 + __qty) div (__qty * 2)") - F.when(
            (over % under != 0) & ((over < 0) != (under < 0)), 1).otherwise(0)
        return li.select(
            F.col("l_orderkey").alias("OrderId"),
            F.col("l_partkey").alias("ProductId"),
            F.col("l_quantity").cast("int").alias("Quantity"),
            (unit_cents.cast("decimal(12,0)") * F.lit(Decimal("0.01"))).cast("decimal(10,2)").alias("UnitPrice"),
            F.col("l_discount").cast("decimal(4,2)").alias("Discount"),
            F.col("l_shipdate").alias("ShipDate"),
        )

    @cached_property
    def products(self) -> DataFrame:
        p = self.raw("part")
        return p.select(
            F.col("p_partkey").alias("ProductId"),
            F.col("p_name").alias("ProductName"),
            F.expr("substring(p_brand, 7)").cast("int").alias("CategoryId"),
            (F.col("p_partkey") % self.supplier_count).alias("SupplierId"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("UnitPrice"),
            F.col("p_size").cast("int").alias("UnitsInStock"),
            (F.col("p_partkey") % 20).cast("int").alias("UnitsOnOrder"),
            (F.col("p_partkey") % 15).cast("int").alias("ReorderLevel"),
            F.when(F.col("p_partkey") % 25 == 0, 1).otherwise(0).alias("Discontinued"),
        )

    @cached_property
    def categories(self) -> DataFrame:
        return (self.raw("part").select("p_brand").distinct()
                .select(F.expr("substring(p_brand, 7)").cast("int").alias("CategoryId"),
                        F.col("p_brand").alias("CategoryName")))

    @cached_property
    def suppliers(self) -> DataFrame:
        return self.raw("supplier").select(F.col("s_suppkey").alias("SupplierId"))

    @cached_property
    def shippers(self) -> DataFrame:
        return self.spark.createDataFrame([(i,) for i in SHIPPER_IDS], "ShipperId int")

    @cached_property
    def employees(self) -> DataFrame:
        s = self.raw("supplier")
        k = F.col("s_suppkey")
        return s.select(
            k.alias("EmployeeId"),
            F.col("s_name").alias("EmployeeName"),
            (F.col("s_nationkey") + 100).cast("int").alias("DepartmentId"),
            (k - k % 10).alias("ManagerId"),
            _days_after(F.lit(HIRE_BASE).cast("timestamp_ntz"), k % 1000).alias("HireDate"),
            F.col("s_acctbal").cast("decimal(18,2)").alias("Salary"),
            (k % 5).cast("int").alias("PositionId"),
            F.when(k % 8 == 0, 0).otherwise(1).alias("IsActive"),
        )

    @cached_property
    def departments(self) -> DataFrame:
        """Three levels: HQ (0) -> one per region (1 + regionkey) -> one per nation (100 + nationkey)."""
        root = self.spark.range(1).select(
            F.lit(0).alias("DepartmentId"), F.lit(ROOT_DEPARTMENT_NAME).alias("DepartmentName"),
            F.lit(None).cast("int").alias("ParentDepartmentId"))
        regs = self.raw("region").select(
            (F.col("r_regionkey") + 1).cast("int").alias("DepartmentId"),
            F.col("r_name").alias("DepartmentName"),
            F.lit(0).alias("ParentDepartmentId"))
        nats = self.raw("nation").select(
            (F.col("n_nationkey") + 100).cast("int").alias("DepartmentId"),
            F.col("n_name").alias("DepartmentName"),
            (F.col("n_regionkey") + 1).cast("int").alias("ParentDepartmentId"))
        d = root.unionByName(regs).unionByName(nats)
        did = F.col("DepartmentId")
        return d.select(
            "DepartmentId", "DepartmentName", "ParentDepartmentId",
            (did % 5).cast("int").alias("ManagerId"),
            (F.lit(2000000) * (did % 7 + 1)).cast("decimal(18,2)").alias("BudgetAmount"),
            (did % 5).cast("int").alias("LocationId"),
        )

    @cached_property
    def order_cancellations(self) -> DataFrame:
        o = self.raw("orders")
        return (o.filter((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 5 == 0))
                .select(F.col("o_orderkey").alias("OrderId"),
                        _days_after(F.col("o_orderdate"), F.lit(3)).alias("CancellationDate")))

    @cached_property
    def discounts(self) -> DataFrame:
        c = self.raw("customer")
        return (c.filter(F.col("c_custkey") % 3 == 0)
                .select(F.col("c_custkey").alias("CustomerId"),
                        (F.col("c_custkey") % 15).cast("decimal(5,2)").alias("DiscountPercent"),
                        F.lit(DISCOUNT_START).cast("timestamp_ntz").alias("StartDate"),
                        F.lit(DISCOUNT_END).cast("timestamp_ntz").alias("EndDate"),
                        F.lit(1).alias("IsActive")))

    @cached_property
    def order_processing_queue(self) -> DataFrame:
        o = self.raw("orders")
        return o.select(
            F.col("o_orderkey").alias("QueueId"),
            F.col("o_orderkey").alias("OrderId"),
            F.when(F.col("o_orderstatus") == "F", "Processed").otherwise("Pending").alias("Status"),
            # every other entry waited long ago, so that the purge finds old ones in the run window
            _days_after(F.col("o_orderdate"), F.when(F.col("o_orderkey") % 2 == 0, -70).otherwise(1)).alias("ProcessedDate"),
        )

    def customer_order_summary(self, params: RunParams) -> DataFrame:
        """Seed of the monthly summary table the merge stage upserts into.

        Built from all orders of customers with CustomerId % 3 != 2, per
        (customer, salesperson's department), in the run's month.  Customers
        with CustomerId % 3 = 1 carry a LastProcessDate 100 days old, so the
        unmatched ones are deleted by the merge; a second copy of them sits in
        the previous month and must stay untouched.
        """
        o = (self.orders.select("OrderId", "CustomerId", "SalesPersonId", "OrderDate")
             .filter(F.col("CustomerId") % 3 != 2))
        e = self.employees.select(F.col("EmployeeId").alias("SalesPersonId"), "DepartmentId")
        e = e.filter(F.col("DepartmentId").isNotNull())
        orders = o.join(e, "SalesPersonId", "inner")
        # lines meet their orders once; an order's first line speaks for the order itself, so that its date, salesperson
        # and count come from the same pass.  Where the lines lie by OrderId for the join, numbering them is free.
        first = F.row_number().over(Window.partitionBy("OrderId").orderBy("OrderId")) == 1
        lines = self.order_details.filter(F.col("OrderId").isNotNull()).select(
            "OrderId", "ProductId", net_units().alias("units")).withColumn("first", first)

        def fact(seller: bool, id_: str, units, n: int, k: int):
            return F.struct(F.lit(seller).alias("seller"), F.col(id_).alias("id"), units.cast("long").alias("units"),
                            F.lit(n).cast("long").alias("n"), F.lit(k).cast("long").alias("k"))

        line, order = fact(False, "ProductId", F.col("units"), 1, 0), fact(True, "SalesPersonId", F.lit(None), 0, 1)
        facts = lines.join(orders, "OrderId", "inner").select(
            "CustomerId", "DepartmentId", "OrderDate",
            F.explode(F.when(F.col("first"), F.array(line, order)).otherwise(F.array(line))).alias("x"))
        # distinct products and salespersons first, then the groups: both by where (customer, department) lies
        ids = (facts.select("CustomerId", "DepartmentId", "OrderDate", "x.*").repartition("CustomerId", "DepartmentId")
               .groupBy("CustomerId", "DepartmentId", "seller", "id")
               .agg(F.sum("units").alias("units"), F.sum("n").alias("n"), F.sum("k").alias("k"), F.min("OrderDate").alias("d")))
        sums = ids.groupBy("CustomerId", "DepartmentId").agg(
            F.sum("k").alias("OrderCount"), (F.sum("units").cast("decimal(20,0)") * F.lit(Decimal("0.0001"))).alias("s"),
            F.sum("n").alias("n"), F.min("d").alias("FirstProcessDate"),
            F.count(F.when(~F.col("seller"), 1)).alias("ProductCount"),
            F.count(F.when(F.col("seller"), F.col("id"))).alias("EmployeeCount"))
        avg = (F.col("s").cast("decimal(26,4)") / F.col("n").cast("decimal(20,0)")).cast("decimal(38,8)")
        agg = sums.select(
            "CustomerId", "DepartmentId", "OrderCount",
            F.col("s").cast("decimal(18,2)").alias("TotalAmount"),
            avg.cast("decimal(18,6)").alias("AvgAmount"),
            "FirstProcessDate", "ProductCount", "EmployeeCount")
        cur = lit_ts(params.current_ts)
        old = lit_ts(params.days_before(100))
        is_old = F.col("CustomerId") % 3 == 1
        prev = params.previous_month
        month = lambda y, m: F.struct(F.lit(y).alias("ProcessYear"), F.lit(m).alias("ProcessMonth"))
        this, last = month(params.process_year, params.process_month), month(prev.year, prev.month)
        # the old customers stand in both months: one pass makes both copies
        months = F.explode(F.when(is_old, F.array(this, last)).otherwise(F.array(this)))
        return agg.withColumn("month", months).select(
            "CustomerId", "DepartmentId", "month.ProcessYear", "month.ProcessMonth",
            "OrderCount", "TotalAmount", "AvgAmount",
            F.when(is_old, old).otherwise(cur).alias("LastProcessDate"),
            "FirstProcessDate", "ProductCount", "EmployeeCount",
            F.lit("Seed").alias("StatusList"),
            old.alias("CreatedDate"), F.lit("seed").alias("CreatedBy"),
            old.alias("UpdatedDate"), F.lit("seed").alias("UpdatedBy"),
        )

    # -- report tables as earlier runs left them ------------------------------
    def stored_sales_report(self, params: RunParams) -> DataFrame:
        """SalesPerformanceReport rows: every third order's key, of the run date or (odd orders) of the day before."""
        e = self.employees.select(F.col("EmployeeId").alias("SalesPersonId"), "DepartmentId")
        o = self.orders.filter(F.col("OrderId") % 3 == 0).join(e, "SalesPersonId", "inner")
        return o.select(F.when(F.col("OrderId") % 2 == 0, lit_ts(params.current_ts))
                        .otherwise(lit_ts(params.days_before(1))).alias("ReportDate"),
                        "DepartmentId", F.col("SalesPersonId").alias("EmployeeId"), "CustomerId").distinct()

    def stored_segment_analysis(self, params: RunParams) -> DataFrame:
        """CustomerSegmentAnalysis rows: every third customer, of the run date or (odd ones) of the day before."""
        return self.customers.filter(F.col("CustomerId") % 3 == 0).select(
            F.when(F.col("CustomerId") % 2 == 0, lit_ts(params.current_ts))
            .otherwise(lit_ts(params.days_before(1))).alias("AnalysisDate"), "CustomerId")

    def stored_department_report(self, params: RunParams) -> DataFrame:
        """DepartmentPerformanceReport rows: every third department, of the run date."""
        return self.departments.filter(F.col("DepartmentId") % 3 == 0).select(
            lit_ts(params.current_ts).alias("ReportDate"), "DepartmentId")


class CatalogModel(RetailModel):
    """The same interface over real catalog tables (`spark.table(name)`)."""

    TABLES = {
        "regions": "Regions", "customers": "Customers", "orders": "Orders",
        "order_details": "OrderDetails", "products": "Products", "categories": "Categories",
        "suppliers": "Suppliers", "shippers": "Shippers", "employees": "Employees",
        "departments": "Departments", "order_cancellations": "OrderCancellations",
        "discounts": "Discounts", "order_processing_queue": "OrderProcessingQueue",
    }

    shipped_lines = None

    def __init__(self, spark: SparkSession, database: str = "default", names: Mapping[str, str] | None = None):
        """``names`` says where single tables are instead: "Customers" -> "user01.Customers"."""
        super().__init__(spark, "")
        self.database, self.names = database, dict(names or {})
        for attr, table in self.TABLES.items():
            self.__dict__[attr] = spark.table(self.qualified(table))
        self.__dict__["orders_with_shipping"] = self.__dict__["orders"]
        self.__dict__["orders"] = self.__dict__["orders"].drop("ShippedDate")

    def qualified(self, table: str) -> str:
        return self.names.get(table, f"{self.database}.{table}")

    def folders(self) -> list[str]:
        """Where the files of the tables lie."""
        names = map(self.qualified, [*self.TABLES.values(), "CustomerOrderSummary"])
        known = [n for n in names if self.spark.catalog.tableExists(n)]
        return sorted({f.rsplit("/", 1)[0] for n in known for f in self.spark.table(n).inputFiles()})

    def identity(self) -> tuple:
        return ("catalog", self.database, str(sorted(self.names.items())), listing(self.spark, self.folders()))

    def customer_order_summary(self, params: RunParams) -> DataFrame:  # noqa: ARG002
        return self.spark.table(self.qualified("CustomerOrderSummary"))

    def stored_sales_report(self, params: RunParams) -> DataFrame:  # noqa: ARG002
        return self.spark.table(self.qualified("SalesPerformanceReport"))

    def stored_segment_analysis(self, params: RunParams) -> DataFrame:  # noqa: ARG002
        return self.spark.table(self.qualified("CustomerSegmentAnalysis"))

    def stored_department_report(self, params: RunParams) -> DataFrame:  # noqa: ARG002
        return self.spark.table(self.qualified("DepartmentPerformanceReport"))


# Main join key of each table: tables sharing a key are bucketed alike, so
# their joins (orders with lines, queue, cancellations) need no shuffle.
BUCKET_KEYS = {
    "orders": "OrderId", "order_details": "OrderId", "order_processing_queue": "OrderId",
    "order_cancellations": "OrderId", "customers": "CustomerId", "discounts": "CustomerId",
    "products": "ProductId",
}


def by_month(model: RetailModel, orders: DataFrame | None = None) -> dict[str, DataFrame]:
    """Orders, OrderDetails and the queue with their month; a line carries its order's (NULL if it has none).

    ``orders``: the orders with ShippedDate, where those have been made from stored sums.
    """
    orders = orders if orders is not None else model.orders_with_shipping
    orders = orders.withColumn(ORDER_MONTH, month_number(F.col("OrderDate")))
    queue = model.order_processing_queue.withColumn(PROCESSED_MONTH, month_number(F.col("ProcessedDate")))
    months = model.orders.select("OrderId", month_number(F.col("OrderDate")).alias(ORDER_MONTH))
    return {"orders": orders, "order_processing_queue": queue,
            "order_details": model.order_details.drop(ORDER_MONTH).join(months, "OrderId", "left")}


#: The tables that are kept by month, and by which column.
MONTH_COLUMNS = {"orders": ORDER_MONTH, "order_details": ORDER_MONTH, "order_processing_queue": PROCESSED_MONTH}


def publish_tables(model: RetailModel, database: str, buckets: int, mode: str = "overwrite", months: bool = False) -> None:
    """Write the retail tables into ``database`` for ``CatalogModel``.

    Fact tables are bucketed (and sorted) by their main join key with the same
    bucket count, so Orders ⋈ OrderDetails and the other OrderId joins run as
    sort-merge joins without an exchange; dimensions are written plain.  With
    ``months``, orders, lines and the queue are partitioned by month as well: a
    run then reads the months of its window only.
    """
    spark = model.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    monthly = by_month(model) if months else {}
    for attr, table in CatalogModel.TABLES.items():
        # the stored Orders table carries ShippedDate (the test mapping derives it from lines)
        df = model.orders_with_shipping if attr == "orders" else getattr(model, attr)
        df = monthly.get(attr, df)
        writer = df.write.mode(mode)
        key = BUCKET_KEYS.get(attr)
        if attr in monthly:
            writer = writer.partitionBy(MONTH_COLUMNS[attr])
        if key:
            writer = writer.bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(f"{database}.{table}")


def load_tables(model: RetailModel, change, orders: DataFrame | None = None) -> None:
    """Put orders, lines and queue into lasting tables (``sources.lasting``), kept by month."""
    for attr, df in by_month(model, orders).items():
        change.create(CatalogModel.TABLES[attr], df, [MONTH_COLUMNS[attr]])


class LastingModel(RetailModel):
    """``base`` with Orders, OrderDetails and the queue as lasting tables have them, where they have them."""

    def __init__(self, base: RetailModel, tables, record=None):
        self.__dict__.update(copy.copy(base).__dict__)
        self.base, self.tables = base, tables
        self.record = record or tables.record()
        self.run, self.history = base.run, None
        for attr in MONTH_COLUMNS:
            df = tables.read(CatalogModel.TABLES[attr], self.record)
            if df is None:
                continue
            if attr == "orders":
                self.__dict__["orders_with_shipping"] = df
                df = df.drop("ShippedDate")
            if attr != "order_processing_queue":
                self.__dict__["shipped_lines"] = None
            self.__dict__[attr] = df

    def identity(self) -> tuple:
        kept = {n: sorted(t.folders()) for n, t in self.record.tables.items() if n in CatalogModel.TABLES.values()}
        return ("lasting", self.tables.root, str(sorted(kept.items())), self.base.identity())

    def customer_order_summary(self, params: RunParams) -> DataFrame:
        return self.base.customer_order_summary(params)

    def stored_sales_report(self, params: RunParams) -> DataFrame:
        return self.base.stored_sales_report(params)

    def stored_segment_analysis(self, params: RunParams) -> DataFrame:
        return self.base.stored_segment_analysis(params)

    def stored_department_report(self, params: RunParams) -> DataFrame:
        return self.base.stored_department_report(params)


class FrameModel(RetailModel):
    """The same interface over DataFrames given by name (tests, notebooks)."""

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame], name: str = "frames"):
        super().__init__(spark, name)
        for attr, df in frames.items():
            self.__dict__[attr] = df
        if "orders_with_shipping" not in frames and "orders" in frames:
            self.__dict__["orders_with_shipping"] = frames["orders"]
        self.__dict__.setdefault("shipped_lines", None)

    def folders(self) -> list[str]:
        return []

    def identity(self) -> tuple:
        return ("frames", self)  # the object itself: no other model equals it

    def customer_order_summary(self, params: RunParams) -> DataFrame:  # noqa: ARG002
        return self.__dict__["customer_order_summary"]
