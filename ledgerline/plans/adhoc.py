"""The loose statements of the two extra scripts (Q37, Q38) and the left join with an ON filter."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.exprs import datediff_seconds, gross_amount, lit_ts, net_amount
from ledgerline.operators.product import repeats, through_product
from ledgerline.operators.quantile import percentiles_cont
from ledgerline.plans.stages import TPD_KEYS, Stages
from ledgerline.session import ensure_checkpoint_dir


def top_category_names(rank_categories: DataFrame, rank_products: DataFrame, rank_details: DataFrame,
                       n: int = 5, others: Sequence[DataFrame] = ()) -> DataFrame:
    """`SELECT TOP n CategoryName FROM categories, <others> JOIN ... GROUP BY CategoryName ORDER BY SUM(...) DESC`."""
    ranked = category_sales(rank_categories, rank_products, rank_details, others)
    return ranked.orderBy(F.col("GrossSales").desc(), F.col("CategoryName").asc()).limit(n).select("CategoryName")


def category_sales(categories: DataFrame, products: DataFrame, details: DataFrame, others: Sequence[DataFrame] = ()) -> DataFrame:
    """`SELECT CategoryName, SUM(Quantity * UnitPrice), COUNT(*), COUNT(DISTINCT ProductId) ... GROUP BY CategoryName`.

    ``others`` are tables that only a comma relates to the rest (J10).  Lines
    are added up per product first (partial aggregation), then per category; a
    product is one row by then, so its count needs no Expand.
    """
    per_product = details.groupBy("ProductId").agg(F.sum(gross_amount()).alias("g"), F.count(F.lit(1)).alias("k"))
    named = products.select("ProductId", "CategoryId").join(
        categories.select("CategoryId", "CategoryName"), "CategoryId", "inner")
    per_name = per_product.join(named, "ProductId", "inner").groupBy("CategoryName").agg(
        F.sum("g").cast("decimal(38,2)").alias("GrossSales"), F.sum("k").cast("long").alias("Lines"),
        F.count_distinct("ProductId").alias("Products"))
    return through_product(per_name, others, ["GrossSales", "Lines"])


def nested_topn_amount(orders: DataFrame, order_details: DataFrame, products: DataFrame,
                       categories: DataFrame, rank_categories: DataFrame, rank_products: DataFrame,
                       rank_details: DataFrame, n: int = 5, rank_others: Sequence[DataFrame] = ()) -> DataFrame:
    """Q37: per order, net value of lines whose product's category name is in the top n.

    Three nested IN subqueries become: top names (n rows, broadcast) ->
    category ids -> a flag on products -> one grouped pass over the lines.
    """
    names = F.broadcast(top_category_names(rank_categories, rank_products, rank_details, n, rank_others))
    cat_ids = categories.join(names, "CategoryName", "left_semi").select("CategoryId").withColumn("in_top", F.lit(True))
    prod = products.select("ProductId", "CategoryId").join(cat_ids, "CategoryId", "inner")
    o = orders.select("OrderId")
    lines = order_details.join(o, "OrderId", "left_semi").join(prod.select("ProductId"), "ProductId", "left_semi")
    per = lines.groupBy("OrderId").agg(F.sum(net_amount()).alias("Amount"))
    return o.join(per, "OrderId", "left").select("OrderId", F.col("Amount").cast("decimal(38,4)").alias("Amount"))


def comma_join(left: DataFrame, right: DataFrame, on: Sequence[str], others: Sequence[DataFrame]) -> DataFrame:
    """Q38: `SELECT * FROM a, b, c, ... WHERE a.id = b.id` as the rows of a and b, with a multiplicity.

    Only a and b are related; every other table repeats each joined row as
    often as it has rows.  The product isn't formed: ``Multiplicity`` says how
    many times the row stands in it (rows that stand in it not at all go).
    """
    return (left.join(right, list(on), "inner").withColumn("Multiplicity", repeats(others))
            .filter(F.col("Multiplicity") > 0))


def filtered_product_join(st: Stages) -> DataFrame:
    """Q38 over the retail tables: orders joined to the queue on OrderId, times four dimensions."""
    m = st.m
    return comma_join(m.orders.select("OrderId", "CustomerId", "OrderDate"),
                      m.order_processing_queue.withColumnRenamed("Status", "QueueStatus"), ["OrderId"],
                      [m.regions, m.shippers, m.categories, m.departments])


def left_join_extra_on(st: Stages) -> DataFrame:
    """`tpd LEFT JOIN tvr ON tpd.Id = tvr.RecordId AND tvr.IsValid = 0` (processed rows).

    A row that no rule failed keeps one row with NULLs, a row that two failed
    appears twice.
    """
    tpd = st.tpd3.filter(F.col("IsProcessed") == 1).select("Id", *TPD_KEYS)
    tvr = st.failed_validations().select("RecordId", "ValidationType", "ValidationMessage")
    return (tpd.join(tvr, tpd.Id == tvr.RecordId, "left")
            .select(*TPD_KEYS, "ValidationType", "ValidationMessage"))


def category_sales_through_product(st: Stages) -> DataFrame:
    """Sums, counts and distinct counts per category over `Categories, Regions, Shippers INNER JOIN ...`."""
    m = st.m
    return category_sales(m.categories, m.products, m.order_details, [m.regions, m.shippers])


def order_value_percentiles(st: Stages) -> DataFrame:
    """A10: seven percentiles of the orders' gross values, all found in one search."""
    qs = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]
    found = percentiles_cont(st.order_totals.select("gross_sum"), "gross_sum", qs)
    return st.m.spark.createDataFrame(list(zip(qs, found)), "Share double, OrderValue double")


def staged_row_ids(st: Stages) -> DataFrame:
    """What the IDENTITY column of the staging rows holds, and the validation rows that refer to it."""
    ids = st.tpd1.agg(F.count(F.lit(1)).alias("StagedRows"), F.min("Id").alias("FirstId"), F.max("Id").alias("LastId"),
                      F.count_distinct("Id").alias("Ids"))
    known = st.validations.join(st.tpd1.select(F.col("Id").alias("RecordId")), "RecordId", "left_semi")
    return ids.select("*", known.select(F.count(F.lit(1))).scalar().alias("ValidationsOfIds"))


def orders_of_the_year(st: Stages) -> DataFrame:
    """orders between @YearStart and @YearEnd by month, and the seconds until their queue entries were processed."""
    m, p = st.m, st.p
    start, end = lit_ts(p.year_start), lit_ts(p.year_end)
    orders = m.since(m.orders, p.year_start).filter((F.col("OrderDate") >= start) & (F.col("OrderDate") <= end))
    queue = m.order_processing_queue.select("OrderId", "ProcessedDate")
    seconds = datediff_seconds(F.col("OrderDate"), F.col("ProcessedDate"))
    return (orders.select("OrderId", "OrderDate").join(queue, "OrderId", "left")
            .groupBy(F.month("OrderDate").alias("Month"))
            .agg(F.count(F.lit(1)).alias("Entries"), F.sum(seconds).alias("SecondsToProcess")))


def customers_by_qualified_names(st: Stages) -> DataFrame:
    """`user01.Regions JOIN user01.Customers JOIN user02.Orders`, tables of several schemas in one statement."""
    m = st.m
    spark, folder = m.spark, f"{ensure_checkpoint_dir(m.spark)}/ledgerline-schemas/{uuid.uuid4().hex}"
    for name, df in (("user01.Regions", m.regions), ("user01.Customers", m.customers), ("user02.Orders", m.orders)):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
        df.write.mode("overwrite").option("path", f"{folder}/{name}").saveAsTable(name)
    recent = spark.table("user02.Orders").filter(F.col("OrderDate") >= st.prev)
    return (spark.table("user01.Regions").join(spark.table("user01.Customers"), "RegionId")
            .join(recent, "CustomerId").groupBy("RegionId", "RegionName")
            .agg(F.count_distinct("CustomerId").alias("Customers"), F.count(F.lit(1)).alias("Orders")))
