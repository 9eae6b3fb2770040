"""Mergeable partial aggregates of the sales history, kept per order month.

The procedure reads all orders and lines in every run, for the 75th percentile of order
values, customers' averages, the regions' totals, the top categories and the
salespeople's favourite ones.  A month that is over doesn't change any more, so
its part of these is kept: counts and sums per order, customer, product and (salesperson,
product), as lasting tables partitioned by OrderMonth.  ``refresh`` rebuilds the
months whose folders of Orders or OrderDetails are others than those that their
part was made from, and reads no other month's lines; the readers add the parts up.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.exprs import sum_gross, sum_net
from ledgerline.sources.lasting import Change, TableState
from ledgerline.sources.testdata import ORDER_MONTH

SOURCES = ("Orders", "OrderDetails")
#: Which folders each month's part was made from.
MADE_FROM = "HistoryMonths"


def _months_of(state: TableState) -> dict[str, list[str]]:
    return {part.partition("=")[2]: sorted(writes) for part, writes in state.parts.items()}


def _made_from(change: Change) -> dict[str, str]:
    """month (as in the folder's name) -> the folders of both sources that hold it."""
    both = [_months_of(change.now[s]) for s in SOURCES]
    return {m: json.dumps([x.get(m, []) for x in both]) for m in sorted(set().union(*both))}


#: Into how many buckets the rows of a month are spread, so that a month isn't one task.
BUCKETS = 8


def _sums(lines: DataFrame) -> list[Column]:
    return [sum_net(lines).alias("net_sum"), sum_gross(lines).alias("gross_sum"), F.count(F.lit(1)).alias("line_count")]


def _per_month(rows: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Aggregates per (month, keys) that lie by month already, for ``arranged`` writes: rows meet once, by month
    and a bucket of the last key.  There are nearly as many groups as rows, so sums before that exchange
    would only be work, and a second exchange by month as large as the first."""
    spread = rows.withColumn("__bucket", F.pmod(F.hash(keys[-1]), F.lit(BUCKETS))).repartition(ORDER_MONTH, "__bucket")
    return spread.groupBy(ORDER_MONTH, "__bucket", *keys).agg(*aggs).drop("__bucket")


class History:
    """The states as a change (or the record it began on) has them."""

    def __init__(self, change: Change):
        self.change, self.spark = change, change.tables.spark

    def refresh(self) -> list[str]:
        """Rebuild the parts of changed months; returns those months."""
        change, now = self.change, _made_from(self.change)
        kept = change.read(MADE_FROM)
        was = {r.Month: r.MadeFrom for r in kept.collect()} if kept is not None else {}  # a row for each month
        stale = sorted(m for m in now.keys() | was.keys() if now.get(m) != was.get(m))
        if not stale:
            return []
        orders, lines = (change.tables.rows(s, change.now[s], [f for f in change.now[s].folders()
                                                               if f[0].partition("=")[2] in set(stale)]) for s in SOURCES)

        def keep(name: str, rows: DataFrame) -> None:
            if name in change.now:
                change.replace_parts(name, rows, [{ORDER_MONTH: m} for m in stale], arranged=True)
            else:
                change.create(name, rows, [ORDER_MONTH], arranged=True)

        sums = _sums(lines)
        keep("HistoryOrders", _per_month(lines, ["OrderId"], sums))
        state = change.now["HistoryOrders"]
        totals = change.tables.rows("HistoryOrders", state, [f for f in state.folders() if f[0].partition("=")[2] in set(stale)])
        o = orders.select("OrderId", ORDER_MONTH, "CustomerId", "SalesPersonId")
        keep("HistoryCustomers", _per_month(o.join(totals.drop(ORDER_MONTH), "OrderId", "left"), ["CustomerId"], [
            F.count(F.lit(1)).alias("orders"), *[F.sum(c).alias(c) for c in ("net_sum", "gross_sum", "line_count")]]))
        keep("HistoryProducts", _per_month(lines, ["ProductId"], sums))
        sold = lines.drop(ORDER_MONTH).join(o.drop("CustomerId"), "OrderId", "inner").drop("OrderId")
        keep("HistorySellers", _per_month(sold, ["SalesPersonId", "ProductId"], sums))
        change.create(MADE_FROM, self.spark.createDataFrame(sorted(now.items()), "Month string, MadeFrom string"))
        return stale

    def _state(self, name: str) -> DataFrame:
        return self.change.read(name)

    def order_totals(self) -> DataFrame:
        """(OrderId, net_sum, gross_sum, line_count) of every order that has lines."""
        return self._state("HistoryOrders").select("OrderId", "net_sum", "gross_sum", "line_count")

    def _added(self, name: str, *keys: str, count: bool = False) -> DataFrame:
        sums = ["net_sum", "gross_sum", "line_count", *(["orders"] if count else [])]
        kinds = {"line_count": "long", "orders": "long"}
        return self._state(name).groupBy(*keys).agg(*[F.sum(c).cast(kinds.get(c, "decimal(38,4)")).alias(c) for c in sums])

    def customers(self) -> DataFrame:
        """(CustomerId, net_sum, gross_sum, line_count, orders) over all months."""
        return self._added("HistoryCustomers", "CustomerId", count=True)

    def products(self) -> DataFrame:
        return self._added("HistoryProducts", "ProductId")

    def sellers(self) -> DataFrame:
        """(SalesPersonId, ProductId, net_sum, gross_sum, line_count) over all months."""
        return self._added("HistorySellers", "SalesPersonId", "ProductId")
