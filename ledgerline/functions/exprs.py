"""Column expressions shared by the retail queries (all native, codegen-friendly)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, IntegerType, LongType, ShortType


def lit_ts(value: datetime) -> Column:
    """A run parameter as a TIMESTAMP_NTZ literal (inputs are NTZ).

    Built from text, so the session time zone cannot shift it.
    """
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def gross_amount(prefix: str = "") -> Column:
    """`Quantity * UnitPrice` of an order line."""
    return F.col(f"{prefix}Quantity") * F.col(f"{prefix}UnitPrice")


def net_amount(prefix: str = "") -> Column:
    """`Quantity * UnitPrice * (1 - Discount)`: exact DECIMAL(27,4)."""
    return F.col(f"{prefix}Quantity") * F.col(f"{prefix}UnitPrice") * (1 - F.col(f"{prefix}Discount"))


def net_unit_price(prefix: str = "") -> Column:
    return F.col(f"{prefix}UnitPrice") * (1 - F.col(f"{prefix}Discount"))


def in_cents(df: DataFrame, *columns: str) -> bool:
    """Quantity is an integer, and ``columns`` are decimals of at most 2 places that a double holds exactly."""
    kinds = {c: df.schema[c].dataType for c in ("Quantity", *columns)}
    return (isinstance(kinds.pop("Quantity"), ByteType | ShortType | IntegerType | LongType)
            and all(isinstance(k, DecimalType) and k.scale <= 2 and k.precision <= 15 for k in kinds.values()))


def _cents(c: str) -> Column:
    return F.rint(F.col(c).cast("double") * 100).cast("long")


def _sum_of(df: DataFrame, columns: Sequence[str], units: Callable[[], Column], places: int, exact: Column,
            where: Column | None, kind: str) -> Column:
    """SUM of ``exact``, added up in whole ``units`` of 10^-places where the columns are kept in cents.

    A sum of longs is many times cheaper than one of DECIMAL(27,4) and takes a third of its
    room in hash maps and shuffles; it holds 9e14 of money a group.
    """
    if not in_cents(df, *columns):
        return F.sum(exact if where is None else F.when(where, exact)).cast(kind)
    whole = units() if where is None else F.when(where, units())
    return (F.sum(whole).cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-places))).cast(kind)


def net_units() -> Column:
    """``net_amount`` in ten-thousandths, as a long."""
    return F.col("Quantity").cast("long") * _cents("UnitPrice") * (100 - _cents("Discount"))


def net_unit_price_units() -> Column:
    """``net_unit_price`` in ten-thousandths, as a long."""
    return _cents("UnitPrice") * (100 - _cents("Discount"))


def sum_net(df: DataFrame, where: Column | None = None) -> Column:
    """SUM(net_amount) over order lines ``df``."""
    return _sum_of(df, ["UnitPrice", "Discount"], net_units, 4, net_amount(), where, "decimal(37,4)")


def sum_gross(df: DataFrame) -> Column:
    """SUM(gross_amount) over order lines ``df``."""
    return _sum_of(df, ["UnitPrice"], lambda: F.col("Quantity").cast("long") * _cents("UnitPrice"), 2,
                   gross_amount(), None, "decimal(31,2)")


def optional_eq(col: str | Column, value) -> Column:
    """`ISNULL(@p, col) = col`: a filter only when the parameter is set.

    Rows with NULL ``col`` drop in both cases; with ``value`` None Catalyst
    folds this to ``col IS NOT NULL``.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.lit(value), c) == c


def datediff_days(start: Column, end: Column) -> Column:
    """`DATEDIFF(DAY, start, end)`: counts date boundaries crossed, like T-SQL."""
    return F.datediff(end, start)


def datediff_seconds(start: Column, end: Column) -> Column:
    """`DATEDIFF(SECOND, start, end)`: second boundaries crossed."""
    return (F.unix_seconds(F.date_trunc("second", end.cast("timestamp")))
            - F.unix_seconds(F.date_trunc("second", start.cast("timestamp"))))


def add_days(ts: Column, days) -> Column:
    """`DATEADD(DAY, n, ts)` keeping the time part."""
    return F.timestamp_add("DAY", days if isinstance(days, Column) else F.lit(days), ts)


def month_number(ts: Column) -> Column:
    """1998-06-30 -> 199806: the partition column of tables kept by month."""
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def percent_factor(percent_sum: Column) -> Column:
    """`1 + ISNULL(SUM(pct), 0) / 100.0`, computed exactly (x * 0.01 == x / 100)."""
    return F.lit(1) + F.coalesce(percent_sum, F.lit(Decimal("0"))) * F.lit(Decimal("0.01"))


def tier(*rules: tuple[Column, str], default: str | Column) -> Column:
    """Ordered CASE WHEN: first matching rule wins, else ``default``."""
    out = default if isinstance(default, Column) else F.lit(default)
    for cond, label in reversed(rules):
        out = F.when(cond, F.lit(label)).otherwise(out)
    return out


def count_when(cond: Column) -> Column:
    """`SUM(CASE WHEN cond THEN 1 ELSE 0 END)`: NULL on empty input (unlike count_if)."""
    return F.sum(F.when(cond, 1).otherwise(0))
