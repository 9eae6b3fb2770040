"""Aggregates over a comma (cross) product, without forming it.

In `FROM a, b, c JOIN d ON a.x = d.x` the tables that no condition ties to the rest
repeat every joined row once for each of their own row combinations.  So COUNT and
SUM are those of the joined rows times the other tables' row counts; MIN, MAX,
AVG and COUNT(DISTINCT) stay as they are; and one empty table empties the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def repeats(others: Sequence[DataFrame]) -> Column:
    """How often every row stands in the product with ``others``: the product of their row counts."""
    times = F.lit(1).cast("decimal(38,0)")
    for df in others:
        times = (times * df.select(F.count(F.lit(1)).cast("decimal(18,0)")).scalar()).cast("decimal(38,0)")
    return times


def through_product(grouped: DataFrame, others: Sequence[DataFrame], additive: Sequence[str]) -> DataFrame:
    """A grouped result over some tables, as it is over their product with ``others``.

    ``additive`` names its SUM and COUNT columns (their types are kept); groups of an empty product go.
    """
    kinds = {f.name: f.dataType for f in grouped.schema.fields}
    counted = grouped.withColumn("__times", repeats(others)).filter(F.col("__times") > 0)
    return counted.select(*[(F.col(c) * F.col("__times")).cast(kinds[c]).alias(c) if c in additive else F.col(c)
                            for c in grouped.columns])
