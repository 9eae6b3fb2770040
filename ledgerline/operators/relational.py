"""Small relational operators the retail queries are built from."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                  rank_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows of each key by ``order`` (ties broken by ``order``'s tail).

    Planned as a window with a group limit (`WindowGroupLimit`), so each task
    keeps only n rows per key before the final window; callers pre-aggregate so
    that one row per (key, candidate) reaches it.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    name = rank_col or "__rn"
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def append_if_absent(new_rows: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`INSERT ... WHERE NOT EXISTS (same key in target)`: the rows to append.

    A left-anti join on the key; re-running it after the append yields no rows
    (idempotent).
    """
    return new_rows.join(target.select(*keys).distinct(), list(keys), "left_anti")


def with_row_id(df: DataFrame, col: str = "Id") -> DataFrame:
    """`INT IDENTITY`: unique 64-bit ids without a global sort or single task.

    ``monotonically_increasing_id`` depends on partition layout, so the result
    is checkpointed to the shared checkpoint folder: later stages (and task
    retries) read the stored ids instead of recomputing different ones.
    """
    return df.withColumn(col, F.monotonically_increasing_id()).checkpoint(eager=True)


def identity_ids(df: DataFrame, order: Sequence[Column], col: str = "Id",
                 store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """`INT IDENTITY(1,1)`: ids 1..n in ``order``, dense, from the rows' places in their partitions and the
    counts of the partitions before.  With an order that is total but for alike rows, the ids don't depend
    on partitioning, and so a retry gives the same."""
    return row_number_by_range(df, [], order, col=col, kind="long", store=store).select(col, *df.columns)


def row_number_by_range(df: DataFrame, keys: Sequence[str], order: Sequence[Column], col: str = "rn",
                        partitions: int | None = None, kind: str = "int",
                        store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """`ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order)` for few, possibly huge, key groups.

    A plain window sorts each key group in one task, so one department holding
    a third of the rows would be one task.  Here the rows are range-partitioned
    on (keys, order), which spreads a big group over many partitions; each
    row's position inside its partition comes from ``monotonically_increasing_id``
    taken right after the per-partition sort, and the rows of the same key in
    earlier partitions are added from a small (partition, key) count table.
    ``order`` must make the order total (end with a unique column).  The count
    table has at most partitions x keys rows; AQE broadcasts it if it is small.
    ``store`` keeps the partitioned rows (default: a checkpoint).
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort_cols = [F.col(k).asc_nulls_first() for k in keys] + list(order)
    # stored once: the counts and the join below must see the very same
    # partition layout (range bounds come from a sample of the input)
    s = (df.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
         .withColumn("__pid", F.spark_partition_id())
         .withColumn("__mid", F.monotonically_increasing_id()))
    s = store(s) if store else s.checkpoint(eager=True)
    stats = s.groupBy("__pid", *keys).agg(F.min("__mid").alias("__first"), F.count(F.lit(1)).alias("__cnt"))
    w = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.select(F.col("__pid").alias("__opid"),
                           *[F.col(k).alias(f"__ok{i}") for i, k in enumerate(keys)], "__first",
                           F.coalesce(F.sum("__cnt").over(w), F.lit(0)).alias("__before"))
    on = [F.col("__pid") == F.col("__opid")] + [F.col(k).eqNullSafe(F.col(f"__ok{i}")) for i, k in enumerate(keys)]
    j = s.join(offsets, on, "inner")
    rn = (F.col("__mid") - F.col("__first") + 1 + F.col("__before")).cast(kind)
    return j.select(*df.columns, rn.alias(col))
