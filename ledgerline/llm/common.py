"""Helpers shared by the operators: word splitting, stored tables, prefix sums."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir

#: Characters that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
ROW_ID = "__row_id"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stash(df: DataFrame) -> DataFrame:
    """Store ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage: later steps, retries after a lost executor included, read
    the stored rows.  Columns are pruned on later reads, which a checkpointed
    RDD doesn't allow.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole(df: DataFrame) -> Column:
    """All columns of a row as one struct: names that clash with an operator's own stay inside it."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def field(name: str) -> Column:
    """A column of the rows that ``with_row_id`` stored."""
    return F.col("doc").getField(name)


def with_row_id(df: DataFrame) -> DataFrame:
    """(row id, doc): ``df`` stored with a unique row id, so that repeated rows and null keys stay apart."""
    return stash(df.select(F.monotonically_increasing_id().alias(ROW_ID), whole(df).alias("doc")))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text (null: none)."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"({WORD})")), F.array().cast("array<string>"))


def running_before(df: DataFrame, order: Sequence[Column], values: dict[str, Column]) -> DataFrame:
    """Exclusive global running sums of ``values`` in ``order``, without a one-task sort.

    Rows are range-partitioned and stored with their partition's number; each
    partition's running sums start at the sum of the totals of those before it.
    Adds ``<name>`` (sum over all rows before this one) and ``<name>_total``.
    ``order`` should be total; rows that tie in it are interchangeable.
    """
    spark, names = df.sparkSession, list(values)
    ranged = stash(df.withColumns({f"__v_{n}": c for n, c in values.items()})
                   .repartitionByRange(shuffle_partitions(spark), *order)
                   .withColumn("__part", F.spark_partition_id()))
    # one row for each partition: bounded by spark.sql.shuffle.partitions
    totals = ranged.groupBy("__part").agg(*[F.sum(f"__v_{n}").alias(f"__t_{n}") for n in names])
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = totals.select(
        F.col("__part").alias("__start_part"),
        *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__s_{n}") for n in names],
        *[F.sum(f"__t_{n}").over(everything).alias(f"{n}_total") for n in names])
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumns({f"__l_{n}": F.coalesce(F.sum(f"__v_{n}").over(inside), F.lit(0)) for n in names})
    return (local.join(starts, F.col("__part") == F.col("__start_part"))
            .select(*df.columns, *[(F.col(f"__l_{n}") + F.col(f"__s_{n}")).alias(n) for n in names],
                    *[f"{n}_total" for n in names]))


def bounded(batches: Iterator[pa.RecordBatch], column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of ``column`` take at most ``most`` bytes, or are one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, to - at)
            at = to
