"""Several exact distinct counts in one pass, without a row per value and count.

`COUNT(DISTINCT a), COUNT(DISTINCT b), ...` is planned as an Expand that copies every
row once per count and shuffles the distinct values of each.  Integer ids need one
bit each: a task sets bits in position bitmaps (32768 ids to a bitmap of 4 KB), the
bitmaps of a bucket of ids are or-ed, and their bits counted.  Bitmaps also roll up: those
of finer groups, or-ed, are those of coarser ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_bitmaps(df: DataFrame, columns: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, name, bucket, bits): the ids of each column as bitmaps; NULLs set no bit."""
    ids = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), c.cast("long").alias("id")) for n, c in columns.items()]))
    return (df.select(*keys, ids.alias("x")).filter("x.id IS NOT NULL")
            .groupBy(*keys, F.col("x.name").alias("name"), F.bitmap_bucket_number("x.id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("x.id")).alias("bits")))


def rolled_up(bitmaps: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Bitmaps of coarser groups."""
    return bitmaps.groupBy(*keys, "name", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(bitmaps: DataFrame, names: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, a long per name); without keys, one row even if there is no bitmap."""
    per = bitmaps.groupBy(*keys, "name").agg(F.sum(F.bitmap_count("bits")).alias("n"))
    return per.groupBy(*keys).agg(*[
        F.coalesce(F.sum(F.when(F.col("name") == n, F.col("n"))), F.lit(0)).cast("long").alias(n) for n in names])


def distinct_counts(df: DataFrame, columns: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """COUNT(DISTINCT column) AS name of integer columns, over all rows or per group of ``keys``.

    Per group a column's ids take 4 KB for each bucket that they lie in: for
    groups of few rows, plain distinct counts are smaller.
    """
    return counted(id_bitmaps(df, columns, keys), list(columns), keys)
