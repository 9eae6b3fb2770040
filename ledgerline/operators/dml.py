"""MERGE, UPDATE and DELETE as pure functions: (target, source) -> new target [, changes].

Parquet tables are immutable, so each statement returns the after-image of
the target; ``write_snapshot`` stores it as a new version directory (never
the folder being read), ``sources.lasting`` writes only the partitions that
changed.  Where the target is a row-level-capable v2 table,
``DataFrame.mergeInto`` can take its place.

Scale notes: the merge joins only the target slice that can change (rows
matching ``target_scope``) with the source; the rest of the target passes
through untouched, without a shuffle.  The source-duplicate check is an aggregate on
the source keys, semi-joined with that slice (T-SQL raises when two source rows
match one target row; so do we); sources that are unique by construction skip
it (``check_duplicates=False``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import remove_folder


class MergeConflictError(ValueError):
    """More than one source row matches a target row."""


@dataclass
class MergeSpec:
    """Clauses of a T-SQL MERGE.

    Expressions refer to target columns as ``t__<name>`` and source columns
    as ``s__<name>``.
    """
    on: Sequence[str]                                   # key columns present in both
    target_scope: Column | None = None                  # extra ON predicate on the target only (t__*)
    matched_condition: Column | None = None             # WHEN MATCHED AND <cond>
    matched_set: Mapping[str, Column] | None = None     # UPDATE SET col = expr
    insert_values: Mapping[str, Column] | None = None   # WHEN NOT MATCHED BY TARGET INSERT
    delete_condition: Column | None = None              # WHEN NOT MATCHED BY SOURCE AND <cond> DELETE
    change_columns: Sequence[str] = field(default_factory=tuple)  # OUTPUT INSERTED/DELETED columns


def check_unique_source(source: DataFrame, keys: Sequence[str], target: DataFrame | None = None) -> None:
    """Raise if two source rows match one target row (without ``target``: if a key stands twice).

    Source rows that match nothing, NULL keys among them, may repeat: they are
    plain inserts.
    """
    twice = source.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).groupBy(*keys).count().filter(F.col("count") > 1)
    if target is not None:
        twice = twice.join(target.select(*keys), list(keys), "left_semi")
    if not twice.isEmpty():
        raise MergeConflictError(f"several source rows match one target row on {list(keys)}")


def merge(target: DataFrame, source: DataFrame, spec: MergeSpec,
          check_duplicates: bool = True, scope_only: bool = False,
          store: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Apply a MERGE; return (new target, change feed).

    Both read the joined rows; ``store`` may store those once.

    The change feed has ActionType ('INSERT' / 'UPDATE' / 'DELETE') and, per
    name in ``spec.change_columns``, ``New<name>`` and ``Old<name>``.  With
    ``scope_only`` the new target holds only the rows of ``spec.target_scope``
    (plus inserts): the part to write back with ``overwrite_partitions`` when
    the scope is a set of partitions.
    """
    keys = list(spec.on)
    cols = target.columns
    t = target.select([F.col(c).alias(f"t__{c}") for c in cols]).withColumn("t____present", F.lit(True))
    scope = spec.target_scope if spec.target_scope is not None else F.lit(True)
    t = t.withColumn("t____scope", F.coalesce(scope, F.lit(False)))
    in_scope = t.filter(F.col("t____scope"))
    out_scope = t.filter(~F.col("t____scope"))
    if check_duplicates:
        check_unique_source(source, keys, in_scope.select(*[F.col(f"t__{k}").alias(k) for k in keys]))
    s = source.select([F.col(c).alias(f"s__{c}") for c in source.columns]).withColumn("s____present", F.lit(True))
    cond = None
    for k in keys:
        c = F.col(f"t__{k}") == F.col(f"s__{k}")
        cond = c if cond is None else cond & c
    # without an insert clause source rows that match nothing go, so the target needn't be the preserved
    # side of a full join: a small source is then broadcast and the target isn't shuffled
    j = in_scope.join(s, cond, "full_outer" if spec.insert_values else "left")
    has_t = F.coalesce(F.col("t____present"), F.lit(False))
    has_s = F.coalesce(F.col("s____present"), F.lit(False))
    matched = has_t & has_s
    upd_cond = matched & (F.coalesce(spec.matched_condition, F.lit(False))
                          if spec.matched_condition is not None else F.lit(True))
    if not spec.matched_set:
        upd_cond = F.lit(False)
    ins_cond = (~has_t) & has_s if spec.insert_values else F.lit(False)
    del_cond = (has_t & ~has_s & F.coalesce(spec.delete_condition, F.lit(False))
                if spec.delete_condition is not None else F.lit(False))
    action = (F.when(upd_cond, "UPDATE").when(ins_cond, "INSERT").when(del_cond, "DELETE"))
    j = j.withColumn("__action", action)
    j = store(j) if store else j

    def new_value(c: str) -> Column:
        old = F.col(f"t__{c}")
        upd = (spec.matched_set or {}).get(c, old)
        ins = (spec.insert_values or {}).get(c, F.lit(None))
        return (F.when(F.col("__action") == "UPDATE", upd)
                .when(F.col("__action") == "INSERT", ins)
                .otherwise(old)).cast(target.schema[c].dataType).alias(c)

    kept = j.filter((F.col("__action").isNull() & has_t) | F.col("__action").isin("UPDATE", "INSERT"))
    new_in_scope = kept.select(*[new_value(c) for c in cols])
    if scope_only:
        new_target = new_in_scope
    else:
        untouched = out_scope.select(*[F.col(f"t__{c}").alias(c) for c in cols])
        new_target = new_in_scope.unionByName(untouched)

    changed = j.filter(F.col("__action").isNotNull())
    feed_cols = [F.col("__action").alias("ActionType")]
    for c in spec.change_columns:
        new_c = new_value(c)
        feed_cols.append(F.when(F.col("__action") != "DELETE", new_c).alias(f"New{c}"))
        feed_cols.append(F.when(F.col("__action") != "INSERT", F.col(f"t__{c}")).alias(f"Old{c}"))
    return new_target, changed.select(*feed_cols)


def update(target: DataFrame, updates: DataFrame, keys: Sequence[str], set_cols: Sequence[str],
           where: Column | None = None, unique: bool = False) -> DataFrame:
    """`UPDATE t SET c = u.c FROM t JOIN u ON keys [WHERE ...]`; row count is unchanged.

    ``updates`` must hold one row per key (checked, unless the caller knows that
    they are ``unique``: T-SQL would pick an arbitrary one, we refuse).  Rows
    without a match, or failing ``where``, keep their values.
    """
    keys = list(keys)
    if not unique:
        check_unique_source(updates, keys)
    u = updates.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in set_cols]).withColumn("__hit", F.lit(True))
    j = target.join(u, keys, "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    if where is not None:
        hit = hit & F.coalesce(where, F.lit(False))
    out = [F.when(hit, F.col(f"__new_{c}")).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
           if c in set_cols else F.col(c) for c in target.columns]
    return j.select(*out)


def delete(target: DataFrame, doomed_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`DELETE FROM t WHERE key IN (...)`: the rows that stay (left-anti join)."""
    return target.join(doomed_keys.select(*keys), list(keys), "left_anti")


def latest_version(spark: SparkSession, base_path: str) -> int:
    """The newest version under ``base_path`` whose write was finished (0: none)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base_path)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(path)] if fs.exists(path) else []
    done = [p.getName() for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return max((int(n[2:]) for n in done if n.startswith("v=") and n[2:].isdigit()), default=0)


def read_snapshot(spark: SparkSession, base_path: str) -> DataFrame | None:
    """The newest version of a table, or None."""
    version = latest_version(spark, base_path)
    return spark.read.parquet(f"{base_path.rstrip('/')}/v={version:06d}") if version else None


def write_snapshot(df: DataFrame, base_path: str, version: int | None = None, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as a version (default: the next) of a table under ``base_path``; return the path."""
    version = version or latest_version(df.sparkSession, base_path) + 1
    path = f"{base_path.rstrip('/')}/v={version:06d}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                         scope: Sequence[Mapping[str, object]] = ()) -> None:
    """Replace the partitions in ``df``, and those of ``scope`` (column -> value), of the table at ``path``.

    Used after a MERGE whose scope is one partition (a month): the other
    partitions are neither read nor rewritten.  A partition of the scope that
    ``df`` has no row of was emptied by the MERGE, and goes.
    """
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    for part in scope:
        rows = df
        for c in partition_by:
            rows = rows.filter(F.col(c) == F.lit(part[c]))
        if rows.isEmpty():
            remove_folder(spark, "/".join([path.rstrip("/"), *[f"{c}={part[c]}" for c in partition_by]]))
