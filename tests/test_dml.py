"""MERGE / UPDATE / DELETE on inline rows (cases the test tables cannot reach)."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.dml import MergeConflictError, MergeSpec, delete, merge, update


def t(c):
    return F.col(f"t__{c}")


def s(c):
    return F.col(f"s__{c}")


def _spec():
    return MergeSpec(
        on=["k"],
        target_scope=t("month") == 7,
        matched_condition=t("v") != s("v"),
        matched_set={"v": s("v")},
        insert_values={"k": s("k"), "month": F.lit(7), "v": s("v")},
        delete_condition=(t("month") == 7) & (t("v") < 0),
        change_columns=["k", "v"],
    )


def test_merge_all_branches(spark):
    target = spark.createDataFrame([(1, 7, 10), (2, 7, 20), (3, 7, -1), (4, 7, 5), (3, 6, -1)],
                                   "k int, month int, v int")
    source = spark.createDataFrame([(1, 11), (2, 20), (9, 90)], "k int, v int")
    new, changes = merge(target, source, _spec())
    got = sorted(tuple(r) for r in new.collect())
    # 1 updated, 2 unchanged, 3 (month 7, v<0, unmatched) deleted, 4 kept, 9 inserted, month-6 row untouched
    assert got == [(1, 7, 11), (2, 7, 20), (3, 6, -1), (4, 7, 5), (9, 7, 90)]
    feed = sorted((r.ActionType, r.Newk, r.Oldk, r.Newv, r.Oldv) for r in changes.collect())
    assert feed == [("DELETE", None, 3, None, -1), ("INSERT", 9, None, 90, None), ("UPDATE", 1, 1, 11, 10)]


def test_merge_is_idempotent(spark):
    target = spark.createDataFrame([(1, 7, 10), (2, 7, 20)], "k int, month int, v int")
    source = spark.createDataFrame([(1, 11), (5, 50)], "k int, v int")
    once, _ = merge(target, source, _spec())
    twice, changes = merge(once, source, _spec())
    assert changes.count() == 0
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_merge_rejects_duplicate_source_keys(spark):
    target = spark.createDataFrame([(1, 7, 10)], "k int, month int, v int")
    source = spark.createDataFrame([(1, 11), (1, 12)], "k int, v int")
    with pytest.raises(MergeConflictError):
        merge(target, source, _spec())


def test_merge_null_comparison_is_not_a_change(spark):
    # `target.v <> source.v` is unknown for NULL: no update (three-valued logic)
    target = spark.createDataFrame([(1, 7, None)], "k int, month int, v int")
    source = spark.createDataFrame([(1, 5)], "k int, v int")
    new, changes = merge(target, source, _spec())
    assert [tuple(r) for r in new.collect()] == [(1, 7, None)]
    assert changes.count() == 0


def test_update_keeps_row_count_and_only_matches(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    upd = spark.createDataFrame([(2, "B"), (4, "D")], "k int, v string")
    out = update(target, upd, ["k"], ["v"], where=F.col("k") > 1)
    assert sorted(map(tuple, out.collect())) == [(1, "a"), (2, "B"), (3, "c")]


def test_update_rejects_ambiguous_source(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    upd = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(MergeConflictError):
        update(target, upd, ["k"], ["v"])


def test_delete_plus_kept_is_all(spark):
    target = spark.range(100).withColumnRenamed("id", "k")
    doomed = spark.range(0, 100, 7).withColumnRenamed("id", "k")
    kept = delete(target, doomed, ["k"])
    assert kept.count() + doomed.count() == 100
    assert kept.join(doomed, "k").count() == 0


def test_scope_only_merge_and_partition_overwrite(spark, scratch):
    import os
    from ledgerline.operators.dml import overwrite_partitions
    path = os.path.join(scratch, "summary_parts")
    target = spark.createDataFrame([(1, 6, 1), (1, 7, 10), (2, 7, 20)], "k int, month int, v int")
    target.write.partitionBy("month").parquet(path)
    stored = spark.read.parquet(path).select("k", "month", "v")
    source = spark.createDataFrame([(1, 11), (3, 30)], "k int, v int")
    spec = MergeSpec(on=["k"], target_scope=t("month") == 7, matched_set={"v": s("v")},
                     insert_values={"k": s("k"), "month": F.lit(7), "v": s("v")})
    scoped, _ = merge(stored, source, spec, scope_only=True)
    assert sorted(map(tuple, scoped.collect())) == [(1, 7, 11), (2, 7, 20), (3, 7, 30)]
    overwrite_partitions(scoped.checkpoint(), path, ["month"])  # cut the read of the same path
    after = sorted(map(tuple, spark.read.parquet(path).select("k", "month", "v").collect()))
    assert after == [(1, 6, 1), (1, 7, 11), (2, 7, 20), (3, 7, 30)]


def test_emptied_partition_goes(spark, scratch):
    import os
    from ledgerline.operators.dml import overwrite_partitions
    path = os.path.join(scratch, "emptied_parts")
    spark.createDataFrame([(1, 6, 1), (1, 7, -10), (2, 7, -20)], "k int, month int, v int").write.partitionBy("month").parquet(path)
    stored = spark.read.parquet(path).select("k", "month", "v")
    scoped, changes = merge(stored, spark.createDataFrame([], "k int, v int"), _spec(), scope_only=True)
    scoped = scoped.checkpoint()
    assert scoped.count() == 0
    overwrite_partitions(scoped, path, ["month"], [{"month": 7}])
    assert [tuple(r) for r in spark.read.parquet(path).select("k", "month", "v").collect()] == [(1, 6, 1)]


def test_unmatched_duplicates_and_null_keys_are_inserts(spark):
    target = spark.createDataFrame([(1, 7, 10), (5, 6, 50)], "k int, month int, v int")
    source = spark.createDataFrame([(1, 11), (9, 90), (9, 91), (None, 1), (None, 2), (5, 51), (5, 52)], "k int, v int")
    new, changes = merge(target, source, _spec())
    got = sorted(map(tuple, new.collect()), key=str)
    # 5 stands in another month, outside the scope: its sources match no target row either
    assert got == sorted([(1, 7, 11), (9, 7, 90), (9, 7, 91), (None, 7, 1), (None, 7, 2), (5, 7, 51), (5, 7, 52),
                          (5, 6, 50)], key=str)
    assert sorted(r.ActionType for r in changes.collect()) == ["INSERT"] * 6 + ["UPDATE"]
