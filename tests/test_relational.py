"""Relational helpers: distributed row number, per-key top-n, insert-if-absent."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators.relational import append_if_absent, row_number_by_range, top_n_per_key


def test_row_number_by_range_matches_window_on_skewed_keys(spark):
    # key 0 holds most rows; values repeat so the id tie-break matters
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 4).alias("k"),
        (F.col("id") * 7919 % 101).alias("v"), F.col("id"))
    order = [F.col("v").desc(), F.col("id").asc()]
    got = row_number_by_range(df, ["k"], order, col="rn", partitions=7)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    assert got.count() == 3000
    assert got.select("k", "id", "rn").exceptAll(want.select("k", "id", "rn")).count() == 0


def test_top_n_per_key_and_append_if_absent(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (1, 9, "c"), (2, 1, "d")], "k int, v int, t string")
    top = top_n_per_key(df, ["k"], [F.col("v").desc(), F.col("t").asc()], 1)
    assert sorted((r.k, r.t) for r in top.collect()) == [(1, "b"), (2, "d")]
    target = spark.createDataFrame([(1, "x")], "k int, t string")
    new = spark.createDataFrame([(1, "y"), (3, "z")], "k int, t string")
    add = append_if_absent(new, target, ["k"])
    assert [tuple(r) for r in add.collect()] == [(3, "z")]
    assert append_if_absent(add, target.unionByName(add), ["k"]).count() == 0


def test_row_number_by_range_without_broadcast(spark):
    from ledgerline.operators import relational
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(500).select((F.col("id") % 3).alias("k"), F.col("id"))
        got = relational.row_number_by_range(df, ["k"], [F.col("id").desc()], partitions=5)
        want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(F.col("id").desc())))
        assert got.select("k", "id", "rn").exceptAll(want.select("k", "id", "rn")).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_identity_ids_are_dense_and_alike_for_any_layout(spark):
    from ledgerline.operators.relational import identity_ids
    df = spark.range(1000).select((F.col("id") * 7919 % 97).alias("a"), (F.col("id") % 3).alias("b"))
    order = [F.col("a").asc(), F.col("b").asc()]
    one = identity_ids(df.repartition(3), order)
    assert sorted(r.Id for r in one.collect()) == list(range(1, 1001))
    other = identity_ids(df.repartition(11), order)
    assert one.exceptAll(other).count() == 0
    assert identity_ids(df.limit(0), order).count() == 0


def test_aggregates_through_a_product(spark):
    """Against the product itself; one empty table empties the result."""
    from ledgerline.operators.product import through_product
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("b", 2), ("c", None)], "k string, v long")
    two, three = spark.range(2), spark.range(3)
    how = [F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"), F.count_distinct("v").alias("d"), F.max("v").alias("hi"),
           F.avg("v").alias("mean")]
    crossed = rows.crossJoin(two.toDF("x")).crossJoin(three.toDF("y")).groupBy("k").agg(*how)
    got = through_product(rows.groupBy("k").agg(*how), [two, three], ["s", "n"])
    assert got.dtypes == crossed.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, crossed.collect()))
    assert through_product(rows.groupBy("k").agg(*how), [two, spark.range(0)], ["s", "n"]).count() == 0


def test_top_names_with_an_empty_second_table(spark):
    from ledgerline.plans.adhoc import top_category_names
    cats = spark.createDataFrame([(1, "A"), (2, "B")], "CategoryId int, CategoryName string")
    prods = spark.createDataFrame([(10, 1), (20, 2)], "ProductId int, CategoryId int")
    lines = spark.createDataFrame([(10, 1, 5.0), (20, 2, 9.0)], "ProductId int, Quantity int, UnitPrice double")
    names = lambda others: [r.CategoryName for r in top_category_names(cats, prods, lines, 1, others).collect()]
    assert names([]) == names([cats]) == ["B"]
    assert names([cats, spark.range(0)]) == []


def test_distinct_counts_by_bitmaps(spark):
    from ledgerline.operators.distinct import counted, distinct_counts, id_bitmaps, rolled_up
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 100_003 - 500).alias("a"),
                                  F.when(F.col("id") % 5 != 0, F.col("id") % 41).cast("int").alias("b"),
                                  F.lit(None).cast("long").alias("c"))
    cols = {n: F.col(n) for n in "abc"}
    want = df.agg(*[F.count_distinct(n).alias(n) for n in "abc"])
    got = distinct_counts(df, cols)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.collect() == want.collect()
    by_k = df.groupBy("k").agg(*[F.count_distinct(n).alias(n) for n in "ab"])
    assert sorted(distinct_counts(df, {n: F.col(n) for n in "ab"}, ["k"]).collect()) == sorted(by_k.collect())
    finer = id_bitmaps(df, cols, ["k"])
    assert counted(rolled_up(finer), list("abc")).collect() == want.collect()
    assert distinct_counts(df.limit(0), cols).first() == (0, 0, 0)
