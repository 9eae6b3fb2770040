"""Recursive trees, date rules and small expression helpers."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.exprs import datediff_days, datediff_seconds, optional_eq, tier
from ledgerline.operators.hierarchy import CycleError, cumulative_down, tree_paths
from ledgerline.params import RunParams, add_months


def _nodes(spark, rows):
    rows = [(i, p, n, Decimal(b)) for i, p, n, b in rows]
    return spark.createDataFrame(rows, "id int, parent int, name string, budget decimal(18,2)")


def test_tree_paths_and_levels(spark):
    nodes = _nodes(spark, [(1, None, "HQ", 10), (2, 1, "A", 5), (3, 2, "B", 1), (4, None, "X", 0), (9, 77, "orphan", 1)])
    got = {r.id: (r.Level, r.HierarchyPath) for r in
           tree_paths(spark, nodes, id_col="id", parent_col="parent", name_col="name").collect()}
    assert got == {1: (0, "HQ"), 2: (1, "HQ > A"), 3: (2, "HQ > A > B"), 4: (0, "X")}


def test_cumulative_budget_runs_down_not_up(spark):
    nodes = _nodes(spark, [(1, None, "HQ", 10), (2, 1, "A", 5), (3, 2, "B", 1)])
    got = {r.id: float(r.TotalBudget) for r in
           cumulative_down(spark, nodes, id_col="id", parent_col="parent", value_col="budget",
                           keep=["name"]).collect()}
    assert got == {1: 10.0, 2: 15.0, 3: 16.0}


def test_cycle_is_an_error(spark):
    nodes = _nodes(spark, [(1, None, "HQ", 1), (2, 3, "A", 1), (3, 2, "B", 1), (4, 1, "C", 1), (2, 4, "A", 1)])
    with pytest.raises(Exception):
        tree_paths(spark, nodes, id_col="id", parent_col="parent", name_col="name").collect()


def test_month_arithmetic_clamps():
    assert add_months(datetime(1998, 3, 31), -1) == datetime(1998, 2, 28)
    assert add_months(datetime(2000, 3, 31), -1) == datetime(2000, 2, 29)
    assert RunParams(current_ts=datetime(1998, 1, 15)).previous_month == datetime(1997, 12, 15)


def test_datediff_counts_boundaries(spark):
    df = spark.createDataFrame([(datetime(1998, 6, 30, 23, 0), datetime(1998, 7, 1, 0, 0))], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(datediff_days(F.col("a"), F.col("b")).alias("d"),
                  datediff_seconds(F.col("a"), F.col("b")).alias("s")).first()
    assert (r.d, r.s) == (1, 3600)


def test_optional_eq_and_tier(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "d int")
    assert sorted(r.d for r in df.filter(optional_eq("d", None)).collect()) == [1, 2]
    assert [r.d for r in df.filter(optional_eq("d", 2)).collect()] == [2]
    lab = df.select(tier((F.col("d") > 1, "big"), (F.col("d") > 0, "small"), default="none").alias("t"))
    assert sorted(r.t for r in lab.collect()) == ["big", "none", "small"]


def test_deep_tree_has_no_level_limit(spark):
    nodes = _nodes(spark, [(i, i - 1 if i > 1 else None, f"n{i}", 1) for i in range(1, 151)]).coalesce(1)
    rows = {r.id: r for r in tree_paths(spark, nodes, id_col="id", parent_col="parent", name_col="name").collect()}
    assert len(rows) == 150 and rows[150].Level == 149 and rows[150].HierarchyPath.endswith("n149 > n150")


def test_cycle_names_the_path(spark):
    nodes = _nodes(spark, [(1, None, "HQ", 1), (2, 1, "A", 1), (1, 2, "HQ again", 1)])
    with pytest.raises(CycleError, match="1 > 2 > 1"):
        cumulative_down(spark, nodes, id_col="id", parent_col="parent", value_col="budget")


def test_long_chain_takes_few_rounds(spark, monkeypatch):
    """20,000 levels in 15 rounds or so, and a plan that doesn't grow with them."""
    n, rounds = 20_000, []
    nodes = spark.range(1, n + 1).selectExpr("CAST(id AS INT) id", "CAST(IF(id = 1, NULL, id - 1) AS INT) parent",
                                             "CAST(1 AS DECIMAL(18,2)) budget")
    kind = type(nodes)
    real = kind.checkpoint
    monkeypatch.setattr(kind, "checkpoint", lambda self, *a, **k: (rounds.append(1), real(self, *a, **k))[1])
    out = cumulative_down(spark, nodes, id_col="id", parent_col="parent", value_col="budget")
    assert len(rounds) <= 18
    row = out.agg(F.count(F.lit(1)).alias("n"), F.max("Level").alias("deep"),
                  F.count_if(F.col("TotalBudget") != F.col("Level") + 1).alias("wrong")).first()
    assert (row.n, row.deep, row.wrong) == (n, n - 1, 0)
    assert len(out._jdf.queryExecution().optimizedPlan().toString().splitlines()) < 20


def test_rootless_cycles_and_missing_parents_are_not_reached(spark):
    nodes = _nodes(spark, [(1, None, "HQ", 1), (2, 1, "A", 1), (3, 4, "x", 1), (4, 5, "y", 1), (5, 3, "z", 1), (6, 5, "under", 1),
                           (7, 77, "orphan", 1), (8, 7, "below", 1), (9, 9, "self", 1)])
    got = {r.id for r in tree_paths(spark, nodes, id_col="id", parent_col="parent", name_col="name").collect()}
    assert got == {1, 2}


def test_random_forest_against_plain_recursion(spark):
    import random
    rng = random.Random(8)
    parent = {i: (None if rng.random() < 0.02 else rng.randrange(max(1, i - 9), i)) if i > 1 else None for i in range(1, 400)}
    nodes = _nodes(spark, [(i, p, f"n{i}" if i % 50 else None, i) for i, p in parent.items()])

    def up(i):
        return [] if i is None else up(parent[i]) + [i]

    paths = {r.id: (r.Level, r.HierarchyPath) for r in
             tree_paths(spark, nodes, id_col="id", parent_col="parent", name_col="name").collect()}
    assert paths == {i: (len(up(i)) - 1, None if any(x % 50 == 0 for x in up(i)) else " > ".join(f"n{x}" for x in up(i)))
                     for i in parent}
    sums = {r.id: int(r.TotalBudget) for r in
            cumulative_down(spark, nodes, id_col="id", parent_col="parent", value_col="budget").collect()}
    assert sums == {i: sum(up(i)) for i in parent}


def test_two_parents_make_two_rows(spark):
    nodes = _nodes(spark, [(1, None, "HQ", 1), (2, 1, "A", 1), (3, 1, "B", 1), (4, 2, "C", 1), (4, 3, "C", 1)])
    got = sorted(r.HierarchyPath for r in tree_paths(spark, nodes, id_col="id", parent_col="parent", name_col="name").collect())
    # each row of 4 is met on its own way down
    assert got == ["HQ", "HQ > A", "HQ > A > C", "HQ > B", "HQ > B > C"]
