"""Parent/child trees: paths and root-to-node running sums, by pointer doubling.

Every node holds a pointer to an ancestor and what lies between the two (levels,
path, sum), at first for its parent.  A round looks up where the ancestor points
to and appends that, so the steps that a pointer spans double: log2(depth) equi-joins
whatever the size or shape of the tree, each checkpointed, so the plan doesn't grow.
Nodes whose pointer has passed a root are done.  What isn't after log2(rows) + 1
rounds lies in or under a cycle that no root reaches, or a parent that doesn't exist:
the recursion never gets there.

Where an id stands in several rows, a node has several ways up, and a cycle may be
reached from a root.  Such tables are walked level by level, and a node that is met
twice on one path is an error.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class CycleError(ValueError):
    """A node is its own ancestor."""


def _doubled(nodes: DataFrame, id_col: str, parent_col: str, name: str, own: Column,
             chain: Callable[[Column, Column], Column]) -> DataFrame:
    """Nodes reachable from the roots with Level and ``name``: ``own`` of all nodes from the root down, ``chain``-ed.

    ``chain(upper, lower)`` has to be associative.  Ids are unique.
    """
    at = nodes.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(parent_col).alias("up"), F.when(F.col(parent_col).isNull(), 0).otherwise(1).alias("Level"),
        own.alias(name)).checkpoint()
    rounds = max(1, at.count()).bit_length() + 1
    while rounds and not at.filter("up IS NOT NULL").isEmpty():
        above = at.select(F.col("id").alias("up__id"), F.col("up").alias("up__up"), F.col("Level").alias("up__Level"),
                          F.col(name).alias("up__own"))
        # a pointer to nowhere ends here: the inner join drops the node
        further = at.filter("up IS NOT NULL").join(above, F.col("up") == F.col("up__id")).select(
            "id", F.col("up__up").alias("up"), (F.col("Level") + F.col("up__Level")).alias("Level"),
            chain(F.col("up__own"), F.col(name)).alias(name))
        at, rounds = at.filter("up IS NULL").unionByName(further).checkpoint(), rounds - 1
    done = at.filter("up IS NULL").select(F.col("id").alias(id_col), "Level", name)
    return nodes.join(done, id_col).select(*nodes.columns, "Level", name)


def _walked(nodes: DataFrame, id_col: str, parent_col: str, name: str, own: Column,
            chain: Callable[[Column, Column], Column]) -> DataFrame:
    """The same level by level; each row carries the ids on its path."""
    columns = nodes.columns
    level = nodes.filter(F.col(parent_col).isNull()).select(
        *columns, F.lit(0).alias("Level"), own.alias(name), F.array(F.col(id_col)).alias("__ids")).checkpoint()
    out = level
    while not level.isEmpty():
        above = level.select(F.col(id_col).alias("up__id"), F.col("Level").alias("up__Level"),
                             F.col(name).alias("up__own"), F.col("__ids").alias("up__ids"))
        level = (nodes.join(above, F.col(parent_col) == F.col("up__id"), "inner")
                 .select(*columns, (F.col("up__Level") + 1).alias("Level"), chain(F.col("up__own"), own).alias(name),
                         "up__ids", F.array_append("up__ids", F.col(id_col)).alias("__ids")).checkpoint())
        met = level.filter(F.array_contains("up__ids", F.col(id_col))).select("__ids").first()
        if met is not None:
            raise CycleError(f"the tree has a cycle: {' > '.join(map(str, met[0]))}")
        level = level.drop("up__ids")
        out = out.unionByName(level)
    return out.drop("__ids")


def _from_roots(nodes: DataFrame, id_col: str, *how) -> DataFrame:
    twice = nodes.filter(F.col(id_col).isNotNull()).groupBy(id_col).count().filter("count > 1")
    return (_doubled if twice.isEmpty() else _walked)(nodes, id_col, *how)


def tree_paths(spark: SparkSession, nodes: DataFrame, *, id_col: str, parent_col: str,
               name_col: str, sep: str = " > ", keep: list[str] | None = None) -> DataFrame:
    """Every node reachable from a root with Level and HierarchyPath.

    Roots have Level 0 and path = name; a child has Level + 1 and path
    ``parent_path + sep + name`` (NULL-propagating concat, as with `+`).
    """
    return _from_roots(nodes.select(id_col, name_col, parent_col, *(keep or [])), id_col, parent_col, "HierarchyPath",
                       F.col(name_col).cast("string"), lambda upper, lower: F.concat(upper, F.lit(sep), lower))


def cumulative_down(spark: SparkSession, nodes: DataFrame, *, id_col: str, parent_col: str,
                    value_col: str, keep: list[str] | None = None,
                    direct_alias: str = "DirectBudget", total_alias: str = "TotalBudget") -> DataFrame:
    """Root-to-node running sum of ``value_col`` (not a subtree roll-up)."""
    keep = keep or []
    n = nodes.select(id_col, *keep, parent_col, F.col(value_col).alias(direct_alias))
    out = _from_roots(n, id_col, parent_col, total_alias, F.col(direct_alias).cast("decimal(38,2)"),
                      lambda upper, lower: (upper + lower).cast("decimal(38,2)"))
    return out.select(id_col, *keep, parent_col, direct_alias, total_alias, "Level")
