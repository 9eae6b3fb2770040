"""Exact PERCENTILE_CONT over a column of any size.

The order statistics that the percentiles interpolate are found by narrowing
brackets: a sketch (``percentile_approx``: partial on the map side, bounded memory,
no shuffle of values) proposes a value for each wanted rank and a lower and an
upper one around it; one counting pass tells how many values lie below each.  If
a proposed value holds its rank, it is the answer; else that rank's search goes on
between it and the bound on the rank's side.  Every round excludes the proposed
value, and a bracket shrinks to about 4 / ACCURACY of the rows, so a handful of
rounds do for any input.  All ranks share both passes of a round.  A hot value is
found like any other.  Only a few numbers per round and rank reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Relative rank error of the sketch is at most 1 / ACCURACY.
ACCURACY = 10_000


@dataclass
class _Search:
    """A 0-based rank; it lies among the ``size`` values of a band, and ``below`` values are under that."""
    rank: int
    below: int
    size: int
    band: Column
    value: float | None = None
    at_most: int = 0


def _order_statistics(values: DataFrame, n: int, ranks: Sequence[int]) -> dict[int, tuple[float, int]]:
    """rank -> its value among ``values(x)``, and how many values are at most it."""
    x = F.col("x")
    searches = [_Search(r, 0, n, F.lit(True)) for r in sorted(set(ranks))]
    while todo := [s for s in searches if s.value is None]:
        def points(s: _Search) -> list[float]:
            at = (s.rank - s.below + 0.5) / s.size
            return [max(0.0, at - 2.0 / ACCURACY), at, min(1.0, at + 2.0 / ACCURACY)]

        sketched = values.agg(*[F.percentile_approx(F.when(s.band, x), points(s), ACCURACY).alias(f"q{i}")
                                for i, s in enumerate(todo)]).first()
        bounds = [sketched[f"q{i}"] for i in range(len(todo))]
        counted = values.agg(*[
            F.count(F.when(s.band & cond, 1)).alias(f"c{i}{name}")
            for i, (s, (low, mid, high)) in enumerate(zip(todo, bounds))
            for name, cond in (("a", x < low), ("b", x < mid), ("c", x <= mid), ("d", x <= high))]).first()
        for i, (s, (low, mid, high)) in enumerate(zip(todo, bounds)):
            lt_low, lt_mid, le_mid, le_high = (counted[f"c{i}{name}"] for name in "abcd")
            r = s.rank - s.below
            if lt_mid <= r < le_mid:
                s.value, s.at_most = float(mid), s.below + le_mid
            elif r < lt_mid:
                first = lt_low if lt_low <= r else 0
                s.band = s.band & ((x < mid) if first == 0 else (x >= low) & (x < mid))
                s.below, s.size = s.below + first, lt_mid - first
            else:
                last = le_high if r < le_high else s.size
                s.band = s.band & ((x > mid) if last == s.size else (x > mid) & (x <= high))
                s.below, s.size = s.below + le_mid, last - le_mid
    return {s.rank: (s.value, s.at_most) for s in searches}


def percentiles_cont(df: DataFrame, col: str, qs: Sequence[float]) -> list[float | None]:
    """PERCENTILE_CONT(q) WITHIN GROUP (ORDER BY col) for each q, over all rows of ``df`` (NULLs ignored).

    ``df`` is scanned a few times, however many percentiles are wanted: store it
    first if it is costly to make.  Computed on doubles with the interpolation
    ``(hi - pos) * v_lo + (pos - lo) * v_hi``.  None for each on empty input.
    """
    values = df.select(F.col(col).cast("double").alias("x")).filter(F.col("x").isNotNull())
    n = values.count()
    if n == 0:
        return [None] * len(qs)
    places = [(n - 1) * q for q in qs]
    found = _order_statistics(values, n, [int(math.floor(pos)) for pos in places])
    # the next value is the same one, or else the least above it
    above = [found[int(math.floor(pos))][0] for pos in places if math.ceil(pos) >= found[int(math.floor(pos))][1]]
    nexts = dict(zip(above, values.agg(*[F.min(F.when(F.col("x") > v, F.col("x"))).alias(f"m{i}")
                                         for i, v in enumerate(above)]).first())) if above else {}
    out: list[float | None] = []
    for pos in places:
        lo, hi = int(math.floor(pos)), int(math.ceil(pos))
        v_lo, at_most = found[lo]
        out.append(v_lo if hi < at_most else (hi - pos) * v_lo + (pos - lo) * float(nexts[v_lo]))
    return out


def percentile_cont(df: DataFrame, col: str, q: float) -> float | None:
    """One percentile (``percentiles_cont``)."""
    return percentiles_cont(df, col, [q])[0]
