"""Exact distributed PERCENTILE_CONT against numpy, including the bracketing path."""

import numpy as np
import pytest

from ledgerline.operators import quantile


def _np_cont(values, q):
    v = np.sort(np.asarray(values, dtype=float))
    pos = (len(v) - 1) * q
    lo, hi = int(np.floor(pos)), int(np.ceil(pos))
    if lo == hi or v[lo] == v[hi]:
        return v[lo]
    return (hi - pos) * v[lo] + (pos - lo) * v[hi]


@pytest.mark.parametrize("q", [0.5, 0.75, 0.9])
def test_small_band_path(spark, q):
    rng = np.random.default_rng(7)
    vals = rng.normal(size=2001).round(3).tolist()
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    assert quantile.percentile_cont(df, "x", q) == pytest.approx(_np_cont(vals, q), rel=1e-12)


@pytest.mark.parametrize("q", [0.5, 0.9])
def test_bracketing_path_with_hot_value(spark, monkeypatch, q):
    monkeypatch.setattr(quantile, "ACCURACY", 200)
    rng = np.random.default_rng(11)
    vals = rng.integers(0, 5000, size=3000).astype(float).tolist() + [42.0] * 1500  # one hot value
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert quantile.percentile_cont(df, "x", q) == pytest.approx(_np_cont(vals, q), rel=1e-12)


def test_empty_and_nulls(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert quantile.percentile_cont(df, "x", 0.5) is None
    df2 = spark.createDataFrame([(None,), (3.0,), (1.0,)], "x double")
    assert quantile.percentile_cont(df2, "x", 0.5) == 2.0


@pytest.mark.parametrize("q", [0.0, 0.5, 0.9, 1.0])
def test_millions_of_values_and_a_hot_one(spark, q):
    df = spark.range(2_000_000).selectExpr("CASE WHEN id % 3 = 0 THEN 1234567.0D ELSE cast((id * 7919) % 2000003 AS double) END AS x")
    ids = np.arange(2_000_000, dtype=np.int64)
    vals = np.where(ids % 3 == 0, 1234567.0, (ids * 7919 % 2000003).astype(float))
    assert quantile.percentile_cont(df, "x", q) == pytest.approx(_np_cont(vals, q), rel=1e-12)


@pytest.mark.parametrize("accuracy", [2, 5])
def test_coarse_sketch_is_still_exact(spark, monkeypatch, accuracy):
    monkeypatch.setattr(quantile, "ACCURACY", accuracy)
    rng = np.random.default_rng(3)
    vals = rng.normal(size=700).round(2).tolist()
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(4)
    for q in (0.1, 0.5, 0.99):
        assert quantile.percentile_cont(df, "x", q) == pytest.approx(_np_cont(vals, q), rel=1e-12)


def test_many_percentiles_share_their_scans(spark, monkeypatch):
    monkeypatch.setattr(quantile, "ACCURACY", 50)
    rng = np.random.default_rng(5)
    vals = rng.integers(0, 400, size=3000).astype(float).tolist() + [42.0] * 1500
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(4)
    qs = [0.0, 0.01, 0.1, 0.25, 0.5, 0.5, 0.75, 0.9, 0.99, 1.0]
    kind, scans = type(df), []
    real = kind.agg
    monkeypatch.setattr(kind, "agg", lambda self, *a, **k: (scans.append(1), real(self, *a, **k))[1])
    got = quantile.percentiles_cont(df, "x", qs)
    together = len(scans)
    assert got == pytest.approx([_np_cont(vals, q) for q in qs], rel=1e-12)
    scans.clear()
    assert [quantile.percentile_cont(df, "x", q) for q in qs] == pytest.approx(got, rel=1e-12)
    assert together * 3 < len(scans)
    assert quantile.percentiles_cont(df.filter("x < 0"), "x", qs) == [None] * len(qs)
