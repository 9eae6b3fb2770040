"""Property tests: MERGE against a plain-Python model of its semantics."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators.dml import MergeSpec, merge

keys = st.integers(min_value=0, max_value=8)
vals = st.one_of(st.none(), st.integers(min_value=-3, max_value=5))
targets = st.lists(st.tuples(keys, st.sampled_from([6, 7]), vals), max_size=10,
                   unique_by=lambda r: (r[0], r[1]))
sources = st.lists(st.tuples(keys, vals), max_size=8, unique_by=lambda r: r[0])


def _spec():
    t, s = (lambda c: F.col(f"t__{c}")), (lambda c: F.col(f"s__{c}"))
    return MergeSpec(on=["k"], target_scope=t("month") == 7, matched_condition=t("v") != s("v"),
                     matched_set={"v": s("v")}, insert_values={"k": s("k"), "month": F.lit(7), "v": s("v")},
                     delete_condition=(t("month") == 7) & (t("v") < 0), change_columns=["v"])


def _model(target, source):
    """T-SQL MERGE with three-valued logic, on Python rows."""
    src = dict(source)
    out, feed = [], []
    for k, month, v in target:
        if month != 7:
            out.append((k, month, v))
        elif k in src:
            new = src[k]
            if v is not None and new is not None and v != new:
                out.append((k, month, new))
                feed.append(("UPDATE", new, v))
            else:
                out.append((k, month, v))
        elif v is not None and v < 0:
            feed.append(("DELETE", None, v))
        else:
            out.append((k, month, v))
    in_scope = {k for k, month, _ in target if month == 7}
    for k, v in source:
        if k not in in_scope:
            out.append((k, 7, v))
            feed.append(("INSERT", v, None))
    return out, feed


def _key(r):
    return tuple((x is None, x) for x in r)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=targets, source=sources)
def test_merge_matches_model(spark, target, source):
    tdf = spark.createDataFrame(target, "k int, month int, v int")
    sdf = spark.createDataFrame(source, "k int, v int")
    new, changes = merge(tdf, sdf, _spec())
    want_rows, want_feed = _model(target, source)
    assert sorted(map(tuple, new.collect()), key=_key) == sorted(want_rows, key=_key)
    got_feed = [(r.ActionType, r.Newv, r.Oldv) for r in changes.collect()]
    assert sorted(got_feed, key=_key) == sorted(want_feed, key=_key)
    # the change feed accounts for the whole difference of the (non-null) totals
    before = sum(v for _, _, v in target if v is not None)
    after = sum(v for _, _, v in want_rows if v is not None)
    delta = sum((n or 0) - (o or 0) for _, n, o in got_feed)
    assert after - before == delta
