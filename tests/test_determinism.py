"""Results do not depend on the number of shuffle partitions (layout-independent ids, ranks, ties)."""

import os

import pytest

from ledgerline.plans.stages import Run, Stages
from ledgerline.sources.testdata import RetailModel

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


def _run(spark, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        st = Stages(RetailModel(spark, SF), run=Run())
        return {
            "ranking": sorted(map(repr, st.employee_ranking.collect())),
            "segments": sorted(map(repr, st.customer_segment_analysis().collect())),
            "final": sorted(map(repr, st.tpd4.collect())),
        }
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_same_results_for_3_and_11_partitions(spark):
    a, b = _run(spark, 3), _run(spark, 11)
    for key in a:
        assert a[key] == b[key], key
