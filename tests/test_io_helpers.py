"""Sinks and sources: snapshot versions, script folders, shuffle sizing."""

import os

import pytest

from ledgerline.operators.dml import write_snapshot
from ledgerline.plans import usage
from ledgerline.session import size_shuffle_partitions


def test_snapshot_versions_never_overwrite(spark, scratch):
    base = os.path.join(scratch, "snap")
    df = spark.range(5)
    p1 = write_snapshot(df, base, 1)
    assert spark.read.parquet(p1).count() == 5
    with pytest.raises(Exception):
        write_snapshot(df, base, 1)            # an existing version is never replaced
    p2 = write_snapshot(df.filter("id > 2"), base, 2)
    assert p1 != p2 and spark.read.parquet(p2).count() == 2


def test_read_scripts_and_inventory(spark, scratch):
    d = os.path.join(scratch, "sql")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "one.sql"), "w") as f:
        f.write("INSERT INTO Audit SELECT * FROM Events e JOIN Users u ON u.id = e.uid;\n")
    with open(os.path.join(d, "two.sql"), "w") as f:
        f.write("DELETE FROM Sessions WHERE id IN (SELECT s.id FROM Sessions s);\n")
    scripts = usage.read_scripts(spark, os.path.join(d, "*.sql"))
    got = {(r.type, r.name) for r in usage.table_usage(usage.references(scripts)).collect()}
    assert got == {("insert", "Audit"), ("select", "Events"), ("select", "Users"),
                   ("delete", "Sessions"), ("select", "Sessions")}


def test_shuffle_sizing_respects_explicit_setting(spark):
    # the test session sets spark.sql.shuffle.partitions explicitly: it is kept
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert size_shuffle_partitions(spark, ["/root/testdata/sf0.001"]) == int(before)
