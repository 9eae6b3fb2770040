import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[4]")
             .config("spark.sql.shuffle.partitions", "4")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "4g")
             .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ledgerline-wh-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from ledgerline.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    yield spark


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="ledgerline-test-")
