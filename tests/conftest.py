import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]").appName("wordmill-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # tests only: a local checkpoint folder when the session names none
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wordmill-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def partitions(spark):
    """Run a block under a given shuffle-partition count, then restore it."""
    old = spark.conf.get("spark.sql.shuffle.partitions")

    def set_(n):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
    yield set_
    spark.conf.set("spark.sql.shuffle.partitions", old)
