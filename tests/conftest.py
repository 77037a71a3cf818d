import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from keyfig.session import ensure_settings
    ckpt = tempfile.mkdtemp(prefix="keyfig-test-ckpt-")
    s = (SparkSession.builder.master("local[*]").appName("keyfig-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_settings(s)
    yield s


SF_SMALL = "/root/testdata/sf0.001"
