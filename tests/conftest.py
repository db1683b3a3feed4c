import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="tollgate-test-ckpt-")
    s = (
        SparkSession.builder.master("local[*]")
        .appName("tollgate-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from tollgate.session import apply_recommended
    apply_recommended(s)
    # tests own their checkpoint folder only when the session names none
    if s.sparkContext.getCheckpointDir() is None and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(ckpt)
    yield s
