import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    b = (SparkSession.builder.master("local[*]").appName("cardwatch-tests")
         .config("spark.sql.shuffle.partitions", "8"))
    for k, v in {"spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false",
                 "spark.ui.showConsoleProgress": "false", "spark.sql.adaptive.enabled": "true"}.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests run without a cluster-provided checkpoint folder: set one only if unset
    from cardwatch.session import checkpoint_dir
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="cardwatch-test-")
