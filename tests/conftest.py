import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from creditflow.session import apply_job_conf
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cf-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    apply_job_conf(s)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="cf-test-")
