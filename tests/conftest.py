import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tierline.session import SESSION_DEFAULTS, ensure_checkpoint_dir

    builder = (SparkSession.builder.master("local[*]").appName("tierline-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tierline-test-ckpt-"))
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tierline-test-wh-")))
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("driver test data not present")
    return SF_SMALL
