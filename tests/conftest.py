import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from stratum.session import build_session

    spark = build_session(
        "stratum-tests",
        master="local[*]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    if not spark.sparkContext.getConf().get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stratum-test-ckpt-"))
    yield spark
    spark.stop()


@pytest.fixture()
def tmp_root(spark):
    from stratum.session import scratch

    return scratch(spark, "test")
