import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from sitelens.session import SESSION_CONF, ensure_checkpoint_dir

    builder = SparkSession.builder.master("local[4]").appName("sitelens-tests")
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    session = builder.config("spark.sql.shuffle.partitions", "8").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session, tempfile.mkdtemp(prefix="sitelens-ckpt-"))
    yield session


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="sitelens-test-")
