import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from catalogflow.session import builder

    session = (
        builder("tests", spark__ui__enabled="false", spark__sql__shuffle__partitions="4")
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "1000").master("local[4]").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getConf().get("spark.checkpoint.dir"):
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="catalogflow-tests-"))
    yield session
    session.stop()


@pytest.fixture
def out(tmp_path):
    return str(tmp_path)
