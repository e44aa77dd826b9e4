import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from topicflow.session import get_session
    s = get_session("local[4]", app="topicflow-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from topicflow.session import scratch_dir

    def folder(name="t"):
        path = scratch_dir(spark, name).removeprefix("file:")
        os.makedirs(path)  # tests also write files there themselves
        return path
    return folder
