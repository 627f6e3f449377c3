import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from martwright.session import build_session
    s = build_session("local[4]", app_name="martwright-tests", shuffle_partitions=4,
                      extra={"spark.driver.memory": "4g"})
    # tests set their own shared folder; a cluster names it in its config
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="mw-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_root(spark):
    from martwright.session import scratch_path
    return scratch_path(spark, "test")
