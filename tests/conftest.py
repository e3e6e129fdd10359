import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pacekit.session import build_session

    ckpt = tempfile.mkdtemp(prefix="pacekit-test-ckpt-")
    s = build_session("local[4]", 4, extra={"spark.checkpoint.dir": ckpt,
                                             "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from pacekit.session import scratch_dir

    return scratch_dir(spark, "test")
