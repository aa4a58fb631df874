import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from featureflow.session import build_session
    s = build_session("local[4]", 4, app="featureflow-tests",
                      extra={"spark.ui.showConsoleProgress": "false",
                             "spark.sql.adaptive.coalescePartitions.enabled": "true"})
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ff-test-ckpt-"))
    yield s
    s.stop()


def ts(s):
    import datetime as dt
    return dt.datetime.fromisoformat(s)
