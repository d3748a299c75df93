import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from larder.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="larder-tests-")
    s = build_session(
        "local[4]",
        shuffle_partitions=4,
        extra={
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.ui.showConsoleProgress": "false",
            "spark.ui.enabled": "false",
        },
    )
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(f"{scratch}/checkpoints")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def scratch_dir():
    return tempfile.mkdtemp(prefix="larder-scratch-")
