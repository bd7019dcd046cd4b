import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ledgerlens.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # Tests own their checkpoint folder: a fresh one per session.
    ckpt = tempfile.mkdtemp(prefix="ledgerlens-test-ckpt-")
    session = build_session(
        "local[*]", app_name="ledgerlens-tests", shuffle_partitions=8,
        conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g", "spark.sql.ui.retainedExecutions": "20"},
    )
    session.sparkContext.setCheckpointDir(ckpt)
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ledgerlens-test-")
