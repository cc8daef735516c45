from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from estatelake.session import build_session

    ck = tempfile.mkdtemp(prefix="estatelake-tests-")
    session = build_session(
        app_name="estatelake-tests",
        master="local[4]",
        shuffle_partitions=8,
        extra_conf={
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    # Tests set their own shared folder only where the session has none.
    if not session.conf.get("spark.checkpoint.dir", None) and not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(ck)
    yield session
    from estatelake.session import clean_scratch

    clean_scratch(session)
    session.stop()


@pytest.fixture
def scratch(spark):
    from estatelake.session import scratch_path

    return lambda name: scratch_path(spark, name)
