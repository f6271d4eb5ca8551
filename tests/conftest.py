from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SMALL = "/root/testdata/sf0.001"
CHECKED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from check import session

    active = session()
    active.sparkContext.setLogLevel("OFF")
    active.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield active
    active.stop()
