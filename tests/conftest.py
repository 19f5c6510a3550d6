from __future__ import annotations

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from qualityforge import runtime  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = runtime.local_session("qualityforge-tests", 8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
