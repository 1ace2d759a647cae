from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
SF1 = "/root/testdata/sf0.1"


@pytest.fixture(scope="session")
def spark():
    from ebbtide.session import local_session

    scratch = tempfile.mkdtemp(prefix="ebbtide-test-")
    s = local_session("*", shuffle_partitions=8, scratch=scratch)
    yield s
    s.stop()
