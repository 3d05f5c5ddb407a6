from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="ledgerlens-tests",
                      driver_memory="4g")
    # Tests run locally: a private checkpoint folder is fine here.
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlens-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def sf_parity():
    return os.environ.get("LEDGERLENS_PARITY_SF", f"{TESTDATA}/sf0.001")
