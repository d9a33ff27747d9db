import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from plume.session import build_session
    s = build_session("local[4]", 4, app_name="plume-tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="plume-test-ckpt-"))
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="plume-test-")
