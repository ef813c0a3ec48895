import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from siglake.session import checkpoint_dir, get_session
    s = get_session("local[2]", app="siglake-tests", shuffle_partitions=4)
    checkpoint_dir(s)  # tests have no cluster folder: a scratch one is registered
    yield s
    s.stop()


@pytest.fixture
def scratch():
    """A fresh scratch folder per test (never reused, never wiped)."""
    return tempfile.mkdtemp(prefix="siglake-test-")


def write_file(folder: str, name: str, data: bytes | str) -> str:
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    mode = "wb" if isinstance(data, bytes) else "w"
    with open(path, mode) as f:
        f.write(data)
    return path
