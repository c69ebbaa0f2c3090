import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# folder with the golden text files of the original library (tests skip when unset)
REFERENCE_DATA = os.environ.get("CYCLONESPARK_GOLDEN_DIR", "")
SF = os.environ.get("CYCLONESPARK_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from cyclonespark.session import get_session

    s = get_session(master="local[4]", shuffle_partitions=4)
    yield s


def golden(*parts):
    path = os.path.join(REFERENCE_DATA, *parts)
    if not REFERENCE_DATA or not os.path.exists(path):
        pytest.skip(f"golden data not available: {path}")
    return path
