import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from lexigraph.session import get_spark

    s = get_spark(4, 8)
    s.sparkContext.setLogLevel("ERROR")
    return s


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF
