import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from recipeframe.runtime import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session("tests", cores=8, partitions=4)
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    d = Path("/root/testdata/sf0.001")
    if not d.exists():
        pytest.skip("no test data here")
    return str(d)
