import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tests.session import make_session

    session = make_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
