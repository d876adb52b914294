import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from ledgerlens.session import get_session, release_scratch  # noqa: E402

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "ledgerlens-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    release_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def sf_check():
    return str(DATA / "sf0.01")
