import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tokenloom.session import local_session, ship_package  # noqa: E402

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tokenloom-tests", **{"spark.sql.shuffle.partitions": "4"})
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    if not DATA.exists():
        pytest.skip("driver tables are not available")
    return str(DATA)
