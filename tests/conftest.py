import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from screenloom.session import build_session, ship_package

    session = build_session(4, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    ship_package(session)
    yield session
    session.stop()
