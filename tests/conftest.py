import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tidegauge.session import local_session, ship

    session = local_session("4", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    ship(session)
    yield session
    session.stop()
