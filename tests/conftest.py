import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tonalyze.session import build_session

    session = build_session("local[4]", app="tonalyze-tests", shuffle_partitions=8,
                            extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
