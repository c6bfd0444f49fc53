import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from millwatch.session import local_session

    session = local_session("millwatch-tests", cores="8", memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def fleet(spark):
    from __spark_entry__ import Fleet

    return Fleet(spark, "/root/testdata/sf0.001")
