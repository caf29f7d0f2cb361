import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from corpusloom.session import local_session

    session = local_session(4, "6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    def make(*values):
        return spark.createDataFrame(list(enumerate(values)), "id bigint, text string")

    return make
