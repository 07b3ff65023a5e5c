import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from motefield.queries.base import Data  # noqa: E402
from motefield.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "motefield-tests", "local[8]", spark__sql__shuffle__partitions="2", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def data(spark):
    return Data(spark, SMALL)


@pytest.fixture
def frame(spark):
    """A frame from rows and a DDL schema."""
    return lambda rows, ddl: spark.createDataFrame(rows, ddl)
