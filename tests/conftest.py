import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from fieldloom.session import build

    session = build("tests", "local[4]", spark_sql_shuffle_partitions=4, spark_ui_enabled="false", spark_driver_memory="4g", spark_ui_showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
