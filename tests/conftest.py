import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tickloom.session import build_session

    session = build_session(
        "tests", "local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
           "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def inputs(spark):
    """The small test tables; models built from them are shared by the tests."""
    from tickloom.registry.inputs import Inputs

    return Inputs(spark, SMALL)


@pytest.fixture(scope="session")
def silver_bars(inputs):
    from tickloom.session import written

    return written(inputs.silver_bars, "test-silver")
