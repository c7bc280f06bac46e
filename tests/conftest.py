import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerbrook.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def rows(spark):
    """Build a frame from tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)
