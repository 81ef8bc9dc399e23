import datetime as dt

import pytest

from smelter.session import Run, build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "smelter-tests",
        master="local[8]",
        shuffle_partitions=8,
        extra={"spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.sql.maxMetadataStringLength": "2000"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def run():
    return Run(dt.datetime(2024, 10, 1, 2, 0, tzinfo=dt.timezone.utc), "run-1")
