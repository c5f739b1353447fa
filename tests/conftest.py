import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lectern.session import build_session, ship_package, shared_dir


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    def collect(df, *order):
        return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]

    return collect
