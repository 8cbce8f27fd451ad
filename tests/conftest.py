import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from oreflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "oreflow-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_context(tmp_path):
    from oreflow import Context

    landing = tmp_path / "landing"
    landing.mkdir()

    def make(run_id, **changes):
        return Context(run_id, str(landing), str(tmp_path / "lake"), **changes)

    make.landing = landing
    return make
