from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path = [os.path.abspath(p) for p in sys.path]

from pyspark import cloudpickle  # noqa: E402

import tests  # noqa: E402
from loomvec.session import build_session  # noqa: E402

# As for the package itself: what tests define goes to the workers by value.
cloudpickle.register_pickle_by_value(tests)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Python workers start in this folder, so nothing of the repository is on their path.
    os.chdir(tmp_path_factory.mktemp("elsewhere"))
    session = build_session(
        "loomvec-tests",
        master="local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
