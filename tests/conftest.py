import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from granary.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    SparkSession.builder.config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    session = local_session(4, "4g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def run_ts():
    return dt.datetime(2025, 1, 1)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
