import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tidemark.session import build_session, job_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def cluster(tmp_path_factory):
    spark = build_session(
        "tests", "8", {"spark.driver.memory": "6g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    )
    yield spark
    spark.stop()


@pytest.fixture
def spark(cluster):
    session = job_session(cluster)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


@pytest.fixture(scope="session")
def data():
    return DATA
