import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from riskloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="riskloom-tests-")
    session = local_session(
        "riskloom-tests",
        4,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": f"{work}/warehouse",
            "spark.driver.memory": "4g",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="riskloom-test-")
