import logging
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tidemark.session import local_session, work_dir  # noqa: E402
from tidemark.tables.event_table import create_namespace  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    logging.getLogger("py4j").setLevel(logging.WARNING)
    session = local_session("tests")
    session.sparkContext.setLogLevel("OFF")
    create_namespace(session, "testdb", work_dir(session, "testdb"))
    yield session
    session.stop()


@pytest.fixture
def folder(spark, request):
    """A fresh working folder, on the storage the session names."""
    return work_dir(spark, "test")


@pytest.fixture
def table(folder):
    return "testdb.t_" + folder.rsplit("-", 1)[1]
