import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    base = tempfile.mkdtemp(prefix="run-")
    session = local_session(
        8,
        "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": f"{base}/scratch",
            "spark.sql.warehouse.dir": f"{base}/warehouse",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")
