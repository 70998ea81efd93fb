from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from renewlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = local_session("8", "tests", **{"spark.sql.warehouse.dir": warehouse})
    yield session
    session.stop()
