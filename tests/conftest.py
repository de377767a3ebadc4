from __future__ import annotations

import os
import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from penstock.session import local_session, shared_root  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, 4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture
def folder(spark):
    """A new folder below the shared root."""
    path = Path(shared_root(spark)) / f"test-{uuid.uuid4().hex}"
    path.mkdir(parents=True)
    return str(path)
