"""One local session for all tests; every test gets folders and stores of its own."""
from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from lakevault.operators.store import VaultStore  # noqa: E402
from lakevault.session import local_session, run_folder  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", 4, "6g")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return run_folder(spark, "test")


@pytest.fixture
def store(spark, folder):
    made = VaultStore(spark, f"{folder}/vault", f"test_{uuid.uuid4().hex[:10]}")
    made.ensure_database()
    return made
