from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for folder in (ROOT, ROOT / "tools"):
    sys.path.insert(0, str(folder))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from filigree.session import drop_stages, get_session

    session = get_session("tests", 4, f"file://{tmp_path_factory.mktemp('shared')}")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_stages(session)
    session.stop()
