import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from strandmark.session import ensure_importable, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, **{"spark.sql.shuffle.partitions": "4"})
    ensure_importable(session)
    yield session
    session.stop()
