import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from suite.session import local_session  # noqa: E402

RUN = datetime(2024, 2, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("work"))
    session = local_session(4, **{"spark.checkpoint.dir": folder})
    yield session
    session.stop()


@pytest.fixture
def values():
    """Rows of a DataFrame as a sorted list of tuples."""

    def read(df, *columns):
        rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(rows, key=repr)

    return read
