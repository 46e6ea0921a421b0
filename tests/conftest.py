import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidecast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, name="tests")
    yield session
    session.stop()


@pytest.fixture
def ts():
    def parse(text: str) -> dt.datetime:
        return dt.datetime.fromisoformat(text)

    return parse


@pytest.fixture
def plan_of():
    def text(df) -> str:
        return df._jdf.queryExecution().executedPlan().toString()

    return text
