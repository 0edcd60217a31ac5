import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from millrace.operators import series  # noqa: E402
from millrace.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def cut(monkeypatch):
    """Treat series of more than 40 rows as too long for a task, and cut them into stretches of 16 rows."""
    monkeypatch.setattr(series, "ROWS_PER_TASK", 40)
    monkeypatch.setattr(series, "STRETCH_BITS", 4)


def frame_of(spark, values, by=None):
    """One series of floats with positions."""
    rows = [(by or "a", i, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, idx bigint, v double")


def column(df, name, order="idx"):
    return [r[name] for r in df.orderBy(order).collect()]
