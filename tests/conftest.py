import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from terrace.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, 4, "terrace-tests")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


def ts(text):
    return dt.datetime.fromisoformat(text)


def rows_of(df, *columns):
    return sorted(
        (tuple(r) for r in (df.select(*columns) if columns else df).collect()),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )
