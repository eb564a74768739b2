import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from cubeloom.session import local_session  # noqa: E402
from cubeloom.spec import DEFAULT_SPEC  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, "tests", **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def raw_row():
    """One raw row as text; keyword arguments replace values, None drops the column."""

    def build(**changes):
        row = {DEFAULT_SPEC.period: "2025-01-31"}
        row |= {d: "1" for d in DEFAULT_SPEC.raw_dims}
        row |= {m: "1" for m in DEFAULT_SPEC.measures}
        row |= changes
        return {k: v for k, v in row.items() if v is not None}

    return build


@pytest.fixture
def text_frame(spark):
    """Rows of text values as a DataFrame of strings; '<null>' stands for null."""

    def build(rows):
        names = list(rows[0])
        data = [tuple(None if r[n] == "<null>" else r[n] for n in names) for r in rows]
        schema = ", ".join(f"`{n}` string" for n in names)
        return spark.createDataFrame(data, schema)

    return build
