import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for folder in (ROOT, os.path.join(ROOT, "tools")):
    if folder not in sys.path:
        sys.path.insert(0, folder)

import pytest  # noqa: E402

from plumbline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[4]", "tests", 4, "4g", **{"spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples, nulls first."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is not None, v) for v in t))
