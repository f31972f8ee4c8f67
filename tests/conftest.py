import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from starloom.session import local_session

    s = local_session("*", shuffle_partitions=8, app="starloom-tests")
    yield s


@pytest.fixture()
def workdir():
    """A fresh scratch folder for one test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="starloom-test-")


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def plan_text(df, mode="extended") -> str:
    """The text ``DataFrame.explain`` prints, captured."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        if mode == "extended":
            df.explain(True)
        else:
            df.explain(mode=mode)
    return buf.getvalue()
