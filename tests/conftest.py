import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tierlake.session import build_session
    work = tempfile.mkdtemp(prefix="tierlake-test-")
    s = build_session("local[4]", 4, app_name="tierlake-tests",
                      extra={"spark.checkpoint.dir": work, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Sorted list of tuples (for order-insensitive asserts)."""
    sel = df.select(*cols) if cols else df
    return sorted([tuple(r) for r in sel.collect()], key=lambda t: tuple((x is None, str(x)) for x in t))
