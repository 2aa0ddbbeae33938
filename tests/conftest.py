import contextlib
import io
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ordwise.session import build_session

    # Tests own their session, so they name their own shared folder.
    ckpt = tempfile.mkdtemp(prefix="ordwise-test-")
    s = build_session("local[*]", app_name="ordwise-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from tests.oracle_compare import duck
    return duck(SF_SMALL)


@pytest.fixture(scope="session")
def duck_check():
    from tests.oracle_compare import duck
    return duck(SF_CHECK)


def plan_text(df, mode: str = "formatted") -> str:
    """The physical plan as printed by ``explain``."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
