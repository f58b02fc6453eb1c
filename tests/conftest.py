import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelspark.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", 8)
    yield s


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


def plan_text(df) -> str:
    """The formatted physical plan (full scan metadata, no truncation)."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
