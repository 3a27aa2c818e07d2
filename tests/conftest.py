import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH", "")) if x)

import pytest  # noqa: E402

from tidegrain.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("tests", cores=4, spark__driver__memory="4g", spark__sql__shuffle__partitions="4")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
