import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ratewise.session import build_session
    # a fresh warehouse per run: the in-memory catalog forgets managed tables between sessions
    s = build_session("local[4]", 8, app_name="ratewise-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="ratewise-wh-")})
    yield s
    s.stop()
