import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from fareline.session import build_session, shared_dir

    scratch = tempfile.mkdtemp(prefix="fareline-tests-")
    s = build_session(
        master="local[4]",
        shuffle_partitions=4,
        app="fareline-tests",
        extra={"spark.sql.warehouse.dir": f"{scratch}/warehouse"},
    )
    shared_dir(s)  # the session's checkpoint folder; a private one only if none is configured
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
