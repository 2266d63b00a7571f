import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from hearth.session import get_session
    s = get_session("hearth-tests", master="local[4]",
                    conf={"spark.sql.shuffle.partitions": "8"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"
