import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from harborline.session import session

    s = session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
            spark__driver__memory="6g", spark__sql__autoBroadcastJoinThreshold="1m"
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
