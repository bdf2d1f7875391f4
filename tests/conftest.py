import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import local_session

    s = local_session(
        "local[4]",
        **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="quarry-test-ckpt-"), "spark.driver.memory": "4g"},
    )
    yield s
    s.stop()
